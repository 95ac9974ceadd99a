"""Quality rules: a threshold table compiled into Spark expressions.

Everything is a built-in expression over one row: no user function, no shuffle.
Each measure is a whole number and each rule compares ``100 * part`` with a
percentage of ``whole``, so a verdict never hangs on rounding.

Null text counts as empty text; empty text has no words and fails the base.
Equal rows get equal results and other columns are passed through.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from daybook.llm.common import SPACE_CLASS

WINDOW = 5

# Common short words of the four languages, as they stand in prose.
STOP_WORDS = tuple(
    "the and of to in is that for it on der die das und den zu ist von mit ein"
    " le la les de des et en est que une el los las y por con un del se".split()
)


@dataclass(frozen=True)
class Rule:
    """Reject if ``100 * part`` leaves ``low..high`` per cent of ``whole``.

    Texts with fewer than ``min_words`` words are not judged by this rule.
    """

    name: str
    part: str
    whole: str
    low: int | None = None
    high: int | None = None
    min_words: int = 0

    def failed(self) -> Column:
        part, whole = F.col(self.part) * 100, F.col(self.whole)
        out = F.lit(False)
        if self.low is not None:
            out = out | (part < whole * self.low)
        if self.high is not None:
            out = out | (part > whole * self.high)
        return out & (F.col("n_words") >= self.min_words)


RULES = (
    Rule("word_length", "word_chars", "n_words", low=250, high=1200),
    Rule("symbols", "n_symbols", "n_words", high=10),
    Rule("stop_words", "n_stop_words", "n_words", low=2, min_words=60),
    Rule("duplicate_lines", "n_dup_lines", "n_lines", high=40),
    Rule("bullet_lines", "n_bullet_lines", "n_lines", high=90, min_words=60),
    Rule("ellipsis_lines", "n_ellipsis_lines", "n_lines", high=40),
    Rule("stuttered_words", "n_stuttered", "n_words", high=30),
)

COUNTS = (
    "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
    "n_lines", "n_bullet_lines", "n_ellipsis_lines", "n_stop_words", "n_stuttered",
)


def _size(array: Column) -> Column:
    return F.size(array).cast("long")


def _words_of(text: Column) -> Column:
    trimmed = F.btrim(text, F.lit(" \t\n\x0b\x0c\r"))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(
        F.split(trimmed, f"{SPACE_CLASS}+")
    )


def measured(rows: DataFrame, text: str = "text") -> DataFrame:
    """``rows`` with the columns of ``COUNTS``; names in use are replaced.

    Repeated windows are found by sorting a text's window hashes, and only for
    texts in which a hash occurs twice. A step's arrays are columns of their
    own, because an expression used inside a lambda is evaluated per element.
    """
    kept = [c for c in rows.columns if c not in COUNTS]
    held = [F.col(f"`{c}`") for c in kept]
    value = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    low, high = F.lit(0), F.lit(WINDOW - 1)

    out = rows.select(
        *held,
        _words_of(value).alias("__words"),
        F.filter(F.split(value, "\n"), lambda x: x.rlike(r"[^ \t-\r]")).alias("__lines"),
        F.octet_length(F.regexp_replace(value, r"[^#*$%&|<>]+", "")).cast("long").alias("n_symbols"),
    )
    words, lines = F.col("__words"), F.col("__lines")
    stops = [*STOP_WORDS, *(w.capitalize() for w in STOP_WORDS)]
    out = out.select(
        *held,
        "n_symbols",
        _size(words).alias("n_words"),
        F.char_length(F.array_join(words, "")).cast("long").alias("word_chars"),
        _size(F.filter(words, lambda w: w.isin(stops))).alias("n_stop_words"),
        _size(lines).alias("n_lines"),
        (_size(lines) - _size(F.array_distinct(lines))).alias("n_dup_lines"),
        _size(F.filter(lines, lambda x: x.rlike(r"^[ \t-\r]*[-*•]"))).alias("n_bullet_lines"),
        _size(F.filter(lines, lambda x: x.rlike(r"(\.\.\.|…)[ \t-\r]*\z"))).alias("n_ellipsis_lines"),
        F.transform(words, lambda w: F.xxhash64(w)).alias("__words"),
    )
    count = F.size("__words")
    out = out.withColumn(
        "__windows",
        F.when(count < WINDOW, F.array().cast("array<bigint>")).otherwise(
            F.transform(
                F.sequence(low, count - WINDOW),
                lambda i: F.xxhash64(*(F.get("__words", i + k) for k in range(WINDOW))),
            )
        ),
    ).withColumn(
        "n_stuttered",
        F.when(count < 2, F.lit(0).cast("long")).otherwise(
            _size(
                F.filter(
                    F.sequence(F.lit(1), F.greatest(count - 1, F.lit(1))),
                    lambda i: F.get("__words", i) == F.get("__words", i - 1),
                )
            )
        ),
    ).drop("__words")
    windows = F.col("__windows")
    out = out.withColumn(
        "__sorted",
        F.when(
            F.size(F.array_distinct(windows)) < F.size(windows),
            F.sort_array(F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("i")))),
        ),
    ).drop("__windows")
    last = F.size("__sorted") - 1

    def at(i: Column) -> Column:
        return F.get("__sorted", i)["h"]

    out = out.withColumn(
        "__starts",
        F.when(
            F.col("__sorted").isNotNull(),
            F.sort_array(
                F.transform(
                    F.filter(
                        F.sequence(low, last),
                        lambda i: F.coalesce(at(i) == at(i - 1), F.lit(False))
                        | F.coalesce(at(i) == at(i + 1), F.lit(False)),
                    ),
                    lambda i: F.get("__sorted", i)["i"],
                )
            ),
        ),
    ).drop("__sorted")
    covered = F.aggregate(
        F.sequence(low, F.size("__starts") - 2),
        F.lit(0).cast("long"),
        lambda total, j: total
        + F.least(high + 1, F.get("__starts", j + 1) - F.get("__starts", j)).cast("long"),
    )
    out = out.withColumn(
        "n_repeat_words",
        F.when(F.col("__starts").isNull(), F.lit(0).cast("long")).otherwise(covered + WINDOW),
    )
    return out.select(*held, *COUNTS)


def judge(rows: DataFrame, text: str = "text", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """``rows`` with their measures, ``base_failed``, ``failed_rules`` and ``kept``."""
    out = measured(rows, text)
    base = (F.col("n_words") < 10) | (F.col("n_repeat_words") * 100 > F.col("n_words") * 20)
    names = F.array_compact(F.array(*(F.when(r.failed(), F.lit(r.name)) for r in rules)))
    return out.withColumns(
        {
            "base_failed": base,
            "failed_rules": F.array_join(names, ","),
            "kept": ~base & (F.size(names) == 0),
        }
    )


def kept_rows(rows: DataFrame, text: str = "text", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """The rows the rules keep, with their own columns only.

    A filter on the verdict would be moved below the steps that measure it, which
    puts each step's arrays into the lambdas of the next. The row number, which
    the optimizer may not evaluate elsewhere, holds it in place.
    """
    packed = rows.select(
        F.struct(*(F.col(f"`{c}`") for c in rows.columns)).alias("__row"),
        F.col(f"`{text}`").alias("__text"),
    )
    held = F.col("kept") & (F.monotonically_increasing_id() >= 0)
    return judge(packed, "__text", rules).withColumn("__held", held).filter("__held").select("__row.*")
