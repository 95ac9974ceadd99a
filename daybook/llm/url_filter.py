"""URL filter: rules by host and path, and a character language-model ratio.

URLs that a rule decides are the labelled ones. Two character models of variable
order, one of accepted and one of rejected URLs, are counted from three quarters
of them; a character's probability starts from a uniform one and is refined by
every context of up to ``ORDER`` characters that its model has seen, mixed by
the number of different characters seen there (Witten-Bell). A URL's score is
the sum of log-likelihood differences over its length, and the threshold is the
one with the least balanced error on the remaining quarter. URLs without a rule
are allowed from the threshold on.

Only built-in expressions, aggregates and equi-joins. Equal URLs are scored
once; a URL's characters meet the model as 5-grams, by joins that AQE may split.
Log ratios are decimals, so sums do not depend on the order of rows. The driver
sees the counts per score bin, some 1,000 rows for any input.

A URL is scored whole from its host on, query string and fragment included. One
without ``://`` has empty host and path, so no rule fits it, and is scored by its
own text; a null URL is scored as the empty text. Without labelled URLs every score is
0 and everything is allowed. No rows give no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from daybook.llm.common import written

ORDER = 4
ALPHABET = 256
#: Parts of the grams that share one of the shortest contexts.
SALTS = 32
#: Score bins per unit, and the largest bin on either side.
BINS, LARGEST = 100, 500
START, END = "\x02", "\x03"
RATIO = "decimal(18,9)"

# The rules of the contract, as host and path with their verdict.
RULES = {
    "com/": "allow",
    "example.com/en/": "block",
    "www.example.com/en/": "allow",
    "net/es/": "block",
    "net/fr/": "block",
}


def parts_of(url: Column) -> tuple[Column, Column, Column]:
    """The host, A-Z lower-cased, the path, and the text that is scored: all from the
    host on. Without ``://`` host and path are empty and the text is the URL."""
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    url = F.coalesce(url, F.lit(""))
    found = F.locate("://", url)
    rest = F.when(found > 0, F.substring(url, found + 3, F.char_length(url))).otherwise("")
    host = F.regexp_extract(rest, r"(?s)\A[^/?#]*", 0)
    after = F.substring(rest, F.char_length(host) + 1, F.char_length(rest))
    lowered = F.translate(host, upper, upper.lower())
    text = F.when(found > 0, F.concat(lowered, after)).otherwise(url)
    return lowered, F.regexp_extract(after, r"(?s)\A[^?#]*", 0), text


def rule_of(host: Column, path: Column, rules: dict[str, str]) -> Column:
    """The longest rule that fits, or null."""
    fits = F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda r: (len(r), r)):
        name, _, start = rule.partition("/")
        in_host = (host == name) | host.endswith(f".{name}")
        fits = F.when(in_host & path.startswith(f"/{start}"), F.lit(rule)).otherwise(fits)
    return fits


def _grams(texts: DataFrame) -> DataFrame:
    """A row for each character with the ``ORDER`` before it; the end counts."""
    padded = F.concat(F.lit(START * ORDER), "text", F.lit(END))
    split = texts.withColumn("__chars", F.regexp_extract_all(padded, F.lit("(?s)."), F.lit(0)))
    places = F.sequence(F.lit(0), F.size("__chars") - ORDER - 1)
    gram = F.transform(
        places, lambda i: F.concat(*(F.get("__chars", i + k) for k in range(ORDER + 1)))
    )
    kept = [c for c in texts.columns if c != "text"]
    return split.select(*kept, F.explode(gram).alias("gram"))


def _suffixes(grams: DataFrame) -> DataFrame:
    """``gram`` with its suffixes ``s`` of 1 to ORDER + 1 characters and their contexts."""
    ends = F.array(
        *(
            F.struct(
                F.lit(k).alias("k"),
                F.substring("gram", ORDER + 1 - k, k + 1).alias("s"),
                F.substring("gram", ORDER + 1 - k, k).alias("context"),
            )
            for k in range(ORDER + 1)
        )
    )
    return grams.select(*grams.columns, F.inline(ends))


def model(labelled: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Counts by suffix and by context of ``text, n, accepted``."""
    grams = _grams(labelled).groupBy("gram").agg(
        F.sum(F.when(F.col("accepted"), F.col("n")).otherwise(0)).alias("a"),
        F.sum(F.when(F.col("accepted"), 0).otherwise(F.col("n"))).alias("r"),
    )
    grams = written(grams, "url-grams")
    suffixes = _suffixes(grams).groupBy("s", "context").agg(F.sum("a").alias("a"), F.sum("r").alias("r"))
    contexts = suffixes.groupBy("context").agg(
        F.sum("a").alias("na"),
        F.sum("r").alias("nr"),
        F.count_if(F.col("a") > 0).alias("ta"),
        F.count_if(F.col("r") > 0).alias("tr"),
    )
    return suffixes.select("s", "a", "r"), contexts


def ratios(grams: DataFrame, suffixes: DataFrame, contexts: DataFrame) -> DataFrame:
    """``gram, ratio``: the log-likelihood difference of each gram's last character.

    Every gram asks for the empty context, and many for those of one character: they
    are few rows, so each has copies that share the asking."""
    short, salts = F.col("k") <= 1, F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))
    salt = F.when(short, F.pmod(F.xxhash64("gram"), F.lit(SALTS))).otherwise(0).cast("int")
    asked = _suffixes(grams).withColumn("salt", salt)

    def copied(rows: DataFrame, few: Column) -> DataFrame:
        more = rows.filter(few).withColumn("salt", salts)
        return more.unionByName(rows.filter(~few).withColumn("salt", F.lit(0)))

    suffixes = copied(suffixes, F.char_length("s") <= 2)
    contexts = copied(contexts, F.char_length("context") <= 1)
    seen = asked.join(suffixes, ["s", "salt"], "left").join(contexts, ["context", "salt"], "left")
    levels = seen.groupBy("gram").agg(
        F.array_sort(F.collect_list(F.struct("k", "a", "na", "ta", "r", "nr", "tr"))).alias("levels")
    )

    def refined(before: Column, count: Column, total: Column, kinds: Column) -> Column:
        mixed = (F.coalesce(count, F.lit(0)) + kinds * before) / (total + kinds)
        return F.when(F.coalesce(total, F.lit(0)) > 0, mixed).otherwise(before)

    def step(p: Column, x: Column) -> Column:
        return F.struct(
            refined(p["a"], x["a"], x["na"], x["ta"]).alias("a"),
            refined(p["r"], x["r"], x["nr"], x["tr"]).alias("r"),
        )

    uniform = F.lit(1.0 / ALPHABET)
    start = F.struct(uniform.alias("a"), uniform.alias("r"))
    ratio = F.aggregate("levels", start, step, lambda p: F.ln(p["a"]) - F.ln(p["r"]))
    return levels.select("gram", ratio.cast(RATIO).alias("ratio"))


def threshold(bins: list[tuple[int, int, int]]) -> int:
    """The bin from which to allow, of ``bin, accepted, rejected`` counts.

    Least balanced error; among equals the one nearest to 0, then the lower.
    """
    accepted, rejected = sum(b[1] for b in bins), sum(b[2] for b in bins)
    if not accepted or not rejected:
        return 0
    lost, passed, place = 0, rejected, 0
    ordered = sorted(bins)
    best = None
    for cut in range(-LARGEST, LARGEST + 2):
        while place < len(ordered) and ordered[place][0] < cut:
            lost += ordered[place][1]
            passed -= ordered[place][2]
            place += 1
        error = (lost * rejected + passed * accepted, abs(cut), cut)
        best = error if best is None or error < best else best
    return best[2]


def judge(
    pages: DataFrame, url: str = "url", rules: dict[str, str] | None = None
) -> DataFrame:
    """``pages`` with ``host, path, rule, score, verdict``; names in use are replaced."""
    rules = RULES if rules is None else rules
    added = ("host", "path", "rule", "score", "verdict")
    kept = [c for c in pages.columns if c not in added]
    value = F.col(f"`{url}`")
    host, path, scored_text = parts_of(value)
    whole = ["__host", "__path", "__text"]
    parts = pages.select(
        *(f"`{c}`" for c in kept),
        *(c.alias(n) for c, n in zip((host, path, scored_text), whole, strict=True)),
    )
    decided = rule_of(F.col("__host"), F.col("__path"), rules)
    allowed = decided.isin([r for r, v in rules.items() if v == "allow"])
    texts = parts.groupBy(*whole).agg(F.count("*").alias("n"))
    texts = texts.select(
        F.monotonically_increasing_id().alias("id"),
        *whole,
        F.col("__text").alias("text"),
        "n",
        allowed.alias("accepted"),
        # The first hexadecimal digit of a hash: a quarter is held out.
        F.md5(F.col("__text").cast("binary")).substr(1, 1).isin(list("0123")).alias("held_out"),
    )
    texts = written(texts, "urls")
    labelled = texts.filter("accepted IS NOT NULL")
    suffixes, contexts = model(labelled.filter("NOT held_out").select("text", "n", "accepted"))
    places = _grams(texts.select("id", "text"))
    # Written, so that the places of a frequent gram can be split in the join.
    known = written(ratios(places.select("gram").distinct(), suffixes, contexts), "ratios")
    sums = places.join(known, "gram").groupBy("id").agg(F.sum("ratio").alias("total"))
    scored = texts.join(sums, "id").withColumn(
        "score", (F.col("total") / (F.char_length("text") + 1)).cast(RATIO)
    )
    bin_of = F.greatest(F.lit(-LARGEST), F.least(F.lit(LARGEST), F.floor(F.col("score") * BINS).cast("int")))
    held = (*whole, "n", "accepted", "held_out", "score")
    scored = written(scored.select(*held, bin_of.alias("bin")), "scores")
    bins = (
        scored.filter("held_out AND accepted IS NOT NULL")
        .groupBy("bin")
        .agg(
            F.sum(F.when(F.col("accepted"), F.col("n")).otherwise(0)),
            F.sum(F.when(F.col("accepted"), 0).otherwise(F.col("n"))),
        )
        .collect()
    )  # at most 2 * LARGEST + 1 rows
    cut = threshold([tuple(b) for b in bins])
    judged = scored.select(*whole, F.round("score", 6).cast("double").alias("score"), "bin")
    by_rule = F.coalesce(*(F.when(F.col("rule") == r, F.lit(v)) for r, v in rules.items()), F.lit(None).cast("string"))
    by_model = F.when(F.col("bin") >= cut, "allow").otherwise("block")
    return (
        parts.join(judged, whole)
        .withColumn("rule", decided)
        .select(
            *(f"`{c}`" for c in kept),
            F.col("__host").alias("host"),
            F.col("__path").alias("path"),
            "rule",
            "score",
            F.coalesce(by_rule, by_model).alias("verdict"),
        )
    )
