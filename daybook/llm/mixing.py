"""Mixing sources to target weights by Poisson replication.

A source of size s (code points) with target weight w is to be repeated at the
mean rate ``epochs * total * w / s``. Each document's number of copies is the
Poisson distribution of that mean, inverted at a uniform number hashed from the
seed, its id and its text; so the mix is the same for any partitioning or rerun,
and documents are drawn independently of each other. Copies are then dealt out
by a global sort on a hash of the document and the copy's number.

Weights name some sources; the rest of the weight is shared by all others in
proportion to their size. Weights of sources without text are left out and the
others scaled up. Documents of a source without any text, which add none,
have the mean rate ``epochs``. A null source is a source of its own; null text
is empty. Repeated rows are drawn alike. All columns pass through; the number of
the copy and its place in the shuffle replace columns of their names.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from daybook.llm.common import written

SEED = 17
#: Hexadecimal digits of a hash that make a uniform number: 52 bits.
_DIGITS = 13


def _number(digest: Column) -> Column:
    return F.conv(F.substring(digest, 1, _DIGITS), 16, 10).cast("bigint")


def rates(sizes: DataFrame, weights: Mapping[str, float], epochs: float) -> DataFrame:
    """``source, size`` with ``weight`` and ``rate``; sizes is read twice."""
    if any(w < 0 for w in weights.values()) or sum(weights.values()) > 1 + 1e-9:
        raise ValueError("weights must not be negative nor sum to more than 1")
    named = F.col("source").isin(list(weights)) if weights else F.lit(False)
    named = F.coalesce(named, F.lit(False))
    wanted = F.lit(None).cast("double")
    for name, weight in weights.items():
        wanted = F.when(F.col("source") == name, F.lit(float(weight))).otherwise(wanted)
    # One row, whatever the input: the whole size, that of the unnamed, the named weight present.
    has_text = F.col("size") > 0
    total, others, present = sizes.agg(
        F.coalesce(F.sum("size"), F.lit(0)),
        F.coalesce(F.sum(F.when(~named, F.col("size"))), F.lit(0)),
        F.coalesce(F.sum(F.when(named & has_text, wanted)), F.lit(0.0)),
    ).first()
    # Without unnamed sources the named ones share all of the weight.
    scale = 1.0 / present if not others and present else 1.0
    left = 1.0 - present
    weight = F.when(named, wanted * scale).otherwise(
        F.lit(left) * F.col("size") / F.lit(float(others or 1))
    )
    rate = F.when(has_text, F.lit(float(epochs * total)) * weight / F.col("size"))
    return sizes.select(
        "source",
        "size",
        F.when(has_text, weight).otherwise(0.0).alias("weight"),
        F.coalesce(rate, F.lit(float(epochs))).alias("rate"),
    )


def _distribution(rate: Column) -> Column:
    """P(X <= k) for k = 0.. until the rest is beyond any uniform number.

    Probabilities are taken from their logarithms, so no mean underflows.
    """
    last = F.ceil(rate + 12 * F.sqrt(rate) + 30).cast("int")
    step = F.named_struct(F.lit("k"), F.lit(0), F.lit("log"), -rate, F.lit("sum"), F.exp(-rate),
                          F.lit("all"), F.array(F.exp(-rate)))

    def add(state: Column, k: Column) -> Column:
        log = state["log"] + F.ln(rate) - F.ln(k.cast("double"))
        total = state["sum"] + F.exp(log)
        return F.named_struct(F.lit("k"), k, F.lit("log"), log, F.lit("sum"), total,
                              F.lit("all"), F.array_append(state["all"], total))

    steps = F.aggregate(F.sequence(F.lit(1), last), step, add, lambda state: state["all"])
    return F.when(rate > 0, steps).otherwise(F.array(F.lit(1.0)))


def mix(
    rows: DataFrame,
    weights: Mapping[str, float],
    epochs: float = 1.0,
    seed: int = SEED,
    ident: str = "doc_id",
    text: str = "text",
    source: str = "source",
    copy: str = "copy",
    place: str = "shuffle_key",
) -> DataFrame:
    """``rows`` replicated to the target weights, in global hash order."""
    kept = [c for c in rows.columns if c not in (copy, place)]
    size = F.char_length(F.coalesce(F.col(f"`{text}`"), F.lit(""))).cast("bigint")
    sizes = rows.groupBy(F.col(f"`{source}`").cast("string").alias("source")).agg(F.sum(size).alias("size"))
    rated = rates(written(sizes, "sizes"), weights, epochs)
    drawn = rated.select(F.col("source").alias("__source"), _distribution(F.col("rate")).alias("__upto"))
    key = F.concat_ws(
        ":",
        F.lit(str(seed)),
        F.coalesce(F.col(f"`{ident}`").cast("string"), F.lit("")),
        F.md5(F.coalesce(F.col(f"`{text}`"), F.lit("")).cast("binary")),
    )
    keyed = rows.select(*(f"`{c}`" for c in kept), key.alias("__key"))
    joined = keyed.join(drawn, F.col(f"`{source}`").cast("string").eqNullSafe(F.col("__source")))
    uniform = _number(F.md5(F.col("__key").cast("binary"))) / F.lit(float(16**_DIGITS))
    counted = joined.withColumn("__uniform", uniform).withColumn(
        "__count", F.size(F.filter("__upto", lambda p: p <= F.col("__uniform")))
    )
    copies = counted.filter("__count > 0").withColumn(
        copy, F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("__count").cast("bigint")))
    )
    dealt = F.concat_ws(":", "__key", F.col(copy).cast("string"))
    return (
        copies.withColumn(place, _number(F.md5(dealt.cast("binary"))))
        .select(*(f"`{c}`" for c in kept), copy, place)
        .orderBy(place, f"`{ident}`", copy)
    )
