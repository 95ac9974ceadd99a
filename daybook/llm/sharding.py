"""Contiguous shards of near equal bytes, cut from global prefix sums of sizes.

Rows are put in order of their id by ranges. Every range's total of bytes and rows
gives the offset at which it starts, running sums within the range give each row's
place among all bytes, and a row goes to the shard in which its middle byte falls.
A shard is thus off its target by half a row at either end at most, and holds a
contiguous stretch of the order, numbered without gaps from 0.

All of it is Spark's own functions. Only what is asked to travel does: sizes are
taken first, and rows are written narrow before they are dealt out, so the texts are
read once. Ranges are cut by id, a hash of the row and its place in the input, so
many rows of one id, or many equal rows, fall into as many ranges as they fill. What
is broadcast is one row per range and one per shard, whatever the rows.

Null texts have no bytes; every row counts one byte more, so that empty rows are
spread too. A null id comes first. Rows of one id follow by hash, and equal rows in
any order. Equal texts are not kept together: a text with a third of all copies would
leave no equal shards. No rows give no rows. Columns named like those added are
replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from daybook.llm.common import written

LAW = "bytes"


def size_of(text: str | Column) -> Column:
    """The bytes of a text and one more."""
    return (F.coalesce(F.octet_length(text), F.lit(0)) + 1).cast("bigint")


def balanced(rows: DataFrame, shards: int, ident: str = "doc_id", size: str = "size") -> DataFrame:
    """``rows`` with ``shard`` and ``slot``; ``size`` names their bytes, null being none."""
    if shards < 1:
        raise ValueError("at least one shard")
    rest = [c for c in rows.columns if c not in ("shard", "slot")]
    held = F.struct(*(F.col(f"`{c}`") for c in rest))
    keyed = rows.select(
        held.alias("held"),
        F.col(f"`{ident}`").alias("ident"),
        F.coalesce(F.col(f"`{size}`"), F.lit(0)).cast("bigint").alias("bytes"),
        F.xxhash64(F.to_json(held)).alias("tie"),
        F.monotonically_increasing_id().alias("row"),
    )
    order = [F.col("ident").asc_nulls_first(), F.col("tie"), F.col("row")]
    ranged = written(keyed, "sizes").repartitionByRange(*order)
    ranged = written(ranged.withColumn("range", F.spark_partition_id()), "ranges")

    totals = ranged.groupBy("range").agg(F.sum("bytes").alias("bytes"), F.count("*").alias("n"))
    ahead = Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    every = Window.orderBy("range").rowsBetween(
        Window.unboundedPreceding, Window.unboundedFollowing
    )
    zero = F.lit(0).cast("bigint")
    offsets = totals.select(  # one row per range
        "range",
        F.coalesce(F.sum("bytes").over(ahead), zero).alias("bytes_ahead"),
        F.coalesce(F.sum("n").over(ahead), zero).alias("rows_ahead"),
        F.sum("bytes").over(every).alias("all_bytes"),
    )
    running = Window.partitionBy("range").orderBy(*order)
    placed = ranged.select(
        "held",
        "range",
        "bytes",
        F.sum("bytes").over(running.rowsBetween(Window.unboundedPreceding, 0)).alias("end"),
        (F.row_number().over(running) - 1).cast("bigint").alias("number"),
    ).join(F.broadcast(offsets), "range")
    # Twice the middle byte of the row, in whole numbers of any length.
    middle = (2 * (F.col("bytes_ahead") + F.col("end")) - F.col("bytes")).cast("decimal(38,0)")
    span = (2 * F.greatest("all_bytes", F.lit(1))).cast("decimal(38,0)")
    numbered = placed.select(
        "held",
        (F.col("rows_ahead") + F.col("number")).alias("place"),
        F.least(F.floor(middle * shards / span), F.lit(shards - 1)).cast("int").alias("shard"),
    )
    numbered = written(numbered, "places")
    firsts = numbered.groupBy("shard").agg(F.min("place").alias("first"))  # one row per shard
    return numbered.join(F.broadcast(firsts), "shard").select(
        "held.*", "shard", (F.col("place") - F.col("first")).alias("slot")
    )


def write(
    rows: DataFrame,
    path: str,
    shards: int,
    ident: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """Whole rows as Parquet folders ``shard=0``, ``shard=1`` and so on below ``path``.

    Files of a shard follow each other by name, and rows within them by ``slot``. A
    shard is written by several tasks, as its rows are dealt out by ranges again.
    """
    sized = rows.withColumn("__size", size_of(F.col(f"`{text}`")))
    dealt = balanced(sized, shards, ident, "__size").drop("__size")
    ordered = dealt.repartitionByRange("shard", "slot").sortWithinPartitions("shard", "slot")
    ordered.write.partitionBy("shard").parquet(path)
    spark = rows.sparkSession
    return spark.read.schema(dealt.schema).parquet(path)
