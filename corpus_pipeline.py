"""The corpus pipeline: quality rules, near-duplicates, long repeats, mixing, tokens.

Each stage takes what its predecessor kept, written and read again, and all but
the last return the columns of ``documents``. Texts that a later stage empties
stay as rows; a missing document has been rejected, is a near copy of one that
stayed, or was drawn zero times by the mix.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from daybook.llm import byte_bpe, mixing, quality_rules, queries, repeated_spans, simhash
from daybook.llm.common import written
from daybook.session import prepare_workers

#: Bytes from which on a string met twice is removed. Passages of more than fifty words
#: are the aim: they start at some 51 * (4 + 1) bytes, far below operator 7's own 400.
REPEAT_BYTES = 250

#: The suffix arrays, the Poisson draws by text and the merges are beyond SQL.
ORACLE_SQL = None


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality_rules.kept_rows(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    prepare_workers(spark)
    return simhash.one_of_each(docs)


def long_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    prepare_workers(spark)
    others = F.struct(*(F.col(f"`{c}`") for c in docs.columns if c != "text"))
    packed = docs.select(others.alias("others"), "text")
    kept = repeated_spans.without_repeats(packed, length=REPEAT_BYTES, as_text=True)
    new = {"text": F.col("kept"), "n_chars": F.char_length("kept").cast("bigint")}
    return kept.select(*(new.get(c, F.col("others")[c]).alias(c) for c in docs.columns))


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(
        docs, queries.TARGET_WEIGHTS, queries.EPOCHS, copy="__copy", place="__place"
    )
    return mixed.select(*(f"`{c}`" for c in docs.columns))


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    prepare_workers(spark)
    ranks = byte_bpe.read_ranks(public_tokenizers.path(queries.RANK_FILE))
    coded = byte_bpe.encode(docs, ranks, public_tokenizers.PATTERN, decoded="decoded")
    return coded.withColumns(
        {"n_tokens": F.size("ids").cast("bigint"), "text": F.col("decoded").cast("string")}
    ).drop("decoded")


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality_rules", quality),
    ("simhash_near_dedup", near_duplicates),
    ("suffix_array_dedup", long_repeats),
    ("poisson_mixing", mixture),
    ("byte_bpe", token_ids),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pipeline over ``documents``; the last stage is left to the caller to run."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
