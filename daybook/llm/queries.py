"""One query per operator, over the whole of its table."""

from __future__ import annotations

import hashlib
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from daybook.llm import (
    byte_bpe,
    conversation_trie,
    fingerprints,
    mixing,
    quality_rules,
    repeated_spans,
    sharding,
    simhash,
    suffix_tree_lm,
    token_files,
    url_filter,
    vector_codes,
    warc,
)
from daybook.llm.common import written
from daybook.session import shared_folder, prepare_workers

# Shares of the mix; the sources not named share the rest by size.
TARGET_WEIGHTS = {"src0": 0.25, "src1": 0.08, "src2": 0.08, "src3": 0.04}
EPOCHS = 1.0
RANK_FILE = "byte_bpe_multi_50k.tiktoken"
WORD_FILE = "word_bpe_49k.json"
END_OF_DOCUMENT = 2
# A rebuilt conversation takes up to five turns of the first one of its hundred.
FAMILY, MOST_TAKEN = 100, 5
SHARDS = 8


def _read(spark: SparkSession, folder: str, table: str) -> DataFrame:
    prepare_workers(spark)
    return spark.read.parquet(f"{folder}/{table}.parquet")


def op1_fingerprints(spark: SparkSession, folder: str) -> DataFrame:
    return fingerprints.compared_with_next(_read(spark, folder, "documents"))


def op2_simhash_dedup(spark: SparkSession, folder: str) -> DataFrame:
    rows = _read(spark, folder, "documents").select("doc_id", "text")
    prints = written(simhash.with_fingerprints(rows), "fingerprints")
    found = simhash.classes(prints)
    shown = F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint")
    return found.select("doc_id", shown, "component_id")


def op3_poisson_mixing(spark: SparkSession, folder: str) -> DataFrame:
    return mixing.mix(_read(spark, folder, "documents"), TARGET_WEIGHTS, EPOCHS)


def op4_url_filter(spark: SparkSession, folder: str) -> DataFrame:
    judged = url_filter.judge(_read(spark, folder, "pages").select("page_id", "url"))
    return judged.select("page_id", "host", "path", "rule", "score", "verdict")


def op5_warc(spark: SparkSession, folder: str) -> DataFrame:
    archives = warc.write(_read(spark, folder, "pages"), shared_folder(spark, "warc"))
    found = warc.read(archives, payload=False)
    return found.select(
        F.col("record_id").try_cast("bigint").alias("page_id"),
        "payload_bytes",
        "payload_digest",
        "record_type",
        F.col("refers_to").try_cast("bigint").alias("refers_to"),
    )


def op6_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    rows = _read(spark, folder, "documents").select("doc_id", "text")
    judged = quality_rules.judge(rows)
    return judged.select("doc_id", *quality_rules.COUNTS, "base_failed", "failed_rules", "kept")


def op7_suffix_array_dedup(spark: SparkSession, folder: str) -> DataFrame:
    rows = _read(spark, folder, "documents").select("doc_id", "text")
    found = repeated_spans.without_repeats(rows)
    removed = F.aggregate("spans", F.lit(0).cast("bigint"), lambda n, s: n + s["end"] - s["start"])
    return found.select(
        "doc_id",
        (F.octet_length("kept") + removed).cast("bigint").alias("n_bytes"),
        removed.alias("n_removed"),
        F.size("spans").cast("bigint").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
        # What is left, to be read; half code points at a cut are replaced.
        F.make_valid_utf8(F.col("kept").cast("string")).alias("text"),
    )


def op8_byte_bpe(spark: SparkSession, folder: str) -> DataFrame:
    rows = _read(spark, folder, "documents").select("doc_id", "text")
    ranks = byte_bpe.read_ranks(public_tokenizers.path(RANK_FILE))
    encoded = byte_bpe.encode(rows, ranks, public_tokenizers.PATTERN)
    back = byte_bpe.decode(
        encoded.withColumn("n_tokens", F.size("ids").cast("bigint")), ranks, packed="packed"
    )
    return back.select(
        "doc_id",
        "n_tokens",
        F.sha2("packed", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op9_suffix_tree_lm(spark: SparkSession, folder: str) -> DataFrame:
    scored = suffix_tree_lm.score(_read(spark, folder, "documents").select("doc_id", "text"))
    return scored.select(
        "doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"
    )


def op10_token_files(spark: SparkSession, folder: str) -> DataFrame:
    rows = _read(spark, folder, "documents").select("doc_id", "text")
    with open(public_tokenizers.path(WORD_FILE), encoding="utf-8") as file:
        model = file.read()
    path = shared_folder(spark, "token-files")
    token_files.write(token_files.encoded(rows, model, END_OF_DOCUMENT), path)
    bases = token_files.starts(spark, path)
    sums = token_files.with_checksums(token_files.read(spark, path))
    return sums.join(bases, "shard").select(
        "doc_id", (F.col("base") + F.col("at")).alias("start"), "n_tokens", "ids_crc32"
    )


def op11_conversation_trie(spark: SparkSession, folder: str) -> DataFrame:
    turns = _read(spark, folder, "conversations").select("conv_id", "turn", "role", "text")
    own = written(conversation_trie.sequences(turns), "conversations")
    ident = F.col("conv_id")
    taken = F.crc32(ident.cast("string").cast("binary")) % (MOST_TAKEN + 1)
    rebuilt = conversation_trie.rebuilt(
        own, ident - ident % FAMILY, taken.cast("int"), MOST_TAKEN
    )
    return conversation_trie.trie(rebuilt)


def op12_vector_codes(spark: SparkSession, folder: str) -> DataFrame:
    rows = _read(spark, folder, "embeddings").select("vec_id", "label", "embedding")
    coded, books = vector_codes.compressed(rows)
    listed = ",".join(str(x) for book in books for entry in book.tolist() for x in entry)
    summed = vector_codes.with_group_error(written(coded, "codes"))
    digest = F.lit(hashlib.sha256(listed.encode()).hexdigest()).alias("codebooks_sha256")
    return summed.select("vec_id", "code", "error", "label_error", digest)


def op13_sharding(spark: SparkSession, folder: str) -> DataFrame:
    text = F.coalesce("text", F.lit("")).cast("binary")
    sizes = spark.read.parquet(f"{folder}/documents.parquet").select(
        "doc_id", sharding.size_of("text").alias("size"), F.crc32(text).alias("text_crc32")
    )
    dealt = sharding.balanced(sizes, SHARDS)
    return dealt.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit(sharding.LAW).alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


QUERIES = (
    op1_fingerprints,
    op2_simhash_dedup,
    op3_poisson_mixing,
    op4_url_filter,
    op5_warc,
    op6_quality_rules,
    op7_suffix_array_dedup,
    op8_byte_bpe,
    op9_suffix_tree_lm,
    op10_token_files,
    op11_conversation_trie,
    op12_vector_codes,
    op13_sharding,
)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in QUERIES}
