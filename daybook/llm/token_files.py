"""Token ids as Parquet lists, in ascending document order, and their readers.

A file holds one shard: ``doc_id``, ``shard``, ``at`` (ids of the shard before
this document), ``n_tokens`` and ``ids``. Ids are dictionary-encoded, the
numbers beside them delta-encoded; row groups and pages are bounded, and the
column and offset indexes written with them let a reader of few documents, or
of the numbers only, skip the rest.

Rows are ranged and sorted by id before they are encoded, and Spark's writer
commits them, so a repeated task leaves no second copy. Null ids come first;
equal ids are ordered by their text. A null text is the empty text: only the
end id is written. Texts are split where the vocabulary's own pattern always
splits, at spaces, line ends and between a letter and common punctuation, and
A-Z are lower-cased as it does, so the ids are those of the whole text; the
tokenizer gets the different words of a slice of texts, and workers remember a
fixed number of them. Words of lower-case Latin letters only are as the tokenizer's
normalizer and pattern leave them, so they go to its merges at once. A text in which an added token of the vocabulary is
spelled, in capitals or not, is encoded whole.
"""

from __future__ import annotations

import os
import re
import zlib
from array import array
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from daybook.llm.common import column, slices

REMEMBERED, _CELLS = 1 << 18, 1 << 22
ROW_GROUP_BYTES = 16 << 20
PAGE_BYTES = 128 << 10
PAGE_ROWS = 2000
FILE_COLUMNS = "doc_id bigint, shard int, at bigint, n_tokens bigint, ids array<int>"


#: Words that normalizing and splitting leave as they are.
_PLAIN = re.compile("[a-zß-öø-ÿ]+")


def _byte_letters() -> dict[int, str]:
    """The letter of the vocabulary for each byte: itself where it can be printed,
    else the next one from U+0100 on."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in shown]
    return {b: chr(b) for b in shown} | {b: chr(256 + n) for n, b in enumerate(rest)}


class Words(dict):
    """Word -> its ids."""

    def __init__(self, model: str):
        super().__init__()
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(model)
        self.merges = self.tokenizer.model
        letters = _byte_letters()
        self.letters = {c: "".join(letters[b] for b in chr(c).encode()) for c in range(0xDF, 0x100)}
        added = [t.content.lower() for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.added = "|".join(map(re.escape, added))
        self.met = bytearray(_CELLS)

    def ids(self, words: list[str]) -> list[array]:
        """The ids of different words; those not remembered are encoded in one
        call. A word is remembered when it comes a second time, so that words
        that come once take no place."""
        known = list(map(self.get, words))
        places = [i for i, found in enumerate(known) if found is None]
        new = [words[i] for i in places]
        for i, word, ids in zip(places, new, self.merged(new), strict=True):
            known[i] = coded = array("i", ids)
            cell = hash(word) % _CELLS
            if self.met[cell] and len(self) < REMEMBERED:
                self[word] = coded
            self.met[cell] = 1
        return known

    def merged(self, words: list[str]) -> list[list[int]]:
        """The ids of words, by the merges alone where that is enough."""
        plain = [_PLAIN.fullmatch(w) is not None for w in words]
        others = [w for w, p in zip(words, plain, strict=True) if not p]
        whole = iter(self.tokenizer.encode_batch_fast(others, add_special_tokens=False))
        tokenize, letters = self.merges.tokenize, self.letters
        return [
            [t.id for t in tokenize(w if w.isascii() else w.translate(letters))]
            if p
            else next(whole).ids
            for w, p in zip(words, plain, strict=True)
        ]

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the texts, and where each text's ids end."""
        if not self.added:
            return self.by_words(texts)
        spelled = pa.compute.match_substring_regex(pa.compute.ascii_lower(texts), self.added)
        rows = np.flatnonzero(spelled.to_numpy(zero_copy_only=False))
        if not len(rows):
            return self.by_words(texts)
        ids, last = self.by_words(pa.compute.if_else(spelled, "", texts))
        whole = self.tokenizer.encode_batch_fast(texts.take(rows).to_pylist(), add_special_tokens=False)
        sizes = np.zeros(len(last), dtype=np.int64)
        sizes[rows] = [len(e.ids) for e in whole]
        values = np.concatenate([np.array(e.ids, dtype=np.int32) for e in whole])
        return np.insert(ids, np.repeat(last, sizes), values), last + np.cumsum(sizes)

    def by_words(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The same for texts in which no added token is spelled."""
        lowered = pa.compute.ascii_lower(pa.compute.replace_substring(texts, "\n", " "))
        parted = pa.compute.replace_substring_regex(lowered, "([a-z])([.,;:!?|])", r"\1 \2")
        split = pa.compute.split_pattern(parted, " ")
        words = split.flatten().dictionary_encode()
        known = self.ids(words.dictionary.to_numpy(zero_copy_only=False).tolist())
        values = np.frombuffer(b"".join(known), dtype=np.int32)
        ends = np.cumsum([0, *map(len, known)])
        lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(values))
        coded = lists.take(words.indices)
        sizes = np.append(0, np.cumsum(coded.value_lengths().to_numpy()))
        counts = pa.compute.list_value_length(split).to_numpy()
        return coded.flatten().to_numpy(), sizes[np.cumsum(counts)]


@cache
def _vocabulary(model: str) -> Words:
    return Words(model)


def encoded(
    rows: DataFrame, model: str, end: int, ident: str = "doc_id", text: str = "text"
) -> DataFrame:
    """The rows of the file format, ranged and sorted by id."""
    placed = rows.select(
        F.col(f"`{ident}`").cast("bigint").alias("doc_id"),
        F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text"),
    ).withColumn("tie", F.xxhash64("text"))
    placed = placed.repartitionByRange("doc_id", "tie").sortWithinPartitions("doc_id", "tie")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, shard, at = _vocabulary(model), TaskContext.get().partitionId(), 0
        for part in slices(batches, "text"):
            ids, last = words.encode(column(part, "text"))
            ends = np.append(0, last + np.arange(1, len(last) + 1))
            ids = np.insert(ids, last, end)
            lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(ids, pa.int32()))
            columns = [
                column(part, "doc_id"),
                pa.array(np.full(part.num_rows, shard), pa.int32()),
                pa.array(at + ends[:-1], pa.int64()),
                pa.array(np.diff(ends), pa.int64()),
                lists,
            ]
            at += int(ends[-1])
            yield pa.RecordBatch.from_arrays(
                columns, names=["doc_id", "shard", "at", "n_tokens", "ids"]
            )

    return placed.mapInArrow(run, FILE_COLUMNS)


def write(
    rows: DataFrame,
    path: str,
    row_group_bytes: int = ROW_GROUP_BYTES,
    page_bytes: int = PAGE_BYTES,
    page_rows: int = PAGE_ROWS,
) -> None:
    """Write rows of the file format, a file per shard."""
    writer = rows.write.option("compression", "zstd")
    settings = {
        "parquet.block.size": row_group_bytes,
        "parquet.page.size": page_bytes,
        "parquet.page.row.count.limit": page_rows,
        "parquet.dictionary.page.size": 1 << 20,
        "parquet.writer.version": "PARQUET_2_0",
        "parquet.enable.dictionary": "true",
    }
    for name in ("doc_id", "shard", "at", "n_tokens"):
        settings[f"parquet.enable.dictionary#{name}"] = "false"
    for name, value in settings.items():
        writer = writer.option(name, value)
    writer.parquet(path)


def read(spark: SparkSession, path: str, columns: list[str] | None = None) -> DataFrame:
    """The stored rows, or only some columns of them; filters reach the scan."""
    rows = spark.read.schema(FILE_COLUMNS).parquet(path)
    return rows.select(*columns) if columns else rows


def starts(spark: SparkSession, path: str) -> DataFrame:
    """``shard, base``: the ids in all shards before, from the numbers alone.

    One row per file goes through the single window.
    """
    totals = read(spark, path, ["shard", "n_tokens"]).groupBy("shard").agg(
        F.sum("n_tokens").alias("total")
    )
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    return totals.select(
        "shard", F.coalesce(F.sum("total").over(before), F.lit(0)).alias("base")
    )


def with_checksums(rows: DataFrame, ids: str = "ids", name: str = "ids_crc32") -> DataFrame:
    """``rows`` with the CRC-32 of their ids as little-endian numbers, without the ids."""
    rest = [c for c in rows.columns if c not in (ids, name)]
    schema = T.StructType([rows.schema[c] for c in rest]).add(name, T.LongType())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = column(batch, ids)
            values = lists.values.to_numpy().astype("<u4", copy=False)
            ends = lists.offsets.to_numpy()
            sums = [zlib.crc32(values[a:b]) for a, b in zip(ends, ends[1:], strict=False)]
            columns = [column(batch, c) for c in rest] + [pa.array(sums, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, names=[*rest, name])

    return rows.select(*(f"`{c}`" for c in [*rest, ids])).mapInArrow(run, schema)
