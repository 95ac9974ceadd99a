"""Document fingerprints: bottom-k sketches of word shingles.

A text's sketch is the ``k`` smallest distinct hashes of its shingles, as sorted
non-negative 63-bit numbers. Sketches of parts merge into the sketch of the
whole, and estimate resemblance, containment and the number of distinct
shingles; below ``k`` shingles they hold all of them and the figures are exact.

Words are lower-cased (A-Z); a text of fewer words than a shingle is one
shingle, one without words has an empty sketch, and so has null. Two empty
sketches resemble fully, an empty and another not at all.
"""

from __future__ import annotations

import base64
import hashlib
import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from daybook.llm.common import column, slices

K = 128
#: Groups that a task merges at a time before the shuffle.
GROUPS_AT_ONCE = 1 << 12
SHINGLE = 5
_RANGE = float(1 << 63)
#: Odd multipliers, one per place in a shingle, and those of the final mix.
_PLACE = 0x9E3779B97F4A7C15
_MIX = (0xBF58476D1CE4E5B9, 0x94D049BB133111EB)


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * np.uint64(_MIX[0])
    h = (h ^ (h >> np.uint64(27))) * np.uint64(_MIX[1])
    return h ^ (h >> np.uint64(31))


def shingle_hashes(text: bytes, size: int = SHINGLE) -> np.ndarray:
    words = text.lower().split()
    if not words:
        return np.zeros(0, dtype=np.int64)
    hashes = np.array(list(map(xxhash.xxh3_64_intdigest, words)), dtype=np.uint64)
    width = min(size, len(words))
    count = len(words) - width + 1
    total = np.full(count, width, dtype=np.uint64)
    for place in range(width):
        factor = np.uint64(pow(_PLACE, place + 1, 1 << 64) | 1)
        total += hashes[place : place + count] * factor
    return (_mixed(total) >> np.uint64(1)).view(np.int64)


def sketch(text: bytes, k: int = K, size: int = SHINGLE) -> np.ndarray:
    return np.unique(shingle_hashes(text, size))[:k]


def merge(a: np.ndarray, b: np.ndarray, k: int = K) -> np.ndarray:
    return np.union1d(a, b)[:k]


def resemblance(a: np.ndarray, b: np.ndarray, k: int = K) -> float:
    """Estimated share of common shingles among all of both texts."""
    both = np.union1d(a, b)[:k]
    if not len(both):
        return 1.0
    common = np.intersect1d(a, b, assume_unique=True)
    return float(np.count_nonzero(np.isin(both, common, assume_unique=True)) / len(both))


def distinct(a: np.ndarray, k: int = K) -> float:
    """Estimated number of distinct shingles."""
    return float(len(a)) if len(a) < k else (k - 1) / (float(a[k - 1]) / _RANGE)


def containment(a: np.ndarray, b: np.ndarray, k: int = K) -> float:
    """Estimated share of the shingles of ``a`` that ``b`` has too."""
    own = distinct(a, k)
    if not own:
        return 1.0
    return min(1.0, resemblance(a, b, k) * distinct(merge(a, b, k), k) / own)


def as_text(a: np.ndarray) -> str:
    return base64.b64encode(a.astype(">i8").tobytes()).decode()


def with_sketches(
    rows: DataFrame, text: str = "text", name: str = "sketch", k: int = K, size: int = SHINGLE
) -> DataFrame:
    """``rows`` with the sketch (array<bigint>) in place of the text."""
    rest = [c for c in rows.columns if c not in (text, name)]
    schema = T.StructType([rows.schema[c] for c in rest]).add(name, T.ArrayType(T.LongType()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, text):
            texts = column(part, text).to_pylist()
            found = [sketch((t or "").encode(), k, size) for t in texts]
            columns = [column(part, c) for c in rest] + [pa.array(found, pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays(columns, names=[*rest, name])

    return rows.select(*(f"`{c}`" for c in [*rest, text])).mapInArrow(run, schema)


def merged(sketches: DataFrame, by: list[str], name: str = "sketch", k: int = K) -> DataFrame:
    """One sketch per group of parts: ``by`` and the sketch.

    Every task first merges its parts of a group into one sketch, for ``GROUPS_AT_ONCE``
    groups at a time; then a group's sketches are merged one after the other as they
    come. No step holds more of a group than ``k`` numbers and the part it adds.
    """
    schema = T.StructType([sketches.schema[c] for c in by]).add(name, T.ArrayType(T.LongType()))

    def batch(held: dict[tuple, np.ndarray], like: pa.RecordBatch) -> pa.RecordBatch:
        kinds = [like.schema.field(c).type for c in by]
        keys = zip(*held, strict=True) if by else ()
        columns = [pa.array(c, t) for c, t in zip(keys, kinds, strict=True)]
        lists = pa.array(list(held.values()), pa.list_(pa.int64()))
        return pa.RecordBatch.from_arrays([*columns, lists], names=[*by, name])

    def run(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[pa.RecordBatch]:
        held: dict[tuple, np.ndarray] = {}
        part = None
        for part in batches:
            columns = [column(part, c).to_pylist() for c in by]
            keys = zip(*columns, strict=True) if by else itertools.repeat((), part.num_rows)
            for key, found in zip(keys, column(part, name).to_pylist(), strict=True):
                own = np.array(found or [], dtype=np.int64)
                if key not in held and len(held) >= most:
                    yield batch(held, part)
                    held = {}
                held[key] = merge(held.get(key, own[:0]), own, k)
        if held:
            yield batch(held, part)

    columns = sketches.select(*(f"`{c}`" for c in [*by, name]))
    partial = columns.mapInArrow(lambda batches: run(batches, GROUPS_AT_ONCE), schema)
    keys = [F.col(f"`{c}`") for c in by]
    gathered = partial.repartition(*keys).sortWithinPartitions(*keys) if by else partial.coalesce(1)
    return gathered.mapInArrow(lambda batches: run(batches, 1), schema)


def with_next(
    rows: DataFrame, ident: str = "doc_id", text: str = "text", ranges: int | None = None
) -> DataFrame:
    """The rows dealt by ranges of descending id, each range followed by the row
    that comes after it (``ahead`` = 1), sorted so that a task meets both in turn.

    After the last row comes the first. Equal ids are ordered by a hash of their
    text, null ids come last. The texts are shuffled once; the driver holds one
    id per range.
    """
    spark = rows.sparkSession
    ranges = ranges or 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    base = rows.select(
        F.col(f"`{ident}`").cast("bigint").alias("ident"),
        F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text"),
    )
    probabilities = [i / ranges for i in range(1, ranges)]
    edges = base.select("ident").approxQuantile("ident", probabilities, 1 / (4 * ranges))
    splits = [float("-inf"), *sorted(set(edges) or {0.0}), float("inf")]
    cut = Bucketizer(splits=splits, inputCol="at", outputCol="found", handleInvalid="keep")
    # Descending: the highest ids are range 0; null ids are the last range.
    last = len(splits) - 1
    placed = cut.transform(base.withColumn("at", F.col("ident").cast("double"))).select(
        "ident",
        "text",
        F.when(F.col("ident").isNull(), last).otherwise(last - 1 - F.col("found")).cast("int").alias("range"),
    )
    heads = sorted(
        tuple(r) for r in placed.groupBy("range").agg(F.max("ident")).collect()
    )  # one row per range
    before = [
        (place, head, heads[i - 1][0]) for i, (place, head) in enumerate(heads)
    ]
    lead = spark.createDataFrame(before, "range int, head bigint, previous int")
    joined = placed.join(F.broadcast(lead), "range", "left")
    own = F.struct(F.col("range").alias("range"), F.lit(0).alias("ahead"))
    extra = F.struct(F.col("previous").alias("range"), F.lit(1).alias("ahead"))
    copies = F.when(F.col("ident").eqNullSafe(F.col("head")), F.array(own, extra)).otherwise(F.array(own))
    spread = joined.select("ident", "text", F.inline(copies))
    order = ["range", "ahead", F.desc_nulls_last("ident"), F.xxhash64("text"), "text"]
    return spread.repartition("range").sortWithinPartitions(*order)


def edited(text: str, following: str) -> str:
    """The last half of the text replaced by as much of the next text."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


COMPARED = (
    "doc_id bigint, n_chars bigint, edited_sha256 string, fingerprint string,"
    " edited_fingerprint string, near_edited double, near_next double,"
    " contained_in_edited double, distinct_shingles double"
)


def compared_with_next(
    rows: DataFrame, ident: str = "doc_id", text: str = "text", k: int = K, size: int = SHINGLE
) -> DataFrame:
    """Each text's fingerprint beside those of its edited text and the next text."""

    def compare(ident: int | None, own: str, mine: np.ndarray, other: str, theirs: np.ndarray) -> tuple:
        changed = edited(own, other).encode()
        altered = sketch(changed, k, size)
        return (
            ident,
            len(own),
            hashlib.sha256(changed).hexdigest(),
            as_text(mine),
            as_text(altered),
            resemblance(mine, altered, k),
            resemblance(mine, theirs, k),
            containment(mine, altered, k),
            distinct(mine, k),
        )

    def as_batch(found: list[tuple]) -> pa.RecordBatch:
        kinds = [pa.int64(), pa.int64(), *[pa.string()] * 3, *[pa.float64()] * 4]
        names = [part.split()[0] for part in COMPARED.split(",")]
        return pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(zip(*found, strict=True), kinds, strict=True)], names=names
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting = None
        for part in slices(batches, "text"):
            found = []
            columns = [column(part, c).to_pylist() for c in ("range", "ahead", "ident", "text")]
            for place, ahead, ident, own in zip(*columns, strict=True):
                if ahead and waiting is None:
                    continue  # a second row with the id that follows the range
                mine = sketch(own.encode(), k, size)
                if waiting is not None:
                    found.append(compare(*waiting, own, mine))
                waiting = None if ahead else (ident, own, mine)
            if found:
                yield as_batch(found)

    return with_next(rows, ident, text).mapInArrow(run, COMPARED)
