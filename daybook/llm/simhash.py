"""SimHash near-duplicates, compared as bit planes.

A text's fingerprint takes one bit from the majority of its shingles' XXH64.
Two fingerprints link if at most ``radius`` bits differ, and a document's class
is the connected component of its fingerprint.

Links are found exactly. 64 bits are cut into ``radius + exact`` blocks; a pair
within the radius agrees in ``exact`` of them, so each fingerprint is filed
under every choice of ``exact`` blocks. A file of more than ``UNIT``
fingerprints is cut into parts that meet in pairs. What meets is compared as
vertical bit planes: one XOR per plane and query, carry-save counters over 64
lanes a word, and queries are given up once all their lanes exceed the radius.

Equal fingerprints are one node, so copies cost nothing; a unit gives a
spanning forest of its links, not its pairs. With ``exact`` = 2 a file holds
about D / 2^21 of D unrelated fingerprints; beyond some 10^9 documents take 3.

Null and empty texts have fingerprint 0 and link like any other. A null id is
never the smallest; a class of null ids only has a null class id.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from daybook.llm.common import column, slices, utf8_texts, written
from daybook.llm.components import roots

UNIT = 2048
TILE = 1024
ROWS_AT_ONCE = 1 << 15
_FULL = np.uint64(0xFFFFFFFFFFFFFFFF)


def shingle_hashes(text: bytes, size: int) -> np.ndarray:
    """XXH64 (seed 42) of each run of ``size`` words, joined by one space."""
    words = text.lower().split()
    joined = b" ".join(words)
    if len(words) <= size:
        hashes = [xxhash.xxh64_intdigest(joined, 42)] if words else []
    else:
        ends = list(itertools.accumulate(map(len, words), lambda at, n: at + n + 1))
        digest = xxhash.xxh64_intdigest
        hashes = [digest(joined[: ends[size - 1]], 42)]
        hashes += [digest(joined[a + 1 : b], 42) for a, b in zip(ends, ends[size:], strict=False)]
    return np.array(hashes, dtype=np.uint64)


def majority(hashes: np.ndarray) -> int:
    """Bits set in over half of the hashes, as a signed 64-bit number."""
    counts = np.zeros(64, dtype=np.int64)
    for start in range(0, len(hashes), ROWS_AT_ONCE):
        part = hashes[start : start + ROWS_AT_ONCE]
        bits = np.unpackbits(part.view(np.uint8).reshape(len(part), 8), axis=1, bitorder="little")
        counts += bits.sum(axis=0, dtype=np.int64)
    packed = np.packbits(2 * counts > len(hashes), bitorder="little")
    return int(packed.view(np.int64)[0])


def with_fingerprints(rows: DataFrame, text: str = "text", size: int = 4) -> DataFrame:
    """``rows`` without the text, with ``fingerprint`` as bigint."""
    rest = [c for c in rows.columns if c not in (text, "fingerprint")]
    schema = T.StructType([rows.schema[c] for c in rest]).add("fingerprint", T.LongType())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, text):
            prints = [majority(shingle_hashes(t, size)) for t in utf8_texts(column(part, text))]
            columns = [column(part, c) for c in rest] + [pa.array(prints, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, names=[*rest, "fingerprint"])

    return rows.select(*(f"`{c}`" for c in [*rest, text])).mapInArrow(run, schema)


def bit_planes(prints: np.ndarray) -> np.ndarray:
    """(64, words): word w of plane b holds bit b of fingerprints 64w to 64w + 63."""
    lanes = -(-len(prints) // 64) * 64
    padded = np.zeros(lanes, dtype=np.uint64)
    padded[: len(prints)] = prints
    bits = np.unpackbits(padded.view(np.uint8).reshape(lanes, 8), axis=1, bitorder="little")
    packed = np.packbits(np.ascontiguousarray(bits.T), axis=1, bitorder="little")
    return np.ascontiguousarray(packed).view(np.uint64)


def _above(counter: list[np.ndarray], radius: int) -> np.ndarray:
    """Lanes whose binary counter exceeds ``radius``."""
    above, equal = np.zeros_like(counter[0]), np.full_like(counter[0], _FULL)
    for k in reversed(range(len(counter))):
        if radius >> k & 1:
            equal &= counter[k]
        else:
            above |= equal & counter[k]
            equal &= ~counter[k]
    return above


def near(
    queries: np.ndarray, planes: np.ndarray, lanes: int, radius: int
) -> tuple[np.ndarray, np.ndarray]:
    """Rows of ``queries`` with a lane within ``radius``, and a lane mask for each."""
    words = planes.shape[1]
    unused = np.packbits(np.arange(words * 64) >= lanes, bitorder="little").view(np.uint64)
    rows = np.arange(len(queries))
    over = np.repeat(unused[None, :], len(rows), axis=0)
    counter = [np.zeros_like(over) for _ in range(max(1, radius.bit_length()))]
    for bit in range(64):
        asked = (np.uint64(0) - ((queries[rows] >> np.uint64(bit)) & np.uint64(1)))[:, None]
        carry = planes[bit] ^ asked
        for c in counter:
            both = c & carry
            c ^= carry
            carry = both
        over |= carry
        if bit % 8 == 7:
            dead = over | _above(counter, radius)
            alive = (dead != _FULL).any(axis=1)
            if not alive.any():
                return rows[:0], over[:0]
            if 2 * alive.sum() < len(rows):
                rows, over = rows[alive], over[alive]
                counter = [c[alive] for c in counter]
    return rows, ~(over | _above(counter, radius))


def forest(prints: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Links (higher, lower) that span the components of distinct fingerprints."""
    prints = np.sort(prints)
    label = np.arange(len(prints))
    planes = bit_planes(prints.view(np.uint64))
    for start in range(0, len(prints), 256):
        queries = prints[start : start + 256].view(np.uint64)
        rows, masks = near(queries, planes, len(prints), radius)
        for row, mask in zip(rows + start, masks, strict=True):
            lanes = np.flatnonzero(np.unpackbits(mask.view(np.uint8), bitorder="little"))
            if len(lanes) < 2:
                continue
            old = np.unique(label[np.append(lanes, row)])
            if len(old) > 1:
                label[np.isin(label, old)] = old[0]
    high = np.flatnonzero(label != np.arange(len(label)))
    return prints[high], prints[label[high]]


def _filed(nodes: DataFrame, radius: int, exact: int) -> DataFrame:
    """Each fingerprint once per choice of ``exact`` of the blocks: file, key, fp."""
    blocks = radius + exact
    edges = [64 * i // blocks for i in range(blocks + 1)]
    masks = [((1 << b) - 1) ^ ((1 << a) - 1) for a, b in itertools.pairwise(edges)]
    files = []
    for n, chosen in enumerate(itertools.combinations(masks, exact)):
        mask = sum(chosen)
        mask -= 1 << 64 if mask >> 63 else 0
        key = F.col("fp").bitwiseAND(F.lit(mask).cast("bigint"))
        files.append(F.struct(F.lit(n).alias("file"), key.alias("key")))
    return nodes.select("fp", F.inline(F.array(*files)))


def links(nodes: DataFrame, radius: int = 4, exact: int = 2, unit: int = UNIT) -> DataFrame:
    """``u, v``: links that span the components of distinct fingerprints (``fp``)."""
    filed = _filed(nodes, radius, exact)
    sizes = filed.groupBy("file", "key").agg(F.count("*").alias("n")).filter("n > 1")
    parts = F.ceil(F.col("n") / unit).cast("int")
    met = filed.join(sizes, ["file", "key"]).withColumn("parts", parts)
    own = F.pmod(F.xxhash64("fp"), "parts").cast("int")
    # Part i of a large file meets every other part; a small file is one unit.
    others = F.filter(F.sequence(F.lit(0), F.col("parts") - 1), lambda j: j != F.col("own"))
    met = met.withColumn("own", own).withColumn(
        "other",
        F.explode(F.when(F.col("parts") == 1, F.array(F.lit(0))).otherwise(others)),
    )
    group = ["file", "key", "a", "b"]
    met = met.select(
        "file",
        "key",
        F.least("own", "other").alias("a"),
        F.greatest("own", "other").alias("b"),
        "fp",
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Whole units, several small ones to a tile: any link found is a link."""
        held: list[np.ndarray] = []
        for batch in itertools.chain(batches, [None]):
            if batch is not None and batch.num_rows:
                values = np.stack([column(batch, c).to_numpy() for c in (*group, "fp")], axis=1)
                held.append(values)
            rows = np.concatenate(held) if held else np.zeros((0, 5), dtype=np.int64)
            held = []
            if not len(rows):
                continue
            new = np.flatnonzero((rows[1:, :4] != rows[:-1, :4]).any(axis=1)) + 1
            # The last unit of a batch may go on in the next one.
            ends = [*new.tolist(), *([len(rows)] if batch is None else [])]
            start = at = 0
            for end in ends:
                if end - start > TILE and at > start:
                    yield from linked(rows[start:at, 4])
                    start = at
                at = end
            if batch is None:
                yield from linked(rows[start:, 4])
            else:
                if at > start:
                    yield from linked(rows[start:at, 4])
                held = [rows[at:]]

    def linked(prints: np.ndarray) -> Iterator[pa.RecordBatch]:
        u, v = forest(np.unique(prints), radius)
        if len(u):
            yield pa.RecordBatch.from_arrays([pa.array(u), pa.array(v)], names=["u", "v"])

    spread = met.repartition(*group).sortWithinPartitions(*group)
    return spread.mapInArrow(run, "u bigint, v bigint").distinct()


def classes(prints: DataFrame, ident: str = "doc_id", radius: int = 4, exact: int = 2) -> DataFrame:
    """``prints`` (an id and ``fingerprint``) with ``component_id`` and ``root``.

    ``root`` is the component's lowest fingerprint, so it tells classes apart
    whose ids are null or repeated. ``prints`` is read several times: give a
    written table.
    """
    nodes = prints.groupBy(F.col("fingerprint").alias("fp")).agg(F.min(ident).alias("low"))
    above = roots(links(nodes.select("fp"), radius, exact))
    rooted = nodes.join(above, F.col("fp") == F.col("node"), "left").select(
        "fp", "low", F.coalesce("root", "fp").alias("root")
    )
    lowest = rooted.groupBy("root").agg(F.min("low").alias("component_id"))
    known = rooted.join(lowest, "root").select(
        F.col("fp").alias("fingerprint"), "component_id", "root"
    )
    return prints.join(known, "fingerprint", "left")


def one_of_each(
    rows: DataFrame, ident: str = "doc_id", text: str = "text", size: int = 4, radius: int = 4
) -> DataFrame:
    """One whole row of each class: one that carries the smallest id."""
    packed = written(
        rows.select(
            F.monotonically_increasing_id().alias("row"),
            F.struct(*(F.col(f"`{c}`") for c in rows.columns)).alias("held"),
        ),
        "rows",
    )
    keys = packed.select(
        "row", F.col(f"held.`{ident}`").alias("ident"), F.col(f"held.`{text}`").alias("text")
    )
    prints = written(with_fingerprints(keys, "text", size), "fingerprints")
    found = classes(prints, "ident", radius)
    first = found.filter(F.col("ident").eqNullSafe(F.col("component_id")))
    kept = first.groupBy("root").agg(F.min("row").alias("row"))
    return packed.join(kept, "row", "left_semi").select("held.*")
