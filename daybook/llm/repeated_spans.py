"""Suffix-array dedup: remove every byte covered by a string of ``LENGTH`` bytes
that also starts anywhere else, exactly and at any size.

Each window of ``length`` bytes is anchored at its leftmost lowest-hashed gram of
``GRAMS[0]`` bytes. Equal windows have equal anchors, and windows that follow
each other mostly share one, so a text falls into segments, runs of windows with
one anchor. Windows can be equal only within the segments of one anchor hash:

* a hash met once has no repeated window;
* a segment met twice is repeated as a whole and stands for its copies;
* the different segments of a hash go to one shard, whose suffix array (induced
  sorting) and permuted common prefixes give the windows met twice in it.

Shards hold whole hashes up to ``SHARD_BYTES``. A hash with more bytes than that
is cut finer: its segments are treated as texts again, with anchors of the next,
longer gram. Grams of the window's own length put equal windows into equal
segments, so the last cut needs no suffix array and has no limit.

A pass gathers counts before texts: only repeated hashes are joined, one copy of
each segment is fetched, and only from texts that have one. Texts are shuffled
twice. Null text is the empty text. Equal rows are told apart from each other
(each is elsewhere for the other) but have the same result.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from daybook.llm.common import column, slices, utf8_texts, written
from daybook.llm.suffix_array import permuted_prefixes, suffix_array

LENGTH = 400
SHARD_BYTES = 1 << 19
#: Bytes of segments that a task fetches, cuts finer or builds suffix arrays of.
TASK_BYTES = 4 << 20
STRETCH = 1 << 18
_BASE = 0x9E3779B97F4A7C15
_MIX = (0xBF58476D1CE4E5B9, 0x94D049BB133111EB)
_SEGMENT = ["h", "sd", "n"]


def grams(length: int) -> tuple[int, ...]:
    """Gram lengths of the cuts, from coarse to the window itself."""
    return (min(64, length), max(1, length * 5 // 8), length)


@cache
def _powers() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Random values of the bytes, and powers of the base and of its inverse."""
    size = 2 * STRETCH + 1
    table = np.random.default_rng(7).integers(0, 1 << 64, 256, dtype=np.uint64)
    up = np.full(size, _BASE, dtype=np.uint64)
    down = np.full(size, pow(_BASE, -1, 1 << 64), dtype=np.uint64)
    up[0] = down[0] = 1
    return table, np.multiply.accumulate(up), np.multiply.accumulate(down)


def _gram_hashes(data: np.ndarray, gram: int) -> np.ndarray:
    table, up, down = _powers()
    total = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum(table[data] * up[: len(data)], out=total[1:])
    h = (total[gram:] - total[:-gram]) * down[: len(data) - gram + 1]
    h = (h ^ (h >> np.uint64(30))) * np.uint64(_MIX[0])
    h = (h ^ (h >> np.uint64(27))) * np.uint64(_MIX[1])
    return h ^ (h >> np.uint64(31))


def _window_lowest(values: np.ndarray, width: int) -> np.ndarray:
    """The minimum of each ``width`` values in a row, in two running minima."""
    count = len(values) - width + 1
    blocks = -(-len(values) // width)
    padded = np.full(blocks * width, np.uint64(0xFFFFFFFFFFFFFFFF))
    padded[: len(values)] = values
    padded = padded.reshape(blocks, width)
    ahead = np.minimum.accumulate(padded, axis=1).ravel()
    behind = np.minimum.accumulate(padded[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(behind[:count], ahead[width - 1 : width - 1 + count])


def _stretch_segments(
    data: np.ndarray, ends: np.ndarray, length: int, gram: int
) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Segments of joined texts: text number, first and last window, anchor hash."""
    hashes = _gram_hashes(data, gram)
    bits = np.uint64((1 << 20) - 1)
    packed = (hashes & ~bits) | np.arange(len(hashes), dtype=np.uint64)
    anchor = (_window_lowest(packed, length - gram + 1) & bits).astype(np.int64)
    starts = np.append(0, ends[:-1])
    counts = np.maximum(ends - starts - length + 1, 0)
    owner = np.repeat(np.arange(len(ends)), counts)
    window = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts) + starts[owner]
    at = anchor[window]
    new = np.flatnonzero(np.append(True, (at[1:] != at[:-1]) | (owner[1:] != owner[:-1])))
    last = np.append(new[1:], len(window)) - 1
    base = starts[owner[new]]
    return owner[new], window[new] - base, window[last] - base, hashes[at[new]].view(np.int64)


def segments(
    texts: list[bytes], length: int, gram: int
) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Segments of several texts, some stretch of bytes at a time."""
    held: list[int] = []
    size = 0

    def joined() -> Iterator[tuple]:
        if held:
            data = np.frombuffer(b"".join(texts[i] for i in held), dtype=np.uint8)
            ends = np.cumsum([len(texts[i]) for i in held])
            owner, first, last, h = _stretch_segments(data, ends, length, gram)
            yield np.array(held)[owner], first, last, h

    for i, text in enumerate(texts):
        if len(text) < length:
            continue
        if len(text) > STRETCH:
            # A stretch of a longer text, with the windows that start in it.
            for start in range(0, len(text) - length + 1, STRETCH):
                part = np.frombuffer(text[start : start + STRETCH + length - 1], dtype=np.uint8)
                _, first, last, h = _stretch_segments(part, np.array([len(part)]), length, gram)
                yield np.full(len(h), i), first + start, last + start, h
            continue
        if size + len(text) > STRETCH:
            yield from joined()
            held, size = [], 0
        held.append(i)
        size += len(text)
    yield from joined()


def _anchored(texts: DataFrame, length: int, gram: int) -> DataFrame:
    """A row per text and different segment: its key, size and places in the text.

    ``texts``: ``k1, k2, data``. ``h`` is the anchor's hash, ``sd`` that of the
    segment's bytes and ``n`` its number of windows.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "data"):
            raw = utf8_texts(column(part, "data"))
            k1, k2 = (column(part, c).to_numpy() for c in ("k1", "k2"))
            for owner, first, last, h in segments(raw, length, gram):
                if not len(owner):
                    continue
                sd = np.array(
                    [
                        xxhash.xxh3_64_intdigest(raw[o][a : b + length])
                        for o, a, b in zip(owner.tolist(), first.tolist(), last.tolist(), strict=True)
                    ],
                    dtype=np.uint64,
                ).view(np.int64)
                n = (last - first + 1).astype(np.int32)
                order = np.lexsort((first, n, sd, h, owner))
                owner, first, n, sd, h = owner[order], first[order], n[order], sd[order], h[order]
                new = np.append(
                    True,
                    (owner[1:] != owner[:-1]) | (h[1:] != h[:-1]) | (sd[1:] != sd[:-1]) | (n[1:] != n[:-1]),
                )
                cuts = np.flatnonzero(new)
                at = pa.ListArray.from_arrays(
                    pa.array(np.append(cuts, len(first)), pa.int32()), pa.array(first.astype(np.int32))
                )
                columns = [pa.array(x[cuts]) for x in (k1[owner], k2[owner], h, sd, n)]
                yield pa.RecordBatch.from_arrays([*columns, at], names=["k1", "k2", *_SEGMENT, "at"])

    return texts.select("k1", "k2", "data").mapInArrow(
        run, "k1 bigint, k2 bigint, h bigint, sd bigint, n int, at array<int>"
    )


def _tasks(total: int) -> int:
    """As many tasks as it takes for ``total`` bytes, so tasks neither grow nor idle: a
    task that runs Python costs some 60 ms without a row."""
    return max(1, -(-total // TASK_BYTES))


def _fetched(texts: DataFrame, wanted: DataFrame, length: int, total: int) -> DataFrame:
    """The bytes of the wanted segments: ``h, sd, n, large, data``. ``texts`` are of
    ``total`` bytes."""
    cut = F.collect_list(F.struct(*_SEGMENT, "large", "first"))
    lists = wanted.groupBy("k1", "k2").agg(cut.alias("cut"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "data"):
            raw = utf8_texts(column(part, "data"))
            rows = [
                (c["h"], c["sd"], c["n"], c["large"], text[c["first"] : c["first"] + c["n"] + length - 1])
                for text, cut in zip(raw, column(part, "cut").to_pylist(), strict=True)
                for c in cut
            ]
            kinds = (pa.int64(), pa.int64(), pa.int32(), pa.bool_(), pa.binary())
            for start in range(0, len(rows), 2000):
                columns = zip(*rows[start : start + 2000], strict=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(columns, kinds, strict=True)],
                    names=[*_SEGMENT, "large", "data"],
                )

    joined = texts.join(lists, ["k1", "k2"]).select("k1", "k2", "data", "cut").coalesce(_tasks(total))
    return joined.mapInArrow(run, "h bigint, sd bigint, n int, large boolean, data binary")


def repeated_windows(parts: list[bytes], length: int) -> list[np.ndarray]:
    """For each string, which windows are met elsewhere in these strings."""
    data = np.frombuffer(b"\0".join(parts) + b"\0", dtype=np.uint8)
    sizes = np.array([len(p) + 1 for p in parts])
    ends = np.cumsum(sizes)
    left = np.repeat(ends, sizes) - 1 - np.arange(len(data))
    text = data.astype(np.uint16) + 2
    text[ends - 1] = 1
    order = suffix_array(np.append(text, np.uint16(0)))[1:]
    before, common = permuted_prefixes(data, order, left)
    met = np.flatnonzero(common >= length)
    found = np.zeros(len(data), dtype=bool)
    found[met] = found[before[met]] = True
    return [found[e - s : e - length] for s, e in zip(sizes.tolist(), ends.tolist(), strict=True)]


def runs(flags: np.ndarray) -> list[tuple[int, int]]:
    """First and last place of each run of true flags."""
    edges = np.flatnonzero(np.diff(np.concatenate([[False], flags, [False]]).astype(np.int8)))
    return [(a, b - 1) for a, b in zip(edges[::2].tolist(), edges[1::2].tolist(), strict=True)]


_RANGES = "array<struct<a:int,b:int>>"


def _sharded(pieces: DataFrame, length: int, shard_bytes: int, total: int) -> DataFrame:
    """``h, sd, n, ranges``: repeated windows of segments of ``total`` bytes, whole hashes a
    shard."""

    def solved(keys: list[tuple], parts: list[bytes]) -> Iterator[pa.RecordBatch]:
        rows = [
            (*key, [{"a": a, "b": b} for a, b in found])
            for key, flags in zip(keys, repeated_windows(parts, length), strict=True)
            if (found := runs(flags))
        ]
        if rows:
            kinds = (pa.int64(), pa.int64(), pa.int32(), pa.list_(pa.struct([("a", pa.int32()), ("b", pa.int32())])))
            columns = zip(*rows, strict=True)
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], names=[*_SEGMENT, "ranges"]
            )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = (
            row
            for part in slices(batches, "data")
            for row in zip(*(column(part, c).to_pylist() for c in (*_SEGMENT, "data")), strict=True)
        )
        keys: list[tuple] = []
        parts: list[bytes] = []
        size = 0
        for _, group in itertools.groupby(rows, key=lambda row: row[0]):
            # A segment may come twice, from texts that share their key.
            own = {row[:3]: row[3] for row in group}
            own_size = sum(len(p) + 1 for p in own.values())
            if parts and size + own_size > shard_bytes:
                yield from solved(keys, parts)
                keys, parts, size = [], [], 0
            keys += own
            parts += own.values()
            size += own_size
        if parts:
            yield from solved(keys, parts)

    spread = pieces.repartition(_tasks(total), "h").sortWithinPartitions("h")
    return spread.mapInArrow(run, f"h bigint, sd bigint, n int, ranges {_RANGES}")


def repeated_ranges(
    texts: DataFrame, length: int, level: int = 0, shard_bytes: int = SHARD_BYTES
) -> tuple[DataFrame, int]:
    """``k1, k2, ranges``: the repeated windows of each text (``k1, k2, data``), and the
    bytes of all texts."""
    lengths, seen = grams(length), Observation()
    counted = texts.observe(seen, F.sum(F.octet_length("data").cast("bigint")).alias("bytes"))
    anchored = written(_anchored(counted, length, lengths[level]), "anchors")
    total = seen.get.get("bytes") or 0
    times = F.size("at").cast("bigint")
    often = anchored.groupBy("h").agg(F.sum(times).alias("times")).filter("times > 1")
    shared = written(anchored.join(often.select("h"), "h"), "shared-anchors")
    kinds = shared.groupBy(*_SEGMENT).agg(
        F.sum(times).alias("times"),
        *(F.first(c).alias(c) for c in ("k1", "k2")),
        F.first(F.get("at", F.lit(0))).alias("first"),
    )
    kinds = written(kinds, "segments")
    whole = F.array(F.struct(F.lit(0).alias("a"), (F.col("n") - 1).alias("b")))
    found = kinds.filter("times > 1").select(*_SEGMENT, whole.alias("ranges"))
    if level < len(lengths) - 1:
        size = F.sum((F.col("n") + length).cast("bigint"))
        sizes = kinds.groupBy("h").agg(size.alias("size"), F.count("*").alias("different"))
        several = sizes.filter("different > 1").withColumn("large", F.col("size") > shard_bytes)
        wanted = kinds.select(*_SEGMENT, "k1", "k2", "first").join(several.select("h", "large"), "h")
        bytes_of = {r["large"]: r["bytes"] for r in several.groupBy("large").agg(F.sum("size").alias("bytes")).collect()}
        small, large = (bytes_of.get(x, 0) for x in (False, True))
        pieces = written(_fetched(texts, wanted, length, total), "pieces")
        within = _sharded(pieces.filter("NOT large").drop("large"), length, shard_bytes, small)
        if large:
            # The bytes' hash and the number of windows tell the segments apart.
            finer = pieces.filter("large").dropDuplicates(_SEGMENT).coalesce(_tasks(large))
            finer = written(
                finer.select(F.xxhash64("h", "n").alias("k1"), F.col("sd").alias("k2"), "data", *_SEGMENT), "finer"
            )
            again, _ = repeated_ranges(finer.select("k1", "k2", "data"), length, level + 1, shard_bytes)
            back = finer.select("k1", "k2", *_SEGMENT).join(again, ["k1", "k2"])
            within = within.unionByName(back.select(*_SEGMENT, "ranges"))
        once = kinds.filter("times = 1").select(*_SEGMENT)
        found = found.unionByName(written(within, "ranges").join(once, _SEGMENT))
    placed = shared.join(found, _SEGMENT).select(
        "k1", "k2", F.explode("at").alias("first"), "ranges"
    )
    shifted = F.transform(
        "ranges",
        lambda r: F.struct((r["a"] + F.col("first")).alias("a"), (r["b"] + F.col("first")).alias("b")),
    )
    rows = placed.select("k1", "k2", shifted.alias("ranges"))
    return rows.groupBy("k1", "k2").agg(F.flatten(F.collect_list("ranges")).alias("ranges")), total


def removed_spans(ranges: list[dict] | None, length: int) -> list[tuple[int, int]]:
    """The bytes that the windows cover, as separate spans (end excluded)."""
    spans: list[tuple[int, int]] = []
    for a, b in sorted((r["a"], r["b"] + length) for r in ranges or []):
        if spans and a <= spans[-1][1]:
            spans[-1] = (spans[-1][0], max(b, spans[-1][1]))
        else:
            spans.append((a, b))
    return spans


def without_repeats(
    rows: DataFrame,
    text: str = "text",
    length: int = LENGTH,
    shard_bytes: int = SHARD_BYTES,
    as_text: bool = False,
) -> DataFrame:
    """``rows`` with ``kept`` (binary) and ``spans`` (removed bytes, end excluded)
    in place of the text. ``as_text`` makes ``kept`` a string, without the bytes
    of code points that a span has cut."""
    value = F.coalesce(F.col(f"`{text}`"), F.lit("")).cast("binary")
    rest = [c for c in rows.columns if c not in (text, "kept", "spans")]
    # Rows with the same text have the same result, whatever their other columns;
    # the first key spreads them, since it is taken from those as well.
    other = F.xxhash64(*(F.to_json(F.struct(F.col(f"`{c}`"))) for c in rest), F.lit(1))
    keyed = rows.select(
        F.struct(*(F.col(f"`{c}`") for c in rest)).alias("rest"),
        other.alias("k1"),
        F.xxhash64(value).alias("k2"),
        value.alias("data"),
    )
    ranges, total = repeated_ranges(keyed.select("k1", "k2", "data"), length, 0, shard_bytes)
    joined = keyed.join(ranges, ["k1", "k2"], "left").select("rest", "data", "ranges").coalesce(_tasks(total))
    spans_type = T.ArrayType(T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType())]))
    kept_type = T.StringType() if as_text else T.BinaryType()
    schema = T.StructType([joined.schema["rest"]]).add("kept", kept_type).add("spans", spans_type)
    arrow_spans = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "data"):
            raw = utf8_texts(column(part, "data"))
            kept, spans = [], []
            for data, found in zip(raw, column(part, "ranges").to_pylist(), strict=True):
                gone = removed_spans(found, length)
                edges = [0, *itertools.chain(*gone), len(data)]
                kept.append(b"".join(data[a:b] for a, b in zip(edges[::2], edges[1::2], strict=True)))
                spans.append([{"start": a, "end": b} for a, b in gone])
            if as_text:
                held = pa.array([k.decode(errors="ignore") for k in kept], pa.string())
            else:
                held = pa.array(kept, pa.binary())
            yield pa.RecordBatch.from_arrays(
                [column(part, "rest"), held, pa.array(spans, arrow_spans)],
                names=["rest", "kept", "spans"],
            )

    return joined.mapInArrow(run, schema).select("rest.*", "kept", "spans")
