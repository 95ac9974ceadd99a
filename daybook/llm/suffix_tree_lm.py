"""Language-model scores from a probabilistic suffix tree over words.

A text is its words, A-Z lower-cased, and one end. The root is the add-one
distribution over the training words and one unknown word. Below it stand
contexts of one to ``depth`` words. A context is retained if the next-word
distribution seen after it diverges from that of the context without its first
word (its suffix): the log-likelihood gained over the suffix must exceed
``DIVERGENCE`` nats for each word kept. A state gives the words kept after it
their counts, and the remaining mass, with a share for as many unseen words, to
its suffix; every distribution sums to one. A text is scored by the longest
retained suffix before each word.

A word is kept after a context from ``kept`` occurrences on, whatever the size
of the corpus; nothing but that and ``depth`` limits contexts before the divergence
test, and the caller may choose both. States
are Spark tables of 64-bit gram hashes. A gram of k words stands for a word after
a context of k - 1 and for a context of k, so a text's gain over the root is a
sum of one value for each of its grams, looked up in its bucket. Grams of at least
``COMMON_SHARE`` of the tokens, a bounded number, are found in a broadcast
instead. A gram can only reach ``kept`` if both grams of one word less do, and
only grams with a state count: both are asked of a bitmap of up to ``_CELL_BITS`` bits
of the hash, which lets some through that the look-up then drops, and loses none.

Buckets are ranges of hashes, as many as the tokens ask for. What a task has for a
bucket travels, and is stored, as one row: its columns behind one another. Tasks sort
before they send, so a gram met often is one entry from each task, and a bucket's tables
are looked up by parts of what is asked: beside its table only a part is in memory. Words
are told apart by 64-bit hashes too.

Null and empty texts consist of the end only. Without training texts every
probability is 1. A null id is never held out.
"""

from __future__ import annotations

import contextlib
import ctypes
import hashlib
import itertools
import math
from collections.abc import Callable, Iterable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from daybook.llm.common import column, dropped, slices, written

KEPT = 2
DEPTH = 3
COMMON_SHARE = 5e-7
DIVERGENCE = 4.0
#: Words, and grams, that a task counts at a time.
WORDS_AT_ONCE, PAIRS_AT_ONCE = 1 << 18, 1 << 20
#: Bytes of texts that are split at a time, and of batches that go to Python workers.
TEXT_BYTES, BATCH_BYTES = 1 << 20, 2 << 20
#: Rows that a task sorts at a time before it sends them, and bytes it sends at a time.
ROWS_AT_ONCE, SENT_BYTES = 1 << 19, 4 << 20
#: Rows to a bucket of hashes, and buckets to a task.
BUCKET_ROWS, BUCKETS_A_TASK = 1 << 19, 4
#: Buckets that words are counted in, whose number is not known before.
WORD_BUCKETS = 256
#: The leading bits of a gram that tell in which round its texts' gains are found.
ROUND_BITS = 2
#: Bytes of a word from which on its hash is made by itself.
LONG_WORD = 64
END, START = b"", b" "
_CELL_BITS = 28
_REMOVAL = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_SENT = "bucket int, kind int, data binary"
_SENT_NAMES = ["bucket", "kind", "data"]
#: Of eight bytes the first none, one and so on; lower case and one white space for bytes.
_LEADING = np.array([(1 << 8 * n) - 1 for n in range(9)], dtype=np.uint64)
_FOLDED = np.frombuffer(bytes(range(256)).lower().translate(bytes.maketrans(b"\t\n\v\f\r", b" " * 5)), np.uint8)


def held_out(ident: Column) -> Column:
    """A seventh of the ids, by the CRC-32 of their text."""
    return F.coalesce(F.crc32(ident.cast("string").cast("binary")) % 7 == 2, F.lit(False))


def _runs(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Bytes of texts in lower case, between where their words start and end, and how many
    words each text has."""
    data, places = _bytes_of(texts, folded=True)
    inside = data != 32
    edges = np.flatnonzero(inside[1:] != inside[:-1]) + 1
    return data, edges[::2], edges[1::2], np.diff(np.searchsorted(edges[::2], places))


def word_counts(texts: DataFrame, text: str = "text", buckets: int = WORD_BUCKETS) -> DataFrame:
    """``word, c`` of all texts; the empty word is the end."""

    def distinct(hashes: np.ndarray, words: pa.Array, c: np.ndarray) -> tuple[np.ndarray, pa.Array, np.ndarray]:
        by = _order(hashes)
        hashes = hashes[by]
        new = np.flatnonzero(np.append(True, hashes[1:] != hashes[:-1])[: len(hashes)])
        return hashes[new], words.take(pa.array(by[new])), np.add.reduceat(c[by], new) if len(new) else c

    def sent(hashes: np.ndarray, words: pa.Array, c: np.ndarray) -> Iterator[pa.RecordBatch]:
        # Of each bucket a number of words, their hashes, counts and lengths, and their bytes.
        _, offsets, data = words.buffers()
        offsets = np.frombuffer(offsets, np.int64)[words.offset :][: len(words) + 1]
        where = _bucket(hashes, buckets)
        starts = np.flatnonzero(np.append(True, where[1:] != where[:-1]))
        for a, b in zip(starts, [*starts[1:], len(where)], strict=True):
            numbers = np.concatenate([[b - a], hashes[a:b].view(np.int64), c[a:b], np.diff(offsets[a : b + 1])])
            letters = data.slice(offsets[a], offsets[b] - offsets[a])
            row = pa.array([numbers.astype(np.int64).tobytes() + letters.to_pybytes()], pa.binary())
            yield pa.RecordBatch.from_arrays(
                [pa.array(where[a : a + 1]), pa.array([0], pa.int32()), row], names=_SENT_NAMES
            )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, pa.Array, np.ndarray]] = []
        texts = size = 0
        for part in slices(batches, text, TEXT_BYTES):
            data, starts, ends, sizes = _runs(column(part, text))
            texts += len(sizes)
            # Every other run is a word, and those between are white space.
            bounds = pa.py_buffer(np.stack([starts, ends], axis=1).ravel())
            words = pa.LargeBinaryArray.from_buffers(pa.large_binary(), max(2 * len(starts) - 1, 0), [None, bounds, pa.py_buffer(data)])
            hashes = _hashed(data, starts, ends - starts)
            hashes, places, c = distinct(hashes, pa.array(np.arange(len(starts)) * 2), np.ones(len(starts), dtype=np.int64))
            held.append((hashes, words.take(places), c))
            size += len(hashes)
            if size > WORDS_AT_ONCE:
                found, held, size = distinct(*_stacked(held)), [], 0
                yield from sent(*found)
        if size:
            yield from sent(*distinct(*_stacked(held)))
        if texts:
            yield from sent(word_hashes(pa.array([""])), pa.array([b""], pa.large_binary()), np.array([texts]))

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def parts() -> Iterator[tuple[int, bytes]]:
            for batch in batches:
                yield from zip(column(batch, "bucket").to_pylist(), column(batch, "data").to_pylist(), strict=True)

        for _, rows in itertools.groupby(parts(), key=lambda part: part[0]):
            held = []
            for _, row in rows:
                n = int(np.frombuffer(row, np.int64, 1)[0])
                hashes, c, sizes = np.frombuffer(row, np.int64, 3 * n, 8).reshape(3, n)
                offsets, letters = pa.py_buffer(np.append(0, np.cumsum(sizes))), pa.py_buffer(row[8 + 24 * n :])
                words = pa.Array.from_buffers(pa.large_binary(), n, [None, offsets, letters])
                held.append((hashes.view(np.uint64), words, c))
            _, words, c = distinct(*_stacked(held))
            yield pa.RecordBatch.from_arrays([words.cast(pa.binary()).cast(pa.string()), pa.array(c)], names=["word", "c"])

    partial = texts.select(f"`{text}`").mapInArrow(_task(run), _SENT)
    # The number of words is not known yet: the session's partitions, together where small.
    met = partial.repartition("bucket").sortWithinPartitions("bucket")
    return met.mapInArrow(_task(summed), "word string, c bigint")


def _stacked(held: list[tuple[np.ndarray, pa.Array, np.ndarray]]) -> tuple[np.ndarray, pa.Array, np.ndarray]:
    hashes, words, c = zip(*held, strict=True)
    return np.concatenate(hashes), pa.concat_arrays(words), np.concatenate(c)


def _starts(keys: np.ndarray) -> np.ndarray:
    """Where the sorted keys of each cell of leading bits start, with some two cells a key."""
    bits = min(_CELL_BITS, max(8, len(keys).bit_length() + 1))
    starts = np.zeros((1 << bits) + 1, dtype=np.int32)
    cells = (keys >> np.uint64(64 - bits)).astype(np.int64)
    np.cumsum(np.bincount(cells, minlength=1 << bits), out=starts[1:])
    return starts


def _found(keys: np.ndarray, starts: np.ndarray, asked: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which of the asked are among sorted keys, and where."""
    if not len(keys):
        return np.zeros(len(asked), dtype=bool), np.zeros(len(asked), dtype=np.int64)
    cell = (asked >> np.uint64(65 - (len(starts) - 1).bit_length())).astype(np.int64)
    at = np.minimum(starts[cell], len(keys) - 1)
    found = keys[at] == asked
    left = np.flatnonzero(~found & (starts[cell + 1] > at + 1))
    end = starts[cell[left] + 1]
    while len(left):
        at[left] += 1
        equal = keys[at[left]] == asked[left]
        found[left[equal]] = True
        more = ~equal & (at[left] + 1 < end)
        left, end = left[more], end[more]
    return found, at


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _hashed(data: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """64-bit hashes of words, which are runs of ``data``; eight bytes must follow the last.

    Words of eight bytes or less of one length never collide; those beyond ``LONG_WORD``
    bytes have the start of their BLAKE2b."""
    eight = np.ndarray((len(data) - 7,), np.uint64, buffer=data, strides=(1,))
    found = eight[starts] & _LEADING[np.minimum(lengths, 8)]
    found = _mixed(found + (lengths + 1).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    left = np.flatnonzero((lengths > 8) & (lengths <= LONG_WORD))
    done = 8
    while len(left):
        part = eight[starts[left] + done] & _LEADING[np.minimum(lengths[left] - done, 8)]
        found[left] = _mixed(found[left] ^ part)
        done += 8
        left = left[lengths[left] > done]
    for i in np.flatnonzero(lengths > LONG_WORD):
        word = data[starts[i] : starts[i] + lengths[i]].tobytes()
        found[i] = int.from_bytes(hashlib.blake2b(word, digest_size=8).digest(), "little")
    return found


def _bytes_of(texts: pa.Array, folded: bool) -> tuple[np.ndarray, np.ndarray]:
    """The texts' bytes with a space before and after each, and where each text starts."""
    ended = pc.binary_join_element_wise(pc.fill_null(texts, ""), "", " ").cast(pa.large_binary())
    _, offsets, data = ended.buffers()
    offsets = np.frombuffer(offsets, np.int64)[ended.offset : ended.offset + len(ended) + 1]
    own = np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]] if len(ended) else np.empty(0, np.uint8)
    held = np.full(len(own) + 16, 32, dtype=np.uint8)
    held[1 : len(own) + 1] = _FOLDED[own] if folded else own
    return held, offsets - offsets[0] + 1


def word_hashes(words: pa.Array) -> np.ndarray:
    """The hash of each word, as it is."""
    data, starts = _bytes_of(words, folded=False)
    return _hashed(data, starts[:-1], np.diff(starts) - 1)


def text_hashes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """How many words each text has, and the hash of each word, in lower case."""
    data, starts, ends, sizes = _runs(texts)
    return sizes, _hashed(data, starts, ends - starts)


def _joined(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """The hash of a gram, from those of the gram without its last and first word."""
    x = (left ^ (left >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93) + right
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0x9FB21C651E98DF25)
    return x ^ (x >> np.uint64(32))


def _grams(sizes: np.ndarray, words: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For one word, two and so on: the hash of the gram from each word on, and which are
    of one text.

    The start of a text is a word of its own before it, and its end one after it."""
    ends = np.cumsum(sizes + 2)
    grams = np.empty(len(words) + 2 * len(sizes), dtype=np.uint64)
    whole = np.ones(len(grams), dtype=bool)
    inner = whole.copy()
    inner[ends - sizes - 2] = inner[ends - 1] = False
    grams[inner] = words
    grams[ends - sizes - 2], grams[ends - 1] = word_hashes(pa.array([START.decode(), END.decode()]))
    order = 1
    while True:
        yield grams, whole[: len(grams)]
        # The last words of a text start no longer gram; of a short text, the start did not.
        whole[(ends - order)[ends >= order]] = False
        grams = _joined(grams[:-1], grams[1:])
        order += 1


def _order(keys: np.ndarray) -> np.ndarray:
    """The places of keys in their order: the leading bits are sorted with the place behind
    them, and what they leave open is sorted again."""
    bits = np.uint64(max(1, len(keys).bit_length()))
    packed = keys >> bits << bits | np.arange(len(keys), dtype=np.uint64)
    packed.sort()
    by = (packed & ((np.uint64(1) << bits) - np.uint64(1))).astype(np.int64)
    found = keys[by]
    wrong = np.flatnonzero(found[1:] < found[:-1])
    if len(wrong):
        leading = found >> bits
        asked = np.unique(leading[wrong])
        bounds = zip(np.searchsorted(leading, asked), np.searchsorted(leading, asked, "right"), strict=True)
        for start, end in bounds:
            by[start:end] = by[start:end][np.argsort(found[start:end], kind="stable")]
    return by


def _bucket(keys: np.ndarray, buckets: int) -> np.ndarray:
    """One of ``buckets`` ranges of hashes."""
    return ((keys >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)).astype(np.int32)


def _buckets(rows: int) -> int:
    return max(8, rows // BUCKET_ROWS)


def _narrowed(columns: list[np.ndarray]) -> list[np.ndarray]:
    """Columns of which the first is sorted, as differences, with the bytes of like weight
    beside one another, so that they compress."""
    columns = [np.diff(columns[0], prepend=np.uint64(0)), *columns[1:]]
    return [np.ascontiguousarray(c.view(np.uint8).reshape(-1, 8).T).ravel().view(np.uint64) for c in columns]


def _widened(columns: np.ndarray) -> list[np.ndarray]:
    wide = [np.ascontiguousarray(c.view(np.uint8).reshape(8, -1).T).ravel().view(np.uint64) for c in columns]
    return [np.cumsum(wide[0], dtype=np.uint64), *wide[1:]]


def _dealt(
    where: np.ndarray, kind: int, columns: list[np.ndarray], coded: Callable[[list[np.ndarray]], list[np.ndarray]] = list
) -> Iterator[pa.RecordBatch]:
    """``bucket, kind, data``: the columns of each bucket's rows behind one another, 8 bytes
    a value; ``where`` has the buckets of the rows, sorted."""
    starts = np.flatnonzero(np.append(True, where[1:] != where[:-1])[: len(where)])
    ends = np.append(starts[1:], len(where))
    places = (ends * (8 * len(columns))) // SENT_BYTES
    for some in np.split(np.arange(len(starts)), np.flatnonzero(places[1:] != places[:-1]) + 1):
        if len(some):
            bounds = zip(starts[some], ends[some], strict=True)
            parts = [part for a, b in bounds for part in coded([c[a:b].view(np.uint64) for c in columns])]
            sizes = 8 * len(columns) * (ends[some] - starts[some])
            offsets = pa.py_buffer(np.append(0, np.cumsum(sizes)).astype(np.int32))
            flat = pa.py_buffer(np.concatenate(parts))
            data = pa.Array.from_buffers(pa.binary(), len(some), [None, offsets, flat])
            kinds = pa.array(np.full(len(some), kind, dtype=np.int32))
            yield pa.RecordBatch.from_arrays([pa.array(where[starts[some]]), kinds, data], names=_SENT_NAMES)


def _numbers(batch: pa.RecordBatch, name: str) -> np.ndarray:
    return column(batch, name).to_numpy().view(np.uint64)


def _by_bucket(key: np.ndarray, buckets: int, kind: int, columns: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
    by = _order(key)
    yield from _dealt(_bucket(key[by], buckets), kind, [c[by] for c in columns])


def _sent(rows: DataFrame, key: str, columns: list[str], buckets: int, kind: int = 0) -> DataFrame:
    """``bucket, kind, data`` of rows that go to the bucket of a hash, ``ROWS_AT_ONCE`` at once."""
    names = list(dict.fromkeys([key, *columns]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for held in _together(([_numbers(part, n) for n in names] for part in batches), ROWS_AT_ONCE):
            own = dict(zip(names, held, strict=True))
            yield from _by_bucket(own[key], buckets, kind, [own[c] for c in columns])

    return rows.select(*names).mapInArrow(_task(run), _SENT)


def _together(parts: Iterator[list[np.ndarray]], most: int) -> Iterator[list[np.ndarray]]:
    """Columns of a number of rows at once, ``most`` or more but for the last."""
    held: list[list[np.ndarray]] = []
    size = 0
    for part in parts:
        held.append(part)
        size += len(part[0])
        if size >= most:
            columns = [np.concatenate(c) for c in zip(*held, strict=True)]
            held, size = [], 0
            yield columns
    if size:
        yield [np.concatenate(c) for c in zip(*held, strict=True)]


def _met(sent: DataFrame, buckets: int) -> DataFrame:
    """Rows of one bucket behind one another, the kinds of a bucket in their order."""
    return sent.repartition(max(8, buckets // BUCKETS_A_TASK), "bucket").sortWithinPartitions("bucket", "kind")


def _parts(batches: Iterator[pa.RecordBatch], widths: tuple[int, ...]) -> Iterator[tuple[int, int, np.ndarray]]:
    """Bucket, kind and columns of what was sent."""
    for batch in batches:
        data = column(batch, "data")
        places, kinds = (column(batch, n).to_pylist() for n in ("bucket", "kind"))
        for i, (bucket, kind) in enumerate(zip(places, kinds, strict=True)):
            yield bucket, kind, np.frombuffer(data[i].as_buffer(), np.uint64).reshape(widths[kind], -1)


def _met_buckets(batches: Iterator[pa.RecordBatch], widths: tuple[int, ...]) -> Iterator[Iterator[tuple[int, np.ndarray]]]:
    """Kind and columns of what a bucket got, for one bucket after the other; each is to be
    read to its end."""
    for _, rows in itertools.groupby(_parts(batches, widths), key=lambda part: part[0]):
        yield ((kind, columns) for _, kind, columns in rows)


def _first_column(width: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Of what is packed, the first column."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for bucket, _, columns in _parts(batches, (width,)):
            yield _packed_row(bucket, 0, [columns[0]])

    return run


def _packed_row(bucket: int, kind: int, columns: list[np.ndarray]) -> pa.RecordBatch:
    row = [pa.array([bucket], pa.int32()), pa.array([kind], pa.int32())]
    data = b"".join(np.ascontiguousarray(c).tobytes() for c in columns)
    return pa.RecordBatch.from_arrays([*row, pa.array([data], pa.binary())], names=_SENT_NAMES)


def _shown(
    packed: DataFrame, made: str, width: int, read: Callable[[np.ndarray], Iterable[np.ndarray]] = list
) -> DataFrame:
    """Packed rows of a kind 0 of ``width`` columns as rows; what reads them packed takes
    ``packed`` of them. A NaN is null, and so is a context without a rest left to it."""
    fields = T.StructType.fromDDL(made).fields

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, _, columns in _parts(batches, (width,)):
            columns = list(read(columns))
            none = np.isnan(columns[-1].view(np.float64))
            found = []
            for field, values in zip(fields, columns, strict=True):
                if isinstance(field.dataType, T.DoubleType):
                    values = values.view(np.float64)
                    found.append(pa.array(values, mask=np.isnan(values)))
                else:
                    found.append(pa.array(values.view(np.int64), mask=none & (field.name == "context")))
            yield pa.RecordBatch.from_arrays(found, names=[f.name for f in fields])

    rows = packed.mapInArrow(_task(run), made)
    rows.packed, rows.width = packed, width
    return rows


def _whole(rows: Iterable[np.ndarray], width: int) -> list[np.ndarray]:
    """All of a bucket's rows of a kind."""
    held = list(rows)
    return list(np.concatenate(held, axis=1)) if held else [np.empty(0, dtype=np.uint64)] * width


def _with_first(rows: Iterator[tuple[int, np.ndarray]], width: int) -> tuple[list[np.ndarray], Iterator[np.ndarray]]:
    """Columns of a bucket's rows of kind 0, sorted by the first, and its others, part by part."""
    first, rest = [], iter(())
    for kind, columns in rows:
        if kind:
            rest = itertools.chain([columns], (c for _, c in rows))
            break
        first.append(columns[:width])
    table = _whole(first, width)
    by = _order(table[0])
    return [c[by] for c in table], rest


def _places(keys: np.ndarray, asked: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which of the asked are among sorted keys, and where those are."""
    at = np.searchsorted(keys, asked)
    at[at == len(keys)] = 0
    found = keys[at] == asked if len(keys) else np.zeros(len(asked), dtype=bool)
    return found, at[found]


def _in_bitmap(bitmap: np.ndarray, grams: np.ndarray) -> np.ndarray:
    cell = grams >> np.uint64(65 - (len(bitmap) << 6).bit_length())
    return (bitmap[(cell >> np.uint64(6)).astype(np.int64)] >> (cell & np.uint64(63)) & np.uint64(1)).astype(bool)


def _marked(keys: np.ndarray) -> np.ndarray:
    """The bitmap of a table's keys, with some 32 cells a key."""
    size = min(_CELL_BITS, max(16, len(keys).bit_length() + 5))
    seen = np.zeros(1 << size, dtype=np.uint8)
    seen[(keys >> np.uint64(64 - size)).astype(np.int64)] = 1
    return np.packbits(seen, bitorder="little").view(np.uint64)


def bitmap(rows: DataFrame, gram: str, buckets: int = 8) -> np.ndarray:
    """Which leading bits occur among the hashes, with 64 cells or more for each as long as
    that takes no more than 32 MB on the driver."""
    packed = getattr(rows, "packed", None)
    if packed is None:
        number, sent = rows.count(), _sent(rows, gram, [gram], buckets)
    else:
        number = (packed.agg(F.sum(F.octet_length("data"))).first()[0] or 0) // (8 * rows.width)
        sent = packed if rows.width == 1 else packed.mapInArrow(_first_column(rows.width), _SENT)
    size = min(_CELL_BITS, max(16, number.bit_length() + 6))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for met in _met_buckets(batches, (1,)):
            (grams,) = _whole((columns for _, columns in met), 1)
            cells = (grams >> np.uint64(64 - size)).astype(np.int64)
            start, end = int(cells.min()) >> 6, (int(cells.max()) >> 6) + 1
            seen = np.zeros((end - start) << 6, dtype=np.uint8)
            seen[cells - (start << 6)] = 1
            data = np.packbits(seen, bitorder="little").tobytes()
            columns = [pa.array([start], pa.int64()), pa.array([data], pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, names=["at", "bits"])

    found = _met(sent, buckets).mapInArrow(_task(run), "at bigint, bits binary").toArrow()
    bits = np.zeros(1 << (size - 6), dtype=np.uint64)
    for at, part in zip(found["at"].to_pylist(), found["bits"], strict=True):
        words = np.frombuffer(part.as_buffer(), np.uint64)
        bits[at : at + len(words)] |= words
    return bits


def _task(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable:
    """``run``, and at the end of its task the worker gives free memory back, which it would
    keep beside the other workers until it is reused."""

    def released(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from run(batches)
        pa.default_memory_pool().release_unused()
        with contextlib.suppress(OSError, AttributeError):
            ctypes.CDLL(None).malloc_trim(0)

    return released


def _signed(values: np.ndarray) -> pa.Array:
    return pa.array(values.view(np.int64))


def _gram_counts(texts: DataFrame, order: int, below: np.ndarray, kept: int, buckets: int = 8) -> DataFrame:
    """``context, suffix, c`` of the grams that occur ``kept`` times, packed by suffix."""
    spread = texts.sparkSession.sparkContext.broadcast(below)

    def distinct(context: np.ndarray, suffix: np.ndarray, c: np.ndarray) -> tuple[np.ndarray, ...]:
        gram = _joined(context, suffix)
        by = _order(gram)
        gram, context, suffix = gram[by], context[by], suffix[by]
        new = (gram[1:] != gram[:-1]) | (context[1:] != context[:-1]) | (suffix[1:] != suffix[:-1])
        new = np.flatnonzero(np.append(True, new)[: len(gram)])
        return gram[new], context[new], suffix[new], np.add.reduceat(c[by], new) if len(new) else c

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = spread.value

        def pairs() -> Iterator[list[np.ndarray]]:
            for part in slices(batches, "text", TEXT_BYTES):
                grams = _grams(*text_hashes(column(part, "text")))
                shorter, _ = next(itertools.islice(grams, order - 2, None))
                _, whole = next(grams)
                seen = _in_bitmap(bits, shorter)
                both = seen[:-1] & seen[1:] & whole
                yield [shorter[:-1][both], shorter[1:][both]]

        for context, suffix in _together(pairs(), PAIRS_AT_ONCE):
            gram, context, suffix, c = distinct(context, suffix, np.ones(len(context), dtype=np.int64))
            yield from _dealt(_bucket(gram, buckets), 0, [context, suffix, c])

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def often() -> Iterator[list[np.ndarray]]:
            for rows in _met_buckets(batches, (3,)):
                context, suffix, c = _whole((columns for _, columns in rows), 3)
                _, context, suffix, c = distinct(context, suffix, c.view(np.int64))
                yield [x[c >= kept] for x in (context, suffix, c)]

        for columns in _together(often(), ROWS_AT_ONCE):
            yield from _by_bucket(columns[1], buckets, 0, columns)

    counts = _met(texts.mapInArrow(_task(run), _SENT), buckets).mapInArrow(_task(counted), _SENT)
    counts = written(counts, f"grams-{order}")
    spread.destroy()
    return _shown(counts, "context bigint, suffix bigint, c bigint", 3)


def _word_states(words: DataFrame, size: int, kinds: int, kept: int) -> DataFrame:
    """``gram, c, p`` of the single words and of the start of a text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in batches:
            coded = _signed(word_hashes(column(part, "word")))
            yield pa.RecordBatch.from_arrays([coded, column(part, "c")], names=["gram", "c"])

    start = words.filter(F.col("word") == "").select(F.lit(" ").alias("word"), "c")
    rows = words.unionByName(start).filter(F.col("c") >= kept).mapInArrow(_task(run), "gram bigint, c bigint")
    return written(rows.withColumn("p", (F.col("c") + 1) / F.lit(float(size + kinds + 1))), "grams-1")


def grown(
    texts: DataFrame, words: DataFrame, size: int, kinds: int, depth: int = DEPTH, kept: int = KEPT
) -> DataFrame:
    """``gram, c, value``: what each gram of a text adds to its gain in nats."""
    below = _word_states(words, size, kinds, kept)
    found: list[DataFrame] = []
    buckets = _buckets(size)
    for order in range(2, depth + 2):
        grams = _gram_counts(texts, order, bitmap(below, "gram", buckets), kept, buckets)
        dropped()
        rows, values = _states(grams, below, order, buckets, lean=True)
        dropped(*([below] if order == 2 else []))
        below = rows
        found.append(values)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in _met_buckets(batches, (3,)):
            gram, c, value = _whole((columns for _, columns in rows), 3)
            by = _order(gram)
            new = np.flatnonzero(np.append(True, gram[by[1:]] != gram[by[:-1]])[: len(by)])
            gram, c = gram[by[new]], np.maximum.reduceat(c[by].view(np.int64), new)
            value = np.add.reduceat(value[by].view(np.float64), new)
            yield from _dealt(_bucket(gram, buckets), 0, [gram, c, value], _narrowed)

    every = reduce(DataFrame.union, (values.packed for values in found))
    merged = written(_met(every, buckets).mapInArrow(_task(run), _SENT), "values")
    dropped(*(values.stored for values in found))
    return _shown(merged, "gram bigint, c bigint, value double", 3, _widened)


def _states(
    grams: DataFrame, below: DataFrame, order: int, buckets: int = 8, lean: bool = False
) -> tuple[DataFrame, DataFrame]:
    """``gram, p, c`` of an order's grams, and what the states retained add to a gain; rows
    of states retained also have their context and the log of the mass left, if not ``lean``.

    ``below`` has the grams of one word less: the count of a context, and the
    probability of a word in the state of the context's suffix."""

    def lower(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[list[np.ndarray]] = []
        size = 0
        for rows in _met_buckets(batches, (below_width, 3)):
            (keys, p, counts), asked = _with_first(rows, 3)
            yield from _dealt(_bucket(keys, buckets), 0, [keys, counts])
            for context, suffix, c in asked:
                found, at = _places(keys, suffix)
                held.append([context[found], suffix[found], c[found], p[at]])
                size += len(at)
                if size > ROWS_AT_ONCE:
                    yield from sent(held)
                    held, size = [], 0
        if size:
            yield from sent(held)

    def sent(held: list[list[np.ndarray]]) -> Iterator[pa.RecordBatch]:
        columns = [np.concatenate(c) for c in zip(*held, strict=True)]
        yield from _by_bucket(columns[0], buckets, 1, columns)

    def judged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[list[np.ndarray]] = []
        size = 0
        for rows in _met_buckets(batches, (2, 4)):
            (keys, counts), asked = _with_first(rows, 2)
            # Beside one another stand the words kept after a context, at most the vocabulary.
            context, suffix, c, lower = _whole(asked, 4)
            by = _order(context)
            found, at = _places(keys, context[by])
            by = by[found]
            if not len(by):
                continue
            context, suffix, n = context[by], suffix[by], counts[at].view(np.int64)
            c, lower = c[by].view(np.int64), lower[by].view(np.float64)
            new = np.flatnonzero(np.append(True, context[1:] != context[:-1]))
            kinds = np.diff(np.append(new, len(context)))
            kept = np.add.reduceat(c, new)
            whole = n[new] + kinds
            left = (whole - kept) / whole
            p = c / np.repeat(whole, kinds) + np.repeat(left, kinds) * lower
            more, left = np.log(p) - np.log(lower), np.log(left)
            retained = np.add.reduceat(c * more, new) + (n[new] - kept) * left > DIVERGENCE * kinds
            ours, left = np.repeat(retained, kinds), np.repeat(left, kinds)
            first = new[retained]
            yield from _dealt(_bucket(context[first], buckets), 1, [context[first], n[first], left[first]])
            columns = [_joined(context, suffix), np.where(ours, p, lower), c, np.where(ours, more - left, np.nan)]
            if not lean:
                columns += [context, np.where(ours, left, np.nan)]
            held.append(columns)
            size += len(c)
            if size > ROWS_AT_ONCE:
                yield from dealt(held)
                held, size = [], 0
        if size:
            yield from dealt(held)

    def dealt(held: list[list[np.ndarray]]) -> Iterator[pa.RecordBatch]:
        columns = [np.concatenate(c) for c in zip(*held, strict=True)]
        yield from _by_bucket(columns[0], buckets, 0, columns)

    def added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for bucket, kind, columns in _parts(batches, (width, 3)):
            if not kind:
                ours = ~np.isnan(columns[3].view(np.float64))
                columns = [columns[n][ours] for n in (0, 2, 3)]
            yield _packed_row(bucket, 0, list(columns))

    made = "gram bigint, p double, c bigint, value double"
    made += "" if lean else ", context bigint, left double"
    width = 4 if lean else 6
    if (packed := getattr(below, "packed", None)) is None:
        below_width, packed = 3, _sent(below, "gram", ["gram", "p", "c"], buckets)
    else:
        below_width = below.width
    asked = grams.packed.withColumn("kind", F.lit(1))
    met = _met(_met(packed.union(asked), buckets).mapInArrow(_task(lower), _SENT), buckets)
    stored = written(met.mapInArrow(_task(judged), _SENT), f"states-{order}")
    dropped(grams.packed)
    states = _shown(stored.filter("kind = 0"), made, width)
    values = _shown(stored.mapInArrow(_task(added), _SENT), "gram bigint, c bigint, value double", 3)
    values.stored = stored
    return states, values


@contextlib.contextmanager
def _while_grown(spark: SparkSession) -> Iterator[None]:
    """Within this, the shuffles of a write go with its end, not when the driver collects
    its plan, and batches for Python workers are small; what is read later is not touched."""
    wanted = {_REMOVAL: "true", "spark.sql.execution.arrow.maxBytesPerBatch": str(BATCH_BYTES)}
    before = {key: spark.conf.get(key, None) for key in wanted}
    for key, value in wanted.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def score(
    rows: DataFrame, ident: str = "doc_id", text: str = "text", depth: int = DEPTH, kept: int = KEPT
) -> DataFrame:
    """``rows`` without the text, with ``held_out, n_tokens, n_known,
    train_tokens, base_score, score``; names in use are replaced. No rows give no rows.

    ``depth`` is the most words a context has, ``kept`` the occurrences from which on a
    word is kept after one."""
    with _while_grown(rows.sparkSession):
        return _scored(rows, ident, text, depth, kept)


def _scored(rows: DataFrame, ident: str, text: str, depth: int, kept: int) -> DataFrame:
    added = ("held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score")
    rest = [c for c in rows.columns if c != text and c not in added]
    training = rows.filter(~held_out(F.col(f"`{ident}`"))).select(F.col(f"`{text}`").alias("text"))
    words = written(word_counts(training), "words")
    size, kinds = words.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count("*")).first()
    values = grown(training, words, size, kinds, depth, kept)
    buckets = _buckets(size)
    least = COMMON_SHARE * size

    def shared(often: bool, turn: int | None = None, names: int = 2) -> DataFrame:
        """Packed ``gram, value`` of common grams or of others, all or those of a round."""

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for bucket, _, columns in _parts(batches, (3,)):
                gram, c, value = _widened(columns)
                ours = (c.view(np.int64) >= least) == often
                if turn is not None:
                    ours &= gram >> np.uint64(64 - ROUND_BITS) == turn
                if ours.any():
                    yield _packed_row(bucket, 0, [gram[ours], value[ours]][:names])

        return values.packed.mapInArrow(_task(run), _SENT)

    start = F.col("gram") == F.lit(int(word_hashes(pa.array([START.decode()])).view(np.int64)[0]))
    hashed = _word_states(words, size, kinds, 1).filter(~start)
    hashed = hashed.select("gram", "c", F.log10(F.col("c") + 1).alias("value"))
    often = (columns for _, _, columns in _parts(iter(shared(True).toArrow().to_batches()), (2,)))
    known = hashed.filter(F.col("c") >= least).select("gram", "value").toArrow()

    def sorted_table(keys: np.ndarray, worth: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        by = np.argsort(keys)
        return keys[by], worth.view(np.float64)[by]

    tables = _whole(often, 2), [known[n].to_numpy().view(np.uint64) for n in ("gram", "value")]
    common, words_known = (sorted_table(*table) for table in tables)
    seldom = _shown(shared(False, names=1), "gram bigint", 1)
    bits = bitmap(seldom, "gram", buckets)
    model = rows.sparkSession.sparkContext.broadcast((common, bits, words_known))

    packed = rows.select(
        F.struct(*(F.col(f"`{c}`") for c in rest)).alias("rest"), F.col(f"`{text}`").alias("text")
    )
    # A row is a text, or what a bucket is asked for texts: of words in round 0, then of grams.
    made = "row bigint, n_tokens bigint, known bigint, logs double, gain double, round int"
    made = T.StructType.fromDDL(f"{made}, {_SENT}").fields
    schema = T.StructType([T.StructField("rest", packed.schema["rest"].dataType), *made])
    types = (pa.int64(), pa.int64(), pa.int64(), pa.float64(), pa.float64())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        (keys, worth), bits, (words, logs) = model.value
        starts, word_starts, often = _starts(keys), _starts(words), _marked(keys)
        end = word_hashes(pa.array([END.decode()]))[0]
        at, kind = TaskContext.get().partitionId() << 33, None
        asked: list[list[list[np.ndarray]]] = [[], []]

        def sent(asked: list[list[np.ndarray]], first: int, rounds: int) -> Iterator[pa.RecordBatch]:
            grams, owners = (np.concatenate(c) for c in zip(*asked, strict=True))
            by = _order(grams)
            grams, owners = grams[by], owners[by]
            bounds = np.searchsorted(_bucket(grams, rounds), np.arange(rounds + 1))
            for turn, (a, b) in enumerate(itertools.pairwise(bounds), first):
                for part in _dealt(_bucket(grams[a:b], buckets), 1, [grams[a:b], owners[a:b]], _narrowed):
                    none = [pa.nulls(len(part), t) for t in (kind, *types)]
                    turns = pa.array(np.full(len(part), turn, dtype=np.int32))
                    yield pa.RecordBatch.from_arrays([*none, turns, *part.columns], names=schema.names)

        for part in slices(batches, "text", TEXT_BYTES):
            kind = column(part, "rest").type
            sizes, hashes = text_hashes(column(part, "text"))
            n = len(sizes)
            gain, total = np.zeros(n), np.zeros(n)
            rows = np.repeat(np.arange(n), sizes + 2)
            maybe_in = np.zeros(0, dtype=bool)
            for order, (grams, whole) in enumerate(itertools.islice(_grams(sizes, hashes), depth + 1)):
                if order == depth:  # no context itself: it has a value only if its context has
                    whole = whole & maybe_in[:-1]
                owner = rows[: len(grams)]
                if order == depth:
                    hits = np.flatnonzero(whole)
                    hits = hits[_in_bitmap(often, grams[hits])]
                else:
                    hits = np.flatnonzero(_in_bitmap(often, grams) & whole)
                found, place = _found(keys, starts, grams[hits])
                hits = hits[found]
                gain += np.bincount(owner[hits], weights=worth[place[found]], minlength=n)
                maybe_in = whole.copy()
                if order == depth:
                    left = np.flatnonzero(whole)
                    maybe_in[left] = _in_bitmap(bits, grams[left])
                else:
                    maybe_in &= _in_bitmap(bits, grams)
                maybe_in[hits] = False
                maybe = np.flatnonzero(maybe_in)
                maybe_in[hits] = True
                asked[1].append([grams[maybe], (at + owner[maybe]).astype(np.uint64)])
            # The end is a word of every text.
            hashes = np.append(hashes, np.full(n, end))
            owner = np.append(np.repeat(np.arange(n), sizes), np.arange(n))
            found, place = _found(words, word_starts, hashes)
            own = np.bincount(owner[found], minlength=n)
            total += np.bincount(owner[found], weights=logs[place[found]], minlength=n)
            asked[0].append([hashes[~found], (at + owner[~found]).astype(np.uint64)])
            numbers = (at + np.arange(n), sizes + 1, own, total, gain)
            numbers = [pa.array(c, t) for c, t in zip(numbers, types, strict=True)]
            none = [pa.nulls(n, pa.int32()), pa.nulls(n, pa.int32()), pa.nulls(n, pa.int32()), pa.nulls(n, pa.binary())]
            yield pa.RecordBatch.from_arrays([column(part, "rest"), *numbers, *none], names=schema.names)
            at += n
            if sum(len(grams) for grams, _ in asked[1]) > PAIRS_AT_ONCE:
                yield from sent(asked[0], 0, 1)
                yield from sent(asked[1], 1, 1 << ROUND_BITS)
                asked = [[], []]
        if asked[0]:
            yield from sent(asked[0], 0, 1)
            yield from sent(asked[1], 1, 1 << ROUND_BITS)

    scored = written(packed.mapInArrow(_task(run), schema), "scored")
    model.destroy()

    def answers(turn: int, table: DataFrame) -> DataFrame:
        """``row, n, total``: how many of a text's words or grams of a round have a value,
        and the sum of these."""

        def looked_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            def found_in() -> Iterator[list[np.ndarray]]:
                for met in _met_buckets(batches, (2, 2)):
                    (keys, values), parts = _with_first(met, 2)
                    for grams, owners in map(_widened, parts):
                        found, at = _places(keys, grams)
                        yield [owners[found], values[at]]

            for owners, values in _together(found_in(), ROWS_AT_ONCE):
                row, n, total = summed(owners, np.ones(len(owners), dtype=np.int64), values.view(np.float64))
                where = (row % np.uint64(buckets)).astype(np.int32)
                by = np.argsort(where, kind="stable")
                yield from _dealt(where[by], 0, [row[by], n[by], total[by]], _narrowed)

        def summed(row: np.ndarray, n: np.ndarray, total: np.ndarray) -> tuple[np.ndarray, ...]:
            low = row.min() if len(row) else np.uint64(0)
            bits = len(row).bit_length()
            if len(row) and int(row.max() - low).bit_length() + bits <= 64:  # sorted with the place behind
                by = np.sort((row - low) << np.uint64(bits) | np.arange(len(row), dtype=np.uint64))
                by = (by & np.uint64((1 << bits) - 1)).astype(np.int64)
            else:
                by = np.argsort(row, kind="stable")
            new = np.flatnonzero(np.append(True, row[by[1:]] != row[by[:-1]])[: len(row)])
            return row[by[new]], np.add.reduceat(n[by], new), np.add.reduceat(total[by], new)

        def together(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for met in _met_buckets(batches, (3,)):
                row, n, total = _whole((np.stack(_widened(columns)) for _, columns in met), 3)
                row, n, total = summed(row, n.view(np.int64), total.view(np.float64))
                columns = [_signed(row), pa.array(n), pa.array(total)]
                yield pa.RecordBatch.from_arrays(columns, names=["row", "n", "total"])

        asked = scored.filter(F.col("round") == turn).select(*_SENT_NAMES)
        found = _met(table.union(asked), buckets)
        found = _met(found.mapInArrow(_task(looked_up), _SENT), buckets)
        return written(found.mapInArrow(_task(together), "row bigint, n bigint, total double"), f"answers-{turn}")

    rare = hashed.filter(F.col("c") < least)
    others = answers(0, _sent(rare, "gram", ["gram", "value"], buckets))
    others = others.select("row", F.col("n").alias("more"), F.col("total").alias("more_logs"))
    dropped(hashed)
    rounds = []
    for turn in range(1 << ROUND_BITS):  # only a round's share of the grams is on disk twice
        rounds.append(answers(1 + turn, shared(False, turn)))
        dropped()
    dropped(values.packed)
    gains = reduce(DataFrame.union, rounds).groupBy("row").agg(F.sum("total").alias("more_gain"))
    per_token = math.log10(size + kinds + 1)
    logs_of = F.col("logs") + F.coalesce("more_logs", F.lit(0.0))
    gain = F.col("gain") + F.coalesce("more_gain", F.lit(0.0))
    return (
        scored.filter("round IS NULL")
        .join(others, "row", "left")
        .join(gains, "row", "left")
        .withColumn("base_score", logs_of - F.col("n_tokens") * per_token)
        .select(
            "rest.*",
            "n_tokens",
            (F.col("known") + F.coalesce("more", F.lit(0))).alias("n_known"),
            F.lit(size).cast("bigint").alias("train_tokens"),
            "base_score",
            (F.col("base_score") + gain / math.log(10)).alias("score"),
        )
        .withColumn("held_out", held_out(F.col(f"`{ident}`")))
    )
