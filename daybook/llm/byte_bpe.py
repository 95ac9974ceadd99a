"""Byte-level BPE by rank: encode whole texts, decode ids.

A piece (one match of the split pattern) that is itself a token is that token.
Any other starts as single bytes, and the pair of lowest rank, leftmost among
equals, is merged until none is left. A segment tree over byte positions holds
each live pair as one number ``rank * leaves + position``, so its root is the
next merge, and a merge is three point updates up the tree: n log n for a piece
of n bytes, however long.

Workers remember the pieces that they meet a second time, up to a fixed number;
what is beyond it is merged again. Null text encodes as the empty text, a null list of
ids decodes to no bytes. Equal texts get equal ids. Other columns pass through;
one named like a result is replaced.
"""

from __future__ import annotations

import base64
from collections.abc import Callable, Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from daybook.llm.common import column, slices

REMEMBERED, _CELLS = 1 << 18, 1 << 22
REMEMBERED_LENGTH = 32


def read_ranks(path: str) -> bytes:
    """A rank file as it is: about 1 MB, sent along with the tasks."""
    with open(path, "rb") as file:
        return file.read()


def merged(piece: bytes, ranks: dict[bytes, int], longest: int) -> list[int]:
    """The ids of one piece after all merges."""
    n = len(piece)
    leaves = 1 << max(n - 1, 1).bit_length()
    never = len(ranks) * leaves + leaves
    tree = [never] * (2 * leaves)
    rank = ranks.get
    for i in range(n - 1):
        r = rank(piece[i : i + 2])
        if r is not None:
            tree[leaves + i] = r * leaves + i
    for k in range(leaves - 1, 0, -1):
        a, b = tree[2 * k], tree[2 * k + 1]
        tree[k] = a if a < b else b
    following, previous = list(range(1, n + 2)), list(range(-1, n))

    def update(i: int, value: int) -> None:
        k = leaves + i
        tree[k] = value
        while k > 1:
            other = tree[k ^ 1]
            k >>= 1
            value = value if value < other else other
            if tree[k] == value:
                return
            tree[k] = value

    def pair(i: int, end: int) -> int:
        r = rank(piece[i:end]) if end - i <= longest else None
        return never if r is None else r * leaves + i

    while tree[1] < never:
        i = tree[1] & (leaves - 1)
        gone = following[i]
        after = following[gone]
        following[i], previous[after] = after, i
        update(gone, never)
        update(i, pair(i, following[after]) if after < n else never)
        if i:
            before = previous[i]
            update(before, pair(before, after))
    ids, i = [], 0
    while i < n:
        ids.append(ranks[piece[i : following[i]]])
        i = following[i]
    return ids


class Pieces(dict):
    """Piece -> its ids as little-endian unsigned 32-bit numbers."""

    def __init__(self, ranks: dict[bytes, int]):
        super().__init__()
        self.ranks, self.longest = ranks, max(map(len, ranks), default=1)
        self.met = bytearray(_CELLS)

    def __missing__(self, piece: str) -> bytes:
        raw = piece.encode()
        known = self.ranks.get(raw)
        ids = [known] if known is not None else merged(raw, self.ranks, self.longest)
        packed = np.array(ids, dtype="<u4").tobytes()
        cell = hash(piece) % _CELLS
        if self.met[cell] and len(self) < REMEMBERED and len(piece) <= REMEMBERED_LENGTH:
            self[piece] = packed
        self.met[cell] = 1
        return packed


@cache
def _vocabulary(file: bytes) -> dict[bytes, int]:
    lines = (line.split() for line in file.splitlines())
    return {base64.b64decode(token): int(rank) for token, rank in lines}


@cache
def _pieces(file: bytes) -> Pieces:
    return Pieces(_vocabulary(file))


@cache
def _tokens(file: bytes) -> dict[int, bytes]:
    return {rank: token for token, rank in _vocabulary(file).items()}


def _others(rows: DataFrame, taken: str, result: str) -> list[str]:
    return [c for c in rows.columns if c not in (taken, result)]


def _decoded(packed: bytes, token: Callable[[int], bytes]) -> bytes:
    return b"".join(map(token, np.frombuffer(packed, dtype="<u4").tolist()))


def encode(
    rows: DataFrame,
    file: bytes,
    pattern: str,
    text: str = "text",
    ids: str = "ids",
    decoded: str = "",
) -> DataFrame:
    """``rows`` with ``ids`` (array<int>) in place of the text, and if named the
    bytes that the ids decode to, in the same pass."""
    rest = [c for c in _others(rows, text, ids) if c != decoded]
    added = [ids, *([decoded] if decoded else [])]
    schema = T.StructType([rows.schema[c] for c in rest]).add(ids, T.ArrayType(T.IntegerType()))
    schema = schema.add(decoded, T.BinaryType()) if decoded else schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        split, pieces, token = regex.compile(pattern).findall, _pieces(file), _tokens(file).__getitem__
        for part in slices(batches, text):
            packed = [
                b"".join(map(pieces.__getitem__, split(t))) if t else b""
                for t in column(part, text).to_pylist()
            ]
            ends = np.cumsum([0, *map(len, packed)]) // 4
            values = pa.array(np.frombuffer(b"".join(packed), dtype="<i4"))
            lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), values)
            columns = [column(part, c) for c in rest] + [lists]
            if decoded:
                columns.append(pa.array([_decoded(p, token) for p in packed], pa.binary()))
            yield pa.RecordBatch.from_arrays(columns, names=[*rest, *added])

    return rows.select(*(f"`{c}`" for c in [*rest, text])).mapInArrow(run, schema)


def decode(
    rows: DataFrame, file: bytes, ids: str = "ids", decoded: str = "decoded", packed: str = ""
) -> DataFrame:
    """``rows`` with the bytes of their ids, and if named the ids packed as
    little-endian unsigned 32-bit numbers, in place of the list."""
    added = [decoded, *([packed] if packed else [])]
    rest = [c for c in rows.columns if c != ids and c not in added]
    schema = T.StructType([rows.schema[c] for c in rest])
    for name in added:
        schema = schema.add(name, T.BinaryType())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        token = _tokens(file).__getitem__
        for batch in batches:
            lists = column(batch, ids)
            texts, numbers = [], []
            for i in range(len(lists)):
                one = lists[i].values
                values = one.to_numpy() if one is not None else np.zeros(0, dtype=np.int32)
                texts.append(b"".join(map(token, values.tolist())))
                if packed:
                    numbers.append(values.astype("<u4").tobytes())
            columns = [column(batch, c) for c in rest] + [pa.array(texts, pa.binary())]
            columns += [pa.array(numbers, pa.binary())] if packed else []
            yield pa.RecordBatch.from_arrays(columns, names=[*rest, *added])

    return rows.select(*(f"`{c}`" for c in [*rest, ids])).mapInArrow(run, schema)
