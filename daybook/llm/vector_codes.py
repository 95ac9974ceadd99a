"""Vectors compressed to one small code per part, with codebooks from Lloyd's rounds
over cover trees.

A vector's components become the integers ``floor(SCALE * x)``, cut into ``parts``
stretches (as equal as its length allows). Every part has a codebook, at first that
part of the vectors with the smallest ids. A round assigns every part to its nearest
entry, ties to the lower index, and moves each entry to the floor of the mean of its
parts; entries without any stay.

Tasks build cover trees of some thousand vectors, one for each part, once. Below a
node of covering radius r stand children that lie more than r / 2 apart and cover its
points by r / 2; every subtree is a stretch of the tree's order, so running sums give
its sum and size. A round walks the trees from their roots: with a node's centre at
distance d from an entry and its farthest point at r, the entry cannot win any of the
node's points if d - r exceeds the lowest d + r. What has one entry left goes to it
whole; only the others descend, at last to exact comparisons in whole numbers. A
bound counts only with a margin beyond the rounding of its square roots, so results
are those of comparing everything.

A round sends a sum and a count for each part and entry. Trees hold the other columns
of their vectors, so no later join brings them back.

Rows are left out whose vector is null or empty, holds null or non-finite components,
has another length than the vector of the smallest id, or a component beyond
``_LARGEST / SCALE`` (less for more than 64 components), at which a squared distance
might not fit in 64 bits. A null id comes after
all others; of vectors with one id the lower components come first. Fewer vectors
than entries give smaller codebooks, and no rows give no rows. Columns named like
those added are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from daybook.llm.common import column, written

SCALE = 4096
PARTS = 8
ENTRIES = 16
ROUNDS = 6
#: Vectors of a tree, and points that a leaf may hold.
BLOCK, LEAF = 4096, 8
_MARGIN = 1e-9
_LARGEST = 1 << 27
_NEVER = np.iinfo(np.int64).max
_TREES = "struct<order:binary,lo:binary,hi:binary,radius:binary,child:binary,children:binary>"


def edges(size: int, parts: int) -> list[int]:
    return [size * i // parts for i in range(parts + 1)]


@dataclass(frozen=True)
class Tree:
    """Points in tree order; node k covers ``order[lo[k]:hi[k]]``, its centre first.

    Children of a node stand next to each other, after the node.
    """

    order: np.ndarray
    lo: np.ndarray
    hi: np.ndarray
    radius: np.ndarray
    child: np.ndarray
    children: np.ndarray


_TYPES = {
    "order": np.int32,
    "lo": np.int32,
    "hi": np.int32,
    "radius": np.float64,
    "child": np.int32,
    "children": np.int32,
}


def _squares(points: np.ndarray, centre: np.ndarray) -> np.ndarray:
    gap = points - centre
    return np.einsum("ij,ij->i", gap, gap)


def cover_tree(points: np.ndarray) -> Tree:
    """The tree of integer points (rows)."""
    order = np.arange(len(points), dtype=np.int32)
    far = _squares(points, points[0])
    nodes = [[0, len(points), float(np.sqrt(far.max())), 0, 0]]
    squares = far  # of every point, to the centre of the node that holds it last
    at = 0
    while at < len(nodes):
        lo, hi, radius, _, _ = node = nodes[at]
        at += 1
        if radius == 0 or hi - lo <= LEAF:
            continue
        # The covering radius is a power of two; children cover half of it.
        half = 2.0 ** (np.ceil(np.log2(radius)) - 1)
        own = order[lo:hi]
        inside = points[own]
        nearest = squares[own].astype(np.float64)
        owner = np.zeros(len(own), dtype=np.int32)
        centres = [0]
        while nearest.max() > half * half:
            # The first point not covered yet is more than half away from every centre.
            new = int(np.argmax(nearest > half * half))
            gap = _squares(inside, inside[new])
            closer = gap < nearest
            owner[closer] = len(centres)
            nearest = np.where(closer, gap, nearest)
            centres.append(new)
        first = owner * 2 + 1
        first[centres] -= 1
        by = np.argsort(first, kind="stable")
        order[lo:hi] = own[by]
        squares[order[lo:hi]] = nearest[by]
        sizes = np.bincount(owner, minlength=len(centres))
        node[3], node[4] = len(nodes), len(centres)
        ends = lo + np.cumsum(sizes)
        for end, size in zip(ends.tolist(), sizes.tolist(), strict=True):
            widest = squares[order[end - size : end]].max()
            nodes.append([end - size, end, float(np.sqrt(float(widest))), 0, 0])
    lo, hi, radius, child, children = zip(*nodes, strict=True)
    fields = {"order": order, "lo": lo, "hi": hi, "radius": radius, "child": child, "children": children}
    return Tree(**{n: np.array(v, dtype=_TYPES[n]) for n, v in fields.items()})


def assigned(
    tree: Tree, points: np.ndarray, book: np.ndarray
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Stretches of the tree's order and the entry that is nearest to all of each.

    ``points`` stand in tree order.
    """
    found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    # An entry equal to a lower one never wins.
    _, lowest = np.unique(book, axis=0, return_index=True)
    possible = np.isin(np.arange(len(book)), lowest)
    nodes = np.zeros(1, dtype=np.int64)
    open_ = possible[None, :]
    while len(nodes):
        centre = points[tree.lo[nodes]]
        gap = centre[:, None, :] - book[None, :, :]
        square = np.einsum("nkw,nkw->nk", gap, gap)
        square[~open_] = _NEVER
        best = square.argmin(axis=1)
        distance = np.sqrt(square.astype(np.float64))
        r = tree.radius[nodes]
        nearest = distance[np.arange(len(nodes)), best] + r
        slack = _MARGIN * (1.0 + nearest + r)
        open_ = open_ & (distance - r[:, None] <= (nearest + slack)[:, None])
        whole = (r == 0) | (open_.sum(axis=1) == 1)
        found.append((tree.lo[nodes[whole]], tree.hi[nodes[whole]], best[whole]))
        nodes, open_ = nodes[~whole], open_[~whole]
        leaf = tree.children[nodes] == 0
        if leaf.any():
            lo, size = tree.lo[nodes[leaf]], (tree.hi - tree.lo)[nodes[leaf]]
            at = np.repeat(lo - np.cumsum(size) + size, size) + np.arange(size.sum())
            gap = points[at][:, None, :] - book[None, :, :]
            square = np.einsum("nkw,nkw->nk", gap, gap)
            square[~np.repeat(open_[leaf], size, axis=0)] = _NEVER
            found.append((at, at + 1, square.argmin(axis=1)))
        inner = nodes[~leaf]
        width = tree.children[inner]
        open_ = np.repeat(open_[~leaf], width, axis=0)
        first = tree.child[inner]
        nodes = np.repeat(first - np.cumsum(width) + width, width) + np.arange(width.sum())
    return tuple(np.concatenate(x) for x in zip(*found, strict=True))


def _usable(rows: DataFrame, vector: str) -> DataFrame:
    """``held, vector`` of the vectors whose components are finite and in range."""
    added = ("code", "error")
    rest = [c for c in rows.columns if c != vector and c not in added]
    doubles = F.col(f"`{vector}`").cast("array<double>")
    rows = rows.select(
        F.struct(*(F.col(f"`{c}`") for c in rest)).alias("held"), doubles.alias("vector")
    )
    bound = F.when(F.size("vector") > 64, F.sqrt(F.lit(2.0**61) / F.size("vector")))
    bound = F.coalesce(bound, F.lit(float(_LARGEST))) / SCALE - 1
    fine = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) <= bound))
    return rows.filter((F.size("vector") > 0) & fine)


def _blocks(vectors: DataFrame, parts: int) -> DataFrame:
    """A row per some thousand vectors: ``held`` of each, points and a tree per part."""
    held_type = vectors.schema["held"].dataType
    schema = T.StructType(
        [
            T.StructField("held", T.ArrayType(held_type)),
            T.StructField("points", T.BinaryType()),
            *T.StructType.fromDDL(f"trees array<{_TREES}>").fields,
        ]
    )

    def packed(held: list[pa.Array], points: list[np.ndarray]) -> pa.RecordBatch:
        rest, whole = pa.concat_arrays(held), np.concatenate(points)
        cuts = edges(whole.shape[1], parts)
        trees = [cover_tree(whole[:, a:b]) for a, b in zip(cuts, cuts[1:], strict=False)]
        lists = [{n: getattr(t, n).tobytes() for n in _TYPES} for t in trees]
        one = pa.array([0, len(rest)], pa.int32())
        columns = [pa.ListArray.from_arrays(one, rest), pa.array([whole.astype(np.int32).tobytes()], pa.binary())]
        types = pa.list_(pa.struct([(n, pa.binary()) for n in _TYPES]))
        return pa.RecordBatch.from_arrays([*columns, pa.array([lists], types)], names=schema.names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.Array] = []
        points: list[np.ndarray] = []
        size = 0
        for batch in batches:
            if not batch.num_rows:
                continue
            lists = column(batch, "vector")
            values = lists.flatten().to_numpy(zero_copy_only=False)
            whole = np.floor(SCALE * values).astype(np.int64).reshape(batch.num_rows, -1)
            start = 0
            while start < len(whole):
                taken = min(BLOCK - size, len(whole) - start)
                held.append(column(batch, "held").slice(start, taken))
                points.append(whole[start : start + taken])
                size, start = size + taken, start + taken
                if size == BLOCK:
                    yield packed(held, points)
                    held, points, size = [], [], 0
        if size:
            yield packed(held, points)

    return vectors.mapInArrow(run, schema)


def _block_rows(batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, list[Tree]]]:
    """Points and trees of each row; a copy of one row's at a time."""
    for raw, packed in zip(column(batch, "points"), column(batch, "trees"), strict=True):
        trees = [
            Tree(**{n: np.frombuffer(t[n], dtype=k) for n, k in _TYPES.items()}) for t in packed.as_py()
        ]
        whole = np.frombuffer(raw.as_py(), dtype=np.int32).astype(np.int64)
        yield whole.reshape(len(trees[0].order), -1), trees


def _sums(blocks: DataFrame, books: list[np.ndarray]) -> list[list[tuple[int, list[int]]]]:
    """Count and sum of what each entry is nearest to, by part."""
    widest = max(b.shape[1] for b in books)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = [np.zeros(len(b), dtype=np.int64) for b in books]
        totals = [np.zeros(b.shape, dtype=np.int64) for b in books]
        for batch in batches:
            for whole, trees in _block_rows(batch):
                cuts = edges(whole.shape[1], len(books))
                for part, (tree, book) in enumerate(zip(trees, books, strict=True)):
                    points = whole[:, cuts[part] : cuts[part + 1]][tree.order]
                    lo, hi, entry = assigned(tree, points, book)
                    ahead = np.zeros((len(points) + 1, points.shape[1]), dtype=np.int64)
                    np.cumsum(points, axis=0, out=ahead[1:])
                    np.add.at(counts[part], entry, hi - lo)
                    np.add.at(totals[part], entry, ahead[hi] - ahead[lo])
        rows = [
            {"part": p, "entry": e, "n": int(n), "total": total.tolist() + [0] * (widest - len(total))}
            for p, (count, sums) in enumerate(zip(counts, totals, strict=True))
            for e, (n, total) in enumerate(zip(count, sums, strict=True))
            if n
        ]
        fields = [("part", pa.int32()), ("entry", pa.int32()), ("n", pa.int64()), ("total", pa.list_(pa.int64()))]
        yield pa.RecordBatch.from_pylist(rows, pa.schema(fields))

    partial = blocks.select("points", "trees").mapInArrow(
        run, "part int, entry int, n bigint, total array<bigint>"
    )
    # Whole numbers of any length: the sum of a table's components may pass 64 bits.
    sums = [F.sum(F.col("total")[i].cast("decimal(38,0)")).alias(f"t{i}") for i in range(widest)]
    rows = partial.groupBy("part", "entry").agg(F.sum("n").alias("n"), *sums).collect()
    found = [[(0, [])] * len(b) for b in books]
    for part, entry, n, *total in rows:  # one row per part and entry
        found[part][entry] = (n, [int(t) for t in total[: books[part].shape[1]]])
    return found


def _moved(book: np.ndarray, sums: list[tuple[int, list[int]]]) -> np.ndarray:
    return np.array(
        [[t // n for t in total] if n else old for old, (n, total) in zip(book.tolist(), sums, strict=True)],
        dtype=np.int64,
    ).reshape(book.shape)


def _coded(blocks: DataFrame, books: list[np.ndarray]) -> DataFrame:
    held_type = blocks.schema["held"].dataType.elementType
    schema = T.StructType(
        [
            T.StructField("held", held_type),
            T.StructField("code", T.StringType()),
            T.StructField("error", T.LongType()),
        ]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = column(batch, "held")
            for n, (whole, trees) in enumerate(_block_rows(batch)):
                cuts = edges(whole.shape[1], len(books))
                codes = np.empty((len(whole), len(books)), dtype=np.uint8)
                error = np.zeros(len(whole), dtype=np.int64)
                for part, (tree, book) in enumerate(zip(trees, books, strict=True)):
                    points = whole[:, cuts[part] : cuts[part + 1]]
                    lo, hi, entry = assigned(tree, points[tree.order], book)
                    # The stretches cover the order once: sorted, they follow each other.
                    by = np.argsort(lo)
                    codes[tree.order, part] = np.repeat(entry[by], (hi - lo)[by])
                    error += _squares(points, book[codes[:, part]])
                text = codes.tobytes().hex()
                step = 2 * len(books)
                shown = [text[i : i + step] for i in range(0, len(text), step)]
                held = lists.slice(n, 1).flatten()
                yield pa.RecordBatch.from_arrays(
                    [held, pa.array(shown), pa.array(error)], names=schema.names
                )

    return blocks.mapInArrow(run, schema)


def compressed(
    rows: DataFrame,
    ident: str = "vec_id",
    vector: str = "embedding",
    parts: int = PARTS,
    entries: int = ENTRIES,
    rounds: int = ROUNDS,
) -> tuple[DataFrame, list[np.ndarray]]:
    """``rows`` without the vector, with ``code`` (two hex digits per part) and
    ``error``, the sum of squared distances to the entries; and the codebooks."""
    if not 1 <= entries <= 256:
        raise ValueError("1 to 256 entries")
    usable = _usable(rows, vector)
    by = [F.col(f"held.`{ident}`").asc_nulls_last(), F.col("vector")]
    first = usable.orderBy(*by).limit(entries)
    low = [r["vector"] for r in first.select("vector").collect()]  # as many as entries at most
    size = len(low[0]) if low else 0
    if any(len(v) != size for v in low):
        first = usable.filter(F.size("vector") == size).orderBy(*by).limit(entries)
        low = [r["vector"] for r in first.select("vector").collect()]
    cuts = edges(size, parts)
    whole = np.floor(SCALE * np.array(low, dtype=np.float64)).astype(np.int64).reshape(len(low), size)
    books = [whole[:, a:b] for a, b in zip(cuts, cuts[1:], strict=False)]
    blocks = written(_blocks(usable.filter(F.size("vector") == size), parts), "cover-trees")
    if low:
        for _ in range(rounds):
            sums = _sums(blocks, books)
            books = [_moved(b, s) for b, s in zip(books, sums, strict=True)]
    return _coded(blocks, books).select("held.*", "code", "error"), books


def with_group_error(coded: DataFrame, group: str = "label", name: str = "label_error") -> DataFrame:
    """``error`` summed over the rows of equal ``group``, nulls together.

    Sums are made before the shuffle, and a group's rows are never gathered."""
    key = F.col(f"`{group}`")
    total = coded.groupBy(key.alias("__group")).agg(F.sum("error").alias("__sum"))
    joined = coded.drop(name).join(total, key.eqNullSafe(F.col("__group")), "left")
    return joined.withColumn(name, F.col("__sum")).drop("__group", "__sum")
