"""The trie of conversations: a node for each distinct sequence of first turns.

A turn is named by 16 bytes, the head of the SHA-256 of its role and text, and a
conversation's key is the names of its turns one after the other. Keys are dealt out
by ranges in byte order, so every subtree is a stretch of neighbouring tasks. A task
puts its keys, some block of them at a time, into an adaptive radix tree; only depths
at whole turns are nodes of the trie.

A node above neither the first nor the last key of its block is found in this block
alone (closed), and its numbers are final. Others may go on in other blocks (open);
each block gives its share of them: members, and what its closed nodes below add up
to. A block has no more open nodes than its first and last key have turns. Their
shares are summed by a running hash of the turns, and each open node that adds to a
sum adds to those above it, along the chain of its block.

Ids of the conversations that end at a node are hashed in the block; of open nodes
they are sent on as one string per block and hashed one string after the other. No
group of copies is ever held whole: equal keys are spread over tasks like others.

Turns are ordered by number (null first), then by role and name; null role or text is
empty. Rows without a conversation id belong to none and are left out. A conversation
is one row, 20 bytes a turn. No conversations give no nodes.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from daybook.llm.common import column, written
from daybook.llm.radix_tree import Node, insert

#: Bytes of a turn's name.
WIDTH = 16
#: Conversations of a block, and the bytes of its keys.
BLOCK_ROWS, BLOCK_BYTES = 1 << 15, 8 << 20
#: Parts of a node's children when they are told its id.
SALTS = 16
_INNER, _UNDER_OPEN, _OPEN, _CHAIN, _ENDS = range(5)
_NOBODY = hashlib.sha256(b"").hexdigest()


def sequences(
    rows: DataFrame,
    ident: str = "conv_id",
    turn: str = "turn",
    role: str = "role",
    text: str = "text",
) -> DataFrame:
    """``conv_id, turns``: the turns of each conversation in order, as ``id`` (32 hex
    digits) and ``size`` (code points of the text)."""
    who = F.coalesce(F.col(f"`{role}`"), F.lit(""))
    what = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    name = F.sha2(F.concat(F.char_length(who).cast("string"), F.lit(":"), who, what), 256)
    named = rows.filter(F.col(f"`{ident}`").isNotNull()).select(
        F.col(f"`{ident}`").cast("bigint").alias("conv_id"),
        F.struct(
            F.col(f"`{turn}`").alias("turn"),
            who.alias("role"),
            F.substring(name, 1, 2 * WIDTH).alias("id"),
            F.char_length(what).alias("size"),
        ).alias("t"),
    )
    ordered = F.sort_array(F.collect_list("t"))
    short = F.transform(ordered, lambda t: F.struct(t["id"].alias("id"), t["size"].alias("size")))
    return named.groupBy("conv_id").agg(short.alias("turns"))


def rebuilt(conversations: DataFrame, donor: Column, taken: Column, most: int) -> DataFrame:
    """Conversations whose first ``taken`` turns (at most ``most``) are those of the
    conversation ``donor``, as far as it has them. Give a written table."""
    heads = conversations.select(
        F.col("conv_id").alias("donor"), F.slice("turns", 1, most).alias("head")
    )
    asked = conversations.select("conv_id", "turns", donor.alias("donor"), taken.alias("taken"))
    heads = heads.join(asked.select("donor").distinct(), "donor", "left_semi")
    head = F.coalesce(F.slice("head", F.lit(1), F.col("taken")), F.expr("filter(turns, t -> false)"))
    rest = F.slice("turns", F.col("taken") + 1, F.size("turns"))
    return asked.join(heads, "donor", "left").select("conv_id", F.concat(head, rest).alias("turns"))


@dataclass
class Block:
    """Different keys in order, each with the ids that have it, ascending."""

    keys: list[bytes] = field(default_factory=list)
    sizes: list[list[int]] = field(default_factory=list)
    ids: list[list[int]] = field(default_factory=list)
    rows: int = 0
    held: int = 0

    def add(self, ident: int, key: bytes, sizes: list[int]) -> None:
        if not self.keys or self.keys[-1] != key:
            self.keys.append(key)
            self.sizes.append(sizes)
            self.ids.append([])
            self.held += len(key)
        self.ids[-1].append(ident)
        self.rows += 1


def _chain(key: bytes) -> list[bytes]:
    """The running hash of a key's turns, from the root on."""
    links = [bytes(WIDTH)]
    for at in range(0, len(key), WIDTH):
        links.append(hashlib.blake2b(links[-1] + key[at : at + WIDTH], digest_size=WIDTH).digest())
    return links


def _joined(ids: list[int]) -> str:
    return ",".join(map(str, ids))


@dataclass
class Below:
    """What stands under a place of the tree: its keys from ``low`` to ``high``, members
    and smallest member, and the rows of the topmost nodes with their sums."""

    low: int
    high: int
    n: int = 0
    smallest: int = 0
    tops: list[dict] = field(default_factory=list)
    leaves: int = 0
    saved: int = 0


def block_rows(block: Block, number: int) -> list[dict]:
    """The rows of a block's trie; ``number`` tells its chains from all others."""
    root: Node | None = None
    for entry, key in enumerate(block.keys):
        root = insert(root, key, entry)
    last = len(block.keys) - 1
    chains = (_chain(block.keys[0]), _chain(block.keys[last]))
    rows = [
        {"kind": _CHAIN, "chain": 2 * number + side, "links": links}
        for side, links in enumerate(chains)
    ]

    def emit(place: Below, depth: int, entry: int | None) -> Below:
        """The trie's node at this depth, over what stands below it."""
        side = 0 if place.low == 0 else 1 if place.high == last else None
        size = block.sizes[place.low][depth - 1] if depth else 0
        row = {"kind": _INNER, "depth": depth, "conv_id": place.smallest, "n_convs": place.n}
        row["n_children"] = len(place.tops)
        if side is None:
            row["n_leaves"] = place.leaves if place.tops else 1
            row["saved_tokens"] = place.saved + (place.n - 1) * size
            row["ends_sha256"] = _NOBODY
            if entry is not None:
                row["ends_sha256"] = hashlib.sha256(_joined(block.ids[entry]).encode()).hexdigest()
            for top in place.tops:
                top["parent_conv_id"] = place.smallest
        else:
            links = chains[side]
            closed = [t for t in place.tops if t["kind"] != _OPEN]
            for top in closed:
                top["kind"], top["parent_key"] = _UNDER_OPEN, links[depth]
            row |= {"kind": _OPEN, "key": links[depth], "parent_key": links[depth - 1] if depth else None}
            row |= {"chain": 2 * number + side, "size": size, "n_children": len(closed)}
            row |= {"n_leaves": place.leaves, "saved_tokens": place.saved}
            if entry is not None:
                ids = block.ids[entry]
                rows.append({"kind": _ENDS, "key": links[depth], "conv_id": ids[0], "ids": _joined(ids)})
        rows.append(row)
        return Below(
            place.low, place.high, place.n, place.smallest, [row], row["n_leaves"], row["saved_tokens"]
        )

    # Each node is met twice: before what stands below it and after.
    done: dict[int, list[Below]] = {}
    stack = [(root, len(root.prefix), -1, None)]
    result: list[Below] = []
    while stack:
        node, end, above, into = stack.pop()
        if id(node) not in done:
            found = done[id(node)] = []
            stack.append((node, end, above, into))
            stack += [(kid, end + 1 + len(kid.prefix), end, found) for _, kid in node.items()]
            continue
        parts = done.pop(id(node))
        entry = node.entry
        if entry is not None:
            ids = block.ids[entry]
            parts.append(Below(entry, entry, len(ids), ids[0]))
        place = Below(
            min(p.low for p in parts),
            max(p.high for p in parts),
            sum(p.n for p in parts),
            min(p.smallest for p in parts),
            [t for p in parts for t in p.tops],
            sum(p.leaves for p in parts),
            sum(p.saved for p in parts),
        )
        # The whole turns that end on the way from the node above, the deepest first.
        for depth in range(end // WIDTH, above // WIDTH, -1):
            place = emit(place, depth, entry if depth * WIDTH == end else None)
        (result if into is None else into).append(place)
    return rows


_ROW = pa.schema(
    [
        ("kind", pa.int32()),
        ("conv_id", pa.int64()),
        ("depth", pa.int64()),
        ("parent_conv_id", pa.int64()),
        ("n_convs", pa.int64()),
        ("n_children", pa.int64()),
        ("n_leaves", pa.int64()),
        ("saved_tokens", pa.int64()),
        ("ends_sha256", pa.string()),
        ("key", pa.binary()),
        ("parent_key", pa.binary()),
        ("chain", pa.int64()),
        ("size", pa.int64()),
        ("links", pa.list_(pa.binary())),
        ("ids", pa.string()),
    ]
)
_ROW_DDL = (
    "kind int, conv_id bigint, depth bigint, parent_conv_id bigint, n_convs bigint, n_children bigint,"
    " n_leaves bigint, saved_tokens bigint, ends_sha256 string, key binary, parent_key binary,"
    " chain bigint, size bigint, links array<binary>, ids string"
)
NODE = (
    "conv_id",
    "depth",
    "parent_conv_id",
    "n_convs",
    "n_children",
    "n_leaves",
    "saved_tokens",
    "ends_sha256",
)


def _block_nodes(keys: DataFrame, most_rows: int, most_bytes: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32

        def closed(block: Block) -> Iterator[pa.RecordBatch]:
            rows = block_rows(block, number)
            for start in range(0, len(rows), 10_000):
                yield pa.RecordBatch.from_pylist(rows[start : start + 10_000], _ROW)

        block = Block()
        for batch in batches:
            columns = (column(batch, c).to_pylist() for c in ("conv_id", "path", "sizes"))
            for row in zip(*columns, strict=True):
                block.add(*row)
                if block.rows >= most_rows or block.held >= most_bytes:
                    yield from closed(block)
                    block, number = Block(), number + 1
        if block.rows:
            yield from closed(block)

    return keys.mapInArrow(run, _ROW_DDL)


def _hashed_ends(ends: DataFrame) -> DataFrame:
    """``key, ends_sha256``: the strings of each key, hashed one after the other."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, digest = None, hashlib.sha256()
        for batch in batches:
            found = []
            for own, ids in zip(*(column(batch, c).to_pylist() for c in ("key", "ids")), strict=True):
                if own == key:
                    digest.update(b",")
                else:
                    if key is not None:
                        found.append((key, digest.hexdigest()))
                    key, digest = own, hashlib.sha256()
                digest.update(ids.encode())
            yield made(found)
        if key is not None:
            yield made([(key, digest.hexdigest())])

    def made(found: list[tuple[bytes, str]]) -> pa.RecordBatch:
        columns = [[k for k, _ in found], [d for _, d in found]]
        types = (pa.binary(), pa.string())
        return pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=["key", "ends_sha256"]
        )

    sorted_ = ends.select("key", "conv_id", "ids").repartition("key").sortWithinPartitions("key", "conv_id")
    return sorted_.mapInArrow(run, "key binary, ends_sha256 string")


def _merged(rows: DataFrame) -> DataFrame:
    """The open nodes of all blocks, with their own key and that of their parent."""
    shares = rows.filter(F.col("kind") == _OPEN).groupBy("key")
    sums = ("n_convs", "n_children", "n_leaves", "saved_tokens")
    nodes = shares.agg(
        *(F.sum(c).alias(c) for c in sums),
        F.min("conv_id").alias("conv_id"),
        *(F.first(c).alias(c) for c in ("depth", "parent_key", "size")),
        F.min("chain").alias("chain"),
    )
    nodes = written(nodes, "open-nodes")
    below = nodes.groupBy(F.col("parent_key").alias("key")).agg(F.count("*").alias("more"))
    nodes = nodes.join(below, "key", "left").withColumn(
        "n_children", F.col("n_children") + F.coalesce("more", F.lit(0))
    )
    leaf = F.when(F.col("n_children") == 0, 1).otherwise(0).cast("bigint")
    saves = (F.col("n_convs") - 1) * F.col("size")
    nodes = written(nodes.withColumns({"leaf": leaf, "saves": saves}), "open-nodes-with-children")
    chains = rows.filter(F.col("kind") == _CHAIN).select("chain", "links")
    giving = nodes.filter("leaf > 0 OR saves > 0").select("chain", "depth", "leaf", "saves")
    given = giving.join(chains, "chain").select(
        F.explode(F.slice("links", F.lit(1), F.col("depth").cast("int") + 1)).alias("key"), "leaf", "saves"
    )
    given = given.groupBy("key").agg(F.sum("leaf").alias("leaves"), F.sum("saves").alias("saved"))
    zero = F.lit(0).cast("bigint")
    return nodes.join(given, "key", "left").withColumns(
        {
            "n_leaves": F.col("n_leaves") + F.coalesce("leaves", zero),
            "saved_tokens": F.col("saved_tokens") + F.coalesce("saved", zero),
        }
    )


def trie(
    conversations: DataFrame, most_rows: int = BLOCK_ROWS, most_bytes: int = BLOCK_BYTES
) -> DataFrame:
    """The nodes over ``conv_id, turns``: a node is known by its smallest member and its
    depth, and its parent by ``parent_conv_id`` and one depth less."""
    names = F.array_join(F.transform("turns", lambda t: t["id"]), "")
    keys = conversations.select(
        "conv_id", F.unhex(names).alias("path"), F.transform("turns", lambda t: t["size"]).alias("sizes")
    )
    by = [F.col("path"), F.col("conv_id")]
    dealt = written(keys, "keys").repartitionByRange(*by).sortWithinPartitions(*by)
    rows = written(_block_nodes(dealt, most_rows, most_bytes), "block-nodes")
    ends = _hashed_ends(rows.filter(F.col("kind") == _ENDS))
    merged = written(_merged(rows).join(ends, "key", "left"), "merged-nodes")
    ids = merged.select(F.col("key").alias("parent_key"), F.col("conv_id").alias("parent_conv_id"))
    opened = merged.join(ids, "parent_key", "left").withColumn(
        "ends_sha256", F.coalesce("ends_sha256", F.lit(_NOBODY))
    )
    # Any number of closed nodes may hang under one open node, such as the root.
    salted = ids.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    under = rows.filter(F.col("kind") == _UNDER_OPEN).drop("parent_conv_id")
    under = under.withColumn("salt", F.pmod(F.xxhash64("conv_id"), F.lit(SALTS)).cast("int"))
    under = under.join(salted, ["parent_key", "salt"])
    inner = rows.filter(F.col("kind") == _INNER)
    return inner.select(*NODE).unionByName(under.select(*NODE)).unionByName(opened.select(*NODE))
