"""Conversation tries, vector codes and shards against brute force on messy rows."""

import collections
import hashlib
import math
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from daybook.llm import conversation_trie, queries, radix_tree, sharding, vector_codes
from daybook.llm.common import written
from daybook.session import prepare_workers

# --- radix tree --------------------------------------------------------------


@pytest.mark.parametrize("alphabet,count", [(2, 60), (15, 300), (47, 900), (256, 5000)])
def test_radix_tree_holds_its_keys_in_order(alphabet, count):
    draw = random.Random(alphabet)
    keys = {bytes(draw.randrange(alphabet) for _ in range(draw.randrange(7))) for _ in range(count)}
    keys |= {b"same" * 9, b"same" * 9 + b"x", b"same" * 5}
    listed = list(keys)
    draw.shuffle(listed)
    root = None
    for entry, key in enumerate(listed):
        root = radix_tree.insert(root, key, entry)
    found, layouts = [], set()

    def walk(node, path):
        layouts.add(node.layout)
        path += node.prefix
        if node.entry is not None:
            assert listed[node.entry] == path
            found.append(path)
        kids = list(node.items())
        assert len(kids) <= radix_tree.LAYOUTS[node.layout]
        assert len(kids) > 1 or node.entry is not None  # paths are compressed
        for byte, kid in kids:
            assert node.child(byte) is kid
            walk(kid, path + bytes([byte]))

    walk(root, b"")
    assert found == sorted(keys)
    assert max(layouts) == {2: 0, 15: 1, 47: 2, 256: 3}[alphabet]
    assert root.child(255) is None or alphabet == 256


# --- conversations -----------------------------------------------------------

TURNS = "conv_id bigint, turn bigint, role string, text string, n_convs int, `a b` string"


def talks():
    """Shared openings, whole copies, prefixes of others, ties, nulls, a long one."""
    draw = random.Random(4)
    rows = []
    for c in [*range(160), *range(200, 320), 401, 7_000_000_000, -5, -100, -250]:
        for t in range(draw.choice([0, 1, 2, 3, 6, 9])):
            rows.append((c, t, draw.choice(["user", "assistant", None]), draw.choice(["a", "é\U0001f600b", "", None])))
    for c in range(500, 560):  # copies of one conversation
        rows += [(c, t, "user", f"common {t}") for t in range(7)]
    rows += [(601, None, "user", "first"), (601, 0, "user", "second"), (601, 0, "bot", "tie")]
    rows += [(602, 3, "user", "x"), (602, 3, "user", "x"), (None, 0, "user", "nobody's")]
    rows += [(603, t, "user", f"long {t}") for t in range(300)]
    return rows


def nodes_by_hand(sequences):
    """The trie over ``{conv_id: [(role, text)]}``, from dictionaries of prefixes."""
    members = collections.defaultdict(list)
    for c, turns in sequences.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
    children = collections.Counter(p[:-1] for p in members if p)
    leaves, saved = collections.Counter(), collections.Counter()
    for path, ids in members.items():
        own = (len(ids) - 1) * len(path[-1][1]) if path else 0
        for d in range(len(path) + 1):
            leaves[path[:d]] += children[path] == 0
            saved[path[:d]] += own
    return sorted(
        (
            min(ids),
            len(path),
            min(members[path[:-1]]) if path else None,
            len(ids),
            children[path],
            leaves[path],
            saved[path],
            hashlib.sha256(
                ",".join(str(c) for c in sorted(ids) if len(sequences[c]) == len(path)).encode()
            ).hexdigest(),
        )
        for path, ids in members.items()
    )


def told(rows):
    turns = collections.defaultdict(list)
    for c, t, role, text in rows:
        if c is not None:
            turns[c].append((t is not None, t or 0, role or "", text or ""))
    return {c: [x[2:] for x in sorted(found)] for c, found in turns.items()}


def rebuilt_by_hand(own):
    result = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        donor = c - int(math.fmod(c, 100))
        result[c] = own.get(donor, [])[:h] + turns[h:]
    return result


def listed(nodes):
    return sorted(tuple(r) for r in nodes.select(*conversation_trie.NODE).collect())


@pytest.mark.parametrize("most_rows,most_bytes", [(1, 1 << 20), (7, 1 << 20), (1000, 100), (1 << 15, 8 << 20)])
def test_trie_against_dictionaries(spark, most_rows, most_bytes):
    """The same nodes whatever the blocks, also when copies of a key fill several."""
    prepare_workers(spark)
    rows = talks()
    table = spark.createDataFrame([(*r, 1, "x") for r in rows], TURNS).repartition(5)
    found = conversation_trie.trie(conversation_trie.sequences(table), most_rows, most_bytes)
    assert listed(found) == nodes_by_hand(told(rows))


def test_trie_query_rebuilds(spark, tmp_path):
    rows = talks()
    table = spark.createDataFrame([(*r, 1, "x") for r in rows], TURNS)
    table.write.parquet(str(tmp_path / "conversations.parquet"))
    found = queries.op11_conversation_trie(spark, str(tmp_path))
    wanted = nodes_by_hand(rebuilt_by_hand(told(rows)))
    assert any(d == 0 and n > 1 for _, d, _, n, *_ in wanted)
    assert listed(found) == wanted


def test_trie_of_nothing(spark):
    prepare_workers(spark)
    for rows in ([], [(None, 1, "user", "x", 1, "")]):
        table = spark.createDataFrame(rows, TURNS)
        assert conversation_trie.trie(conversation_trie.sequences(table)).count() == 0


# --- vector codes ------------------------------------------------------------


def coded_by_hand(vectors, parts=8, entries=16, rounds=6):
    """``{vec row: (code, error)}`` and codebooks; ``vectors`` in the order of their ids."""
    whole = [[math.floor(4096 * x) for x in v] for v in vectors]
    size = len(whole[0])
    edges = [size * i // parts for i in range(parts + 1)]
    books = []
    codes, error = [""] * len(whole), [0] * len(whole)
    for a, b in zip(edges, edges[1:], strict=False):
        points = [v[a:b] for v in whole]
        book = points[:entries]

        def nearest(p, book=None):
            return min(range(len(book)), key=lambda e: (sum((x - y) ** 2 for x, y in zip(p, book[e], strict=True)), e))

        for _ in range(rounds):
            owners = collections.defaultdict(list)
            for p in points:
                owners[nearest(p, book)].append(p)
            book = [
                [sum(c) // len(owners[e]) for c in zip(*owners[e], strict=True)] if owners[e] else book[e]
                for e in range(len(book))
            ]
        for i, p in enumerate(points):
            e = nearest(p, book)
            codes[i] += f"{e:02x}"
            error[i] += sum((x - y) ** 2 for x, y in zip(p, book[e], strict=True))
        books.append(book)
    return list(zip(codes, error, strict=True)), books


def vectors_of(count, size, seed):
    draw = np.random.default_rng(seed)
    values = draw.normal(0, 0.02, (count, size)).astype(np.float32)
    values[5:9] = values[4]  # equal entries: the lower index wins
    values[count // 3 : 2 * count // 3] = values[count // 3]  # one very common vector
    values[-20:] = np.round(values[-20:], 2)
    return values.tolist()


@pytest.mark.parametrize("points", [np.zeros((50, 3), dtype=np.int64), None])
def test_cover_tree_invariants(points):
    if points is None:
        points = np.random.default_rng(1).integers(-300, 300, (700, 4))
        points[100:300] = points[100]
    tree = vector_codes.cover_tree(points)
    assert sorted(tree.order.tolist()) == list(range(len(points)))
    ordered = points[tree.order].astype(float)
    for k in range(len(tree.lo)):
        lo, hi, r = tree.lo[k], tree.hi[k], tree.radius[k]
        away = np.linalg.norm(ordered[lo:hi] - ordered[lo], axis=1)
        assert abs(away.max() - r) < 1e-6
        if tree.children[k]:
            kids = range(tree.child[k], tree.child[k] + tree.children[k])
            assert [tree.lo[i] for i in kids] == [lo, *(tree.hi[i] for i in kids[:-1])] and tree.hi[kids[-1]] == hi
            half = 2.0 ** (math.ceil(math.log2(r)) - 1)
            assert all(tree.radius[i] <= half for i in kids)
            centres = ordered[[tree.lo[i] for i in kids]]
            gaps = np.linalg.norm(centres[:, None] - centres[None], axis=2)
            assert (gaps[~np.eye(len(centres), dtype=bool)] > half).all()


def test_whole_subtrees_are_assigned():
    """Clusters far apart go to their entry without being opened."""
    draw = np.random.default_rng(3)
    points = (draw.integers(0, 4, 2000)[:, None] * 10_000 + draw.integers(0, 50, (2000, 8))).astype(np.int64)
    tree = vector_codes.cover_tree(points)
    book = np.array([[10_000 * i] * 8 for i in range(4)])
    lo, hi, entry = vector_codes.assigned(tree, points[tree.order], book)
    assert len(lo) == 4
    found = np.empty(2000, dtype=int)
    for a, b, e in zip(lo, hi, entry, strict=True):
        found[tree.order[a:b]] = e
    assert (found == points[:, 0] // 10_000).all()


VECTORS = "vec_id bigint, embedding array<float>, label int, code int, `a b` string"


@pytest.mark.parametrize("count,size", [(300, 64), (40, 19), (7, 8)])
def test_vector_codes_against_brute_force(spark, count, size):
    prepare_workers(spark)
    values = vectors_of(max(count, 60), size, count)[:count]
    rows = [(i * 3, v, i % 4 or None, 1, "x") for i, v in enumerate(values)]
    nan, inf = float("nan"), float("inf")
    bad = [None, [], [None] * size, [*values[0][1:], nan], [*values[0][1:], inf], [*values[0][1:], -1e30], [0.5] * (size + 1)]
    table = spark.createDataFrame(rows + [(1, v, 9, 1, "x") for v in bad], VECTORS).repartition(3)
    coded, books = vector_codes.compressed(table)
    summed = vector_codes.with_group_error(written(coded, "codes")).collect()
    wanted, wanted_books = coded_by_hand(values)
    assert [b.tolist() for b in books] == wanted_books
    assert {r["vec_id"]: (r["code"], r["error"]) for r in summed} == {
        i * 3: w for i, w in enumerate(wanted)
    }
    totals = collections.Counter()
    for i, (_, error) in enumerate(wanted):
        totals[i % 4 or None] += error
    assert all(r["label_error"] == totals[r["label"]] and r["a b"] == "x" for r in summed)
    assert len(summed) == count


def test_vector_codes_order_of_ids(spark):
    """Null ids come last; of one id the lower vector comes first; rows of one id all stay."""
    prepare_workers(spark)
    values = sorted(vectors_of(60, 16, 9))
    rows = [(None if i >= 40 else i // 4, v, None, 1, "") for i, v in enumerate(values)]
    coded, books = vector_codes.compressed(spark.createDataFrame(rows[::-1], VECTORS))
    wanted, wanted_books = coded_by_hand(values)
    assert [b.tolist() for b in books] == wanted_books
    assert sorted((r["code"], r["error"]) for r in coded.collect()) == sorted(wanted)
    none = spark.createDataFrame([], VECTORS)
    coded, books = vector_codes.compressed(none)
    assert coded.count() == 0 and all(b.size == 0 for b in books)


def test_vector_codes_query(spark, tmp_path):
    values = vectors_of(80, 64, 2)
    rows = [(i, v, i % 3, 1, "x") for i, v in enumerate(values)]
    spark.createDataFrame(rows, VECTORS).write.parquet(str(tmp_path / "embeddings.parquet"))
    found = queries.op12_vector_codes(spark, str(tmp_path)).collect()
    _, books = coded_by_hand(values)
    text = ",".join(str(x) for b in books for e in b for x in e)
    assert {r["codebooks_sha256"] for r in found} == {hashlib.sha256(text.encode()).hexdigest()}
    assert len(found) == 80


# --- sharding ----------------------------------------------------------------

DOCS = "doc_id bigint, text string, shard string, slot int, `a b` int"


def documents():
    draw = random.Random(8)
    rows = [(i, "é" * draw.randint(0, 400)) for i in range(300)]
    rows += [(500, "same text")] * 150 + [(501, "x" * 20_000), (None, "no id"), (None, None), (502, None), (503, "")]
    return [(*r, "mine", 3, 7) for r in rows]


def test_shards_against_running_sums(spark):
    rows = documents()
    table = spark.createDataFrame(rows, DOCS).repartition(6)
    sized = table.withColumn("size", sharding.size_of("text"))
    for shards in (1, 3, 8, 1000):
        found = sharding.balanced(sized, shards).collect()
        assert len(found) == len(rows)
        by = sorted(found, key=lambda r: (r["shard"], r["slot"]))
        total, start, slot, last = sum(r["size"] for r in found), 0, -1, 0
        ids = [-1 if r["doc_id"] is None else r["doc_id"] for r in by]
        assert ids == sorted(ids)  # contiguous in the order of ids
        for r in by:
            assert r["shard"] == (2 * start + r["size"]) * shards // (2 * total)
            slot = slot + 1 if r["shard"] == last else 0
            last = r["shard"]
            assert r["slot"] == slot and r["a b"] == 7
            start += r["size"]
        counted = collections.Counter((r["doc_id"], r["text"]) for r in found)
        assert counted == collections.Counter((r[0], r[1]) for r in rows)
    assert sharding.balanced(sized.limit(0), 8).count() == 0
    with pytest.raises(ValueError):
        sharding.balanced(sized, 0)


def test_shards_of_no_bytes(spark):
    """Rows without any bytes still have a shard and a slot."""
    rows = spark.createDataFrame([(i, None) for i in range(5)], "doc_id bigint, size bigint")
    found = sorted(tuple(r) for r in sharding.balanced(rows, 4).collect())
    assert [(r[0], r[2], r[3]) for r in found] == [(i, 0, i) for i in range(5)]


def test_sharding_query(spark, tmp_path):
    rows = documents()
    spark.createDataFrame(rows, DOCS).write.parquet(str(tmp_path / "documents.parquet"))
    found = queries.op13_sharding(spark, str(tmp_path)).collect()
    crcs = collections.Counter((r[0], zlib.crc32((r[1] or "").encode()), len((r[1] or "").encode()) + 1) for r in rows)
    assert collections.Counter((r["doc_id"], r["text_crc32"], r["size"]) for r in found) == crcs
    totals = collections.Counter()
    for r in found:
        totals[r["shard"]] += r["size"]
    assert len(totals) == 8 and max(totals.values()) - min(totals.values()) <= 2 * 20_001
    assert {(r["law"], r["grown_shard"]) for r in found} == {("bytes", None)}


def test_shards_have_no_python(spark):
    """Spark's own functions on the whole path."""
    rows = spark.createDataFrame(documents(), DOCS)
    sized = rows.withColumn("size", sharding.size_of("text"))
    plan = sharding.balanced(sized, 8)._jdf.queryExecution().toString()
    assert "Python" not in plan and "MapInArrow" not in plan


def test_shards_written(spark, tmp_path):
    rows = spark.createDataFrame(documents(), DOCS)
    found = sharding.write(rows, str(tmp_path / "shards"), 8)
    assert found.count() == len(documents())
    one = spark.read.parquet(str(tmp_path / "shards" / "shard=2"))
    slots = sorted(r["slot"] for r in one.collect())
    assert slots == list(range(len(slots)))
    assert found.agg(F.countDistinct("shard")).first()[0] == 8
