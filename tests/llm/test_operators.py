"""The operators against brute force, on messy rows: nulls, ties, repeats, long texts."""

import base64
import collections
import gzip
import hashlib
import math
import os
import random
import time
import zlib

import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest
import xxhash
from pyspark.sql import functions as F
from pyspark.sql import types as T

from daybook.llm import (
    byte_bpe,
    components,
    fingerprints,
    mixing,
    quality_rules,
    queries,
    repeated_spans,
    simhash,
    suffix_array,
    suffix_tree_lm,
    token_files,
    url_filter,
    warc,
)
from daybook.session import prepare_workers, shared_folder

DOCS = "doc_id bigint, text string, kept string, `a b` int"
WORDS = "the of and to in der die la que thanedble erntand enachberau ñosll ció. été| 12 x!".split()


def prose(seed, words):
    draw = random.Random(seed)
    return " ".join(
        draw.choice(WORDS) + (str(draw.randint(0, 99)) if i % 6 else "") for i in range(words)
    )


@pytest.fixture(scope="module")
def docs():
    """(doc_id, text): copies, near copies, shared passages, nulls, odd and long texts."""
    base = prose(1, 120)
    passage = prose(2, 90)
    rows = [(i, prose(10 + i, 40 + i)) for i in range(8)]
    rows += [(20, base), (21, base), (22, base.replace("the", "die", 1)), (23, base + " end")]
    rows += [(30, f"{prose(5, 30)} {passage} {prose(6, 30)}"), (31, f"{passage} {prose(7, 9)}")]
    rows += [(40, None), (41, ""), (42, " \n\t "), (43, "word"), (44, "a b c d e f"), (None, prose(9, 60))]
    rows += [(50, "ab" * 900), (51, "Heer " * 300), (52, prose(99, 30000)), (53, "€\U0001f600é" * 400)]
    rows += [(60, "twice " * 3), (60, "twice " * 3), (60, "other text under the same id")]
    return rows


@pytest.fixture(scope="module")
def table(spark, docs):
    prepare_workers(spark)
    return spark.createDataFrame([(*row, "mine", 7) for row in docs], DOCS)


@pytest.fixture(scope="module")
def empty(spark):
    prepare_workers(spark)
    return spark.createDataFrame([], DOCS)


def raw(text):
    return (text or "").encode()


# --- quality rules -----------------------------------------------------------


def counted(text):
    words = raw(text).split()
    windows = collections.Counter(tuple(words[i : i + 5]) for i in range(len(words) - 4))
    covered = {
        i + k for i in range(len(words) - 4) if windows[tuple(words[i : i + 5])] > 1 for k in range(5)
    }
    lines = [x for x in (text or "").split("\n") if x.encode().split()]
    return (
        len(words),
        sum(len(w.decode()) for w in words),
        sum(c in "#*$%&|<>" for c in text or ""),
        len(lines) - len(set(lines)),
        len(covered),
    )


def test_quality_counts(table, docs):
    base = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    judged = quality_rules.judge(table)
    assert "a b" in judged.columns
    got = sorted(tuple(r) for r in judged.fillna(-1, "doc_id").select("doc_id", *base).collect())
    assert got == sorted((-1 if i is None else i, *counted(t)) for i, t in docs)


def test_quality_keeps_own_columns(table, empty):
    kept = quality_rules.kept_rows(table)
    assert kept.columns == table.columns
    ids = {r["doc_id"] for r in kept.collect()}
    assert {0, 20, 21, 30} <= ids and not ids & {40, 41, 43, 51}
    assert {r["kept"] for r in kept.collect()} == {"mine"}
    assert quality_rules.kept_rows(empty).count() == 0


def test_quality_on_labels(spark):
    """Held-out labels: junk goes, clean documents that pass the base stay."""
    folder = "/root/testdata/sf0.01"
    judged = quality_rules.judge(spark.read.parquet(f"{folder}/documents.parquet"))
    labelled = judged.join(spark.read.parquet(f"{folder}/labels.parquet"), "doc_id")
    rows = labelled.select("quality", "base_failed", "kept").collect()
    clean = [r.kept for r in rows if r.quality == 1 and not r.base_failed]
    junk = [r.kept for r in rows if r.quality == 0]
    assert sum(clean) >= 0.99 * len(clean)
    assert sum(junk) <= 0.05 * len(junk)


# --- fingerprints ------------------------------------------------------------


def test_fingerprints_with_next(spark, table, docs):
    order = sorted(
        docs,
        key=lambda r: (r[0] is None, -(r[0] or 0), xxhash.xxh64_intdigest(raw(r[1]), 42) - (1 << 64)
                       if xxhash.xxh64_intdigest(raw(r[1]), 42) >> 63 else xxhash.xxh64_intdigest(raw(r[1]), 42)),
    )
    expected = collections.Counter()
    for i, (ident, text) in enumerate(order):
        other = order[(i + 1) % len(order)][1] or ""
        own = text or ""
        changed = fingerprints.edited(own, other)
        expected[ident, len(own), hashlib.sha256(changed.encode()).hexdigest()] += 1
    rows = fingerprints.compared_with_next(table).collect()
    assert collections.Counter((r[0], r[1], r[2]) for r in rows) == expected
    by_text = {}
    for r in rows:
        by_text.setdefault(r["doc_id"], set()).add(r["fingerprint"])
    assert by_text[20] == by_text[21] and by_text[40] == by_text[41] == by_text[42]
    assert all(0 <= r["near_edited"] <= 1 and 0 <= r["near_next"] <= 1 for r in rows)


def test_fingerprints_of_one_and_no_rows(spark, empty):
    assert fingerprints.compared_with_next(empty).count() == 0
    one = spark.createDataFrame([(None, "abcd")], "doc_id bigint, text string")
    row = fingerprints.compared_with_next(one).collect()[0]
    assert row["edited_sha256"] == hashlib.sha256(b"abab").hexdigest()


def test_sketches_estimate_and_merge(spark):
    a, b = prose(1, 4000).encode(), prose(2, 4000).encode()
    both = a + b" " + b
    k = 1024
    merged = fingerprints.merge(fingerprints.sketch(a, k), fingerprints.sketch(b, k), k)
    whole = fingerprints.sketch(both, k)
    assert len(np.intersect1d(merged, whole)) > 0.99 * k
    count = len(set(fingerprints.shingle_hashes(both).tolist()))
    assert abs(fingerprints.distinct(whole, k) / count - 1) < 0.1
    assert fingerprints.containment(fingerprints.sketch(a, k), whole, k) > 0.9
    parts = spark.createDataFrame([(1, a.decode()), (1, b.decode())], "g int, text string")
    row = fingerprints.merged(fingerprints.with_sketches(parts, k=64), ["g"], k=64).collect()[0]
    expected = fingerprints.merge(fingerprints.sketch(a, 64), fingerprints.sketch(b, 64), 64)
    assert row["sketch"] == expected.tolist()


def test_sketches_of_many_groups_merge(spark, monkeypatch):
    """A hot group, a null one, parts without shingles, and more groups than a task holds."""
    prepare_workers(spark)
    draw = random.Random(4)
    rows = [(g, sorted(draw.sample(range(10**6), 30))) for g in [*range(5000), *[7] * 900, None, None]]
    rows += [(7, None), (9000, []), (9000, None)]
    table = spark.createDataFrame(rows, "g int, sketch array<bigint>").repartition(5)
    found = {r["g"]: r["sketch"] for r in fingerprints.merged(table, ["g"], k=20).collect()}
    wanted = collections.defaultdict(set)
    for g, values in rows:
        wanted[g].update(values or [])
    assert found == {g: sorted(values)[:20] for g, values in wanted.items()}
    assert fingerprints.merged(table.limit(0), ["g"]).count() == 0


# --- SimHash -----------------------------------------------------------------


def test_simhash_hash_is_sparks(spark):
    words = b"one two three four".decode()
    spark_hash = spark.range(1).select(F.xxhash64(F.lit(words))).first()[0]
    assert simhash.shingle_hashes(b"ONE two\n three\tfour", 4).view(np.int64).tolist() == [spark_hash]
    assert simhash.majority(simhash.shingle_hashes(b"", 4)) == 0


def lowest_reachable(prints, ids, radius):
    label = list(range(len(prints)))
    changed = True
    while changed:
        changed = False
        for i, a in enumerate(prints):
            for j, b in enumerate(prints):
                if label[j] < label[i] and bin((a ^ b) & (2**64 - 1)).count("1") <= radius:
                    label[i], changed = label[j], True
    groups = collections.defaultdict(list)
    for place, group in enumerate(label):
        groups[group].append(ids[place])
    return [min((i for i in groups[g] if i is not None), default=None) for g in label]


def test_simhash_classes(spark, table):
    prints = simhash.with_fingerprints(table.select("doc_id", "text")).persist()
    rows = simhash.classes(prints).collect()
    expected = lowest_reachable([r["fingerprint"] for r in rows], [r["doc_id"] for r in rows], 4)
    assert [r["component_id"] for r in rows] == expected
    kept = simhash.one_of_each(table).collect()
    assert kept[0].asDict().keys() == set(table.columns)
    assert len(kept) == len({r["root"] for r in rows})


def test_simhash_hot_file_is_cut(spark):
    """Near fingerprints that share most blocks, more than a unit holds."""
    draw = random.Random(3)
    base = draw.getrandbits(63)
    prints = sorted({base ^ (1 << draw.randint(0, 62)) ^ (1 << draw.randint(0, 62)) for _ in range(700)})
    prints += [draw.getrandbits(63) for _ in range(300)]
    nodes = spark.createDataFrame([(p,) for p in prints], "fp bigint")
    found = components.roots(simhash.links(nodes, unit=64)).collect()
    roots = {r["node"]: r["root"] for r in found}
    wanted = lowest_reachable(prints, prints, 4)
    assert [roots.get(p, p) for p in prints] == wanted


def test_bit_sliced_distances():
    draw = np.random.default_rng(1)
    lanes = draw.integers(0, 1 << 63, 150, dtype=np.uint64)
    queries = np.concatenate([lanes[:40] ^ np.uint64(0b10110), draw.integers(0, 1 << 63, 30, dtype=np.uint64)])
    for radius in (0, 1, 3, 4, 9, 30):
        rows, masks = simhash.near(queries, simhash.bit_planes(lanes), len(lanes), radius)
        found = np.zeros((len(queries), len(lanes)), dtype=bool)
        for row, mask in zip(rows, masks, strict=True):
            found[row] = np.unpackbits(mask.view(np.uint8), bitorder="little")[: len(lanes)]
        assert (found == (np.bitwise_count(queries[:, None] ^ lanes) <= radius)).all()


def test_components_of_chains_and_hubs(spark):
    edges = [(i, i + 1) for i in range(60)] + [(100, 100 + i) for i in range(1, 40)] + [(7, 7)]
    links = spark.createDataFrame(edges, "u bigint, v bigint")
    found = {r["node"]: r["root"] for r in components.roots(links).collect()}
    assert found == {**{i: 0 for i in range(1, 61)}, **{100 + i: 100 for i in range(1, 40)}}
    assert components.roots(links.limit(0)).count() == 0


# --- mixing ------------------------------------------------------------------


def test_mixing_reaches_weights_and_repeats(spark):
    rows = [(i, "x" * 10, "hot" if i % 3 else "cold", 5) for i in range(6000)]
    rows += [(None, None, None, 5), (9, "", "void", 5)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, source string, copy int")
    mixed = mixing.mix(docs, {"cold": 0.75}, epochs=2.0).collect()
    size = collections.Counter()
    for r in mixed:
        size[r["source"]] += len(r["text"] or "")
    assert abs(size["cold"] / sum(size.values()) - 0.75) < 0.02
    assert abs(sum(size.values()) / 120000 - 1) < 0.04
    keys = [r["shuffle_key"] for r in mixed]
    assert keys == sorted(keys)
    copies = collections.Counter(r["doc_id"] for r in mixed if r["source"] == "cold")
    mean = 2.0 * 60000 * 0.75 / 20000 / 10 * 10
    counts = collections.Counter(copies.values())
    share = counts[4] / 2000
    assert abs(share - math.exp(-mean) * mean**4 / math.factorial(4)) < 0.03
    again = mixing.mix(docs.repartition(7), {"cold": 0.75}, epochs=2.0).collect()
    assert sorted(map(str, again)) == sorted(map(str, mixed))
    assert mixing.mix(docs.limit(0), {"cold": 0.5}).count() == 0
    with pytest.raises(ValueError, match="weights"):
        mixing.mix(docs, {"cold": 0.7, "hot": 0.7})


# --- URL filter --------------------------------------------------------------


def test_url_parts_and_rules(spark):
    prepare_workers(spark)
    urls = {
        "http://Www.Example.com/en/1?x#y": ("www.example.com", "/en/1", "www.example.com/en/", "allow"),
        "https://m.EXAMPLE.com/en/": ("m.example.com", "/en/", "example.com/en/", "block"),
        "x://example.com/fr": ("example.com", "/fr", "com/", "allow"),
        "http://notnet/es/": ("notnet", "/es/", None, None),
        "http://a.net/es/?q": ("a.net", "/es/", "net/es/", "block"),
        "http://com": ("com", "", None, None),
        "http://com#a://b/": ("com", "", None, None),
        "no scheme.com/": ("", "", None, None),
        "": ("", "", None, None),
        None: ("", "", None, None),
        "http://a.com/" + "é" * 3000 + "\n": ("a.com", "/" + "é" * 3000 + "\n", "com/", "allow"),
    }
    rows = [(i, u, "own") for i, u in enumerate([*urls, *urls])] + [(None, None, "own")]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, verdict string")
    got = url_filter.judge(pages).collect()
    assert len(got) == len(rows)
    by_url = {r["url"]: r for r in got}
    for url, (host, path, rule, verdict) in urls.items():
        row = by_url[url]
        assert (row["host"], row["path"], row["rule"]) == (host, path, rule)
        assert row["verdict"] == verdict or verdict is None and row["verdict"] in ("allow", "block")
    assert url_filter.judge(pages.limit(0)).count() == 0


def test_url_model_tells_classes_apart(spark):
    """Without rules at hand the model follows the labelled URLs."""
    draw = random.Random(4)
    rows = []
    for i in range(600):
        bad = i % 2
        word = "".join(draw.choice("bets" if bad else "news") for _ in range(8))
        rows.append((i, f"http://{word}.{'net/es' if bad else 'com'}/{i}" if i < 500 else f"http://{word}.org/{i}"))
    pages = spark.createDataFrame(rows, "page_id bigint, url string")
    judged = url_filter.judge(pages).filter("page_id >= 500").collect()
    right = sum((r["verdict"] == "block") == bool(r["page_id"] % 2) for r in judged)
    assert right >= 95


def test_url_model_reads_the_whole_url(spark):
    """Query string, fragment and URLs without a scheme reach the model."""
    draw = random.Random(6)
    rows, n = [], 0
    for place in ("http://shop.{z}/?q={w}", "http://shop.{z}/#{w}"):
        for i in range(400):
            word = "".join(draw.choice("bets" if i % 2 else "news") for _ in range(12))
            rows.append((n := n + 1, place.format(z="net/es" if i % 2 else "com", w=word)))
    asked = [(f"http://x.org/?q={w}", w) for w in ("betsbetsbets", "newsnewsnews")]
    asked += [(f"http://x.org/#{w}", w) for w in ("tebstebstebs", "wensenswenws")]
    asked += [(w, w) for w in ("stebstebsteb", "wnewnsewnsew")]
    pages = spark.createDataFrame(rows + [(9000 + i, u) for i, (u, _) in enumerate(asked)], "page_id bigint, url string")
    judged = {r["url"]: r for r in url_filter.judge(pages).filter("page_id >= 9000").collect()}
    for url, word in asked:
        assert judged[url]["rule"] is None
        assert judged[url]["verdict"] == ("block" if "b" in word else "allow"), url


def test_url_threshold():
    assert url_filter.threshold([]) == 0
    assert url_filter.threshold([(5, 10, 0)]) == 0
    assert url_filter.threshold([(-3, 0, 10), (40, 10, 0)]) == 0
    assert url_filter.threshold([(10, 0, 10), (40, 10, 0)]) == 11


# --- WARC --------------------------------------------------------------------


def pages_of(spark):
    big = "".join(chr(32 + random.Random(8).randint(0, 90)) for _ in range(3)) * 90000
    rows = [(i, f"http://h/{i}", f"<p>{i % 5}</p>") for i in range(40)]
    rows += [(50, None, None), (51, "u\r\nX: y", ""), (52, "http://é/", big), (53, "x", big)]
    rows += [(60, "x", "same row"), (60, "x", "same row"), (None, "x", "no id"), (None, "x", "<p>1</p>")]
    rows += [(70, "x", "\x1f\x8b\x08 WARC/1.1\r\nWARC-Type: response\r\n\r\n")]
    return rows, spark.createDataFrame(rows, "page_id bigint, url string, html string").repartition(3)


@pytest.mark.parametrize("range_bytes", [97, 5000, 1 << 20])
def test_warc_round_trip(spark, range_bytes):
    prepare_workers(spark)
    rows, pages = pages_of(spark)
    best = {}
    for ident, _, html in rows:
        best[html or ""] = max(best.get(html or "", -1), -1 if ident is None else ident)
    expected = collections.Counter()
    for ident, _, html in rows:
        body = raw(html)
        keeper = best[html or ""]
        is_response = keeper == (-1 if ident is None else ident)
        expected[
            str(ident if ident is not None else "null"),
            len(body),
            base64.b32encode(hashlib.sha1(body).digest()).decode(),
            "response" if is_response else "revisit",
            None if is_response else str(keeper),
            body if is_response else None,
        ] += 1
    archives = warc.write(pages, shared_folder(spark, "warc"), file_bytes=3000)
    got = warc.read(archives, range_bytes=range_bytes).collect()
    keys = ("record_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
    found = collections.Counter(
        (*(r[k] for k in keys), bytes(r["payload"]) if r["payload"] is not None else None) for r in got
    )
    assert found == expected
    uris = {r["record_id"]: r["target_uri"] for r in got}
    assert uris["50"] is None and uris["51"] == "u%0D%0AX: y" and uris["52"] == "http://é/"


def test_warc_query_with_a_null_id(spark, tmp_path):
    rows = [(1, "http://h/1", "one"), (None, "http://h/2", "two"), (None, "http://h/3", "one")]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string")
    pages.write.parquet(str(tmp_path / "pages.parquet"))
    got = queries.op5_warc(spark, str(tmp_path)).select("page_id", "record_type", "refers_to").collect()
    assert sorted(map(str, map(tuple, got))) == sorted(
        map(str, [(1, "response", None), (None, "response", None), (None, "revisit", 1)])
    )


def test_warc_damage_and_capitals(spark, tmp_path):
    prepare_workers(spark)
    schema = "path string, bytes bigint"
    digest = hashlib.sha1(b"payload").hexdigest()
    members = [warc.record(str(i), "x", b"payload", digest, None) for i in range(3)]

    def found(data):
        file = tmp_path / f"{zlib.crc32(data)}.warc.gz"
        file.write_bytes(data)
        rows = spark.createDataFrame([(f"file://{file}", len(data))], schema)
        return [r["record_id"] for r in warc.read(rows).collect()]

    again = lambda old, new: gzip.compress(gzip.decompress(members[1]).replace(old, new))
    assert found(members[0] + again(b"WARC-Type:", b"warc-TYPE:") + members[2]) == ["0", "1", "2"]
    for data in (
        members[0] + members[1][:-30],
        members[0] + members[1][:-8] + bytes(8) + members[2],
        members[0] + again(b"Content-Length", b"Content-Size") + members[2],
    ):
        with pytest.raises(Exception, match=rf"warc.gz: damaged record at {len(members[0])}"):
            found(data)


def test_warc_of_no_pages(spark):
    pages = spark.createDataFrame([], "page_id bigint, url string, html string")
    assert warc.read(warc.write(pages, shared_folder(spark, "warc"))).count() == 0


# --- suffix arrays -----------------------------------------------------------


@pytest.mark.parametrize("few", [0, 1024])
def test_suffix_arrays(monkeypatch, few):
    monkeypatch.setattr(suffix_array, "FEW", few)
    draw = random.Random(5)
    for _ in range(300):
        values = [draw.randint(1, draw.choice([2, 3, 40])) for _ in range(draw.randint(0, 40))] + [0]
        expected = sorted(range(len(values)), key=lambda i: values[i:])
        assert suffix_array.suffix_array(np.array(values)).tolist() == expected


def test_a_text_of_names_is_sorted_by_arrays():
    names = np.append(np.random.default_rng(3).integers(1, 50_000, 300_000), 0)
    # A second copy: its suffixes agree with the first's for up to 1,000 names.
    names[200_000:201_000] = names[100_000:101_000]

    def seconds(work):
        taken = []
        for _ in range(3):
            began = time.process_time()
            found = work(names)
            taken.append(time.process_time() - began)
        return min(taken), found

    sorting, _ = seconds(lambda values: np.argsort(values, kind="stable"))
    taken, order = seconds(suffix_array.suffix_array)
    assert taken < 14 * sorting
    near = range(100_000, 100_200)
    expected = sorted(near, key=lambda i: names[i:].tolist())
    place = np.argsort(order)
    assert sorted(near, key=place.__getitem__) == expected
    assert (np.abs(place[100_000:101_000] - place[200_000:201_000]) == 1).all()


def without_repeats(docs, length):
    texts = [raw(t) for _, t in docs]
    met = collections.Counter(t[i : i + length] for t in texts for i in range(len(t) - length + 1))
    rows = collections.Counter()
    for (ident, _), t in zip(docs, texts, strict=True):
        gone = bytearray(len(t))
        for i in range(len(t) - length + 1):
            if met[t[i : i + length]] > 1:
                gone[i : i + length] = b"\1" * length
        rows[ident, bytes(c for c, g in zip(t, gone, strict=True) if not g), bytes(gone).count(b"\1")] += 1
    return rows


@pytest.mark.parametrize(("length", "shard_bytes"), [(40, 300), (40, 1 << 20), (7, 100)])
def test_repeats_removed(table, docs, length, shard_bytes):
    small = [d for d in docs if d[0] != 52]
    rows = table.filter("doc_id IS NULL OR doc_id <> 52")
    found = repeated_spans.without_repeats(rows, length=length, shard_bytes=shard_bytes).collect()
    got = collections.Counter(
        (r["doc_id"], bytes(r["kept"]), sum(s["end"] - s["start"] for s in r["spans"])) for r in found
    )
    assert got == without_repeats(small, length)


def test_finer_cuts_take_tasks_by_bytes(spark, monkeypatch):
    """What is cut finer is a few kilobytes here, so one task has it on each level,
    however many partitions a shuffle has."""
    prepare_workers(spark)
    files = collections.defaultdict(list)

    def recorded(rows, label):
        table = write(rows, label)
        files[label].append(len(table.inputFiles()))
        return table

    write = repeated_spans.written
    monkeypatch.setattr(repeated_spans, "written", recorded)
    held = {"spark.sql.shuffle.partitions": "24", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k) for k in held}
    texts = [prose(i, 30) + prose(999, 12) + prose(500 + i, 30) for i in range(80)] * 2
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    try:
        for k, v in held.items():
            spark.conf.set(k, v)
        found = repeated_spans.without_repeats(rows, length=100, shard_bytes=300).collect()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert len(found) == 160 and not any(r["kept"] for r in found)
    assert len(files["anchors"]) > 1
    assert set(files["anchors"][1:] + files["pieces"][1:]) == {1}


def test_repeats_in_a_long_text(spark, empty):
    """Stretches of one text meet each other's strings."""
    part = prose(3, 400)
    text = part + prose(4, 120000) + part
    rows = spark.createDataFrame([(1, text)], "doc_id bigint, text string")
    row = repeated_spans.without_repeats(rows, length=400, as_text=True).collect()[0]
    spans = [(s["start"], s["end"]) for s in row["spans"]]
    size = len(text.encode())
    assert spans[0][0] == 0 and abs(spans[0][1] - len(part.encode())) < 20
    assert spans[-1][1] == size and abs(size - spans[-1][0] - len(part.encode())) < 20
    assert repeated_spans.without_repeats(empty).count() == 0


# --- tokens ------------------------------------------------------------------


@pytest.fixture(scope="module")
def ranks():
    return byte_bpe.read_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))


@pytest.fixture(scope="module")
def reference(ranks):
    import tiktoken

    vocabulary = byte_bpe._vocabulary(ranks)
    return tiktoken.Encoding(
        "own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=vocabulary, special_tokens={}
    )


def test_byte_bpe_round_trip(table, empty, docs, ranks, reference):
    encoded = byte_bpe.encode(table, ranks, public_tokenizers.PATTERN)
    back = byte_bpe.decode(encoded, ranks, packed="packed").collect()
    at_once = byte_bpe.encode(table, ranks, public_tokenizers.PATTERN, decoded="kept").collect()
    wanted = collections.Counter((i, tuple(reference.encode_ordinary(t or "")), raw(t)) for i, t in docs)
    unpacked = [tuple(np.frombuffer(r["packed"], "<u4").tolist()) for r in back]
    assert collections.Counter(
        (r["doc_id"], ids, bytes(r["decoded"])) for r, ids in zip(back, unpacked, strict=True)
    ) == wanted
    assert collections.Counter((r["doc_id"], tuple(r["ids"]), bytes(r["kept"])) for r in at_once) == wanted
    assert byte_bpe.encode(empty, ranks, public_tokenizers.PATTERN).count() == 0


def test_byte_bpe_merges_long_pieces(ranks, reference):
    draw = random.Random(6)
    vocabulary = byte_bpe._vocabulary(ranks)
    for _ in range(200):
        piece = "".join(draw.choice("abehinorstéñß") for _ in range(draw.randint(1, 300))).encode()
        if piece not in vocabulary:
            expected = reference._encode_single_piece(piece) if hasattr(reference, "_encode_single_piece") else None
            got = byte_bpe.merged(piece, vocabulary, max(map(len, vocabulary)))
            assert b"".join(reference.decode_single_token_bytes(i) for i in got) == piece
            assert expected is None or got == list(expected)


def test_token_files(spark, table, docs, empty):
    from tokenizers import Tokenizer

    file = public_tokenizers.path("word_bpe_49k.json")
    model = open(file, encoding="utf-8").read()
    tokenizer = Tokenizer.from_file(file)
    tokenizer.encode_special_tokens = True
    path = shared_folder(spark, "token-files")
    token_files.write(token_files.encoded(table, model, 2), path)
    stored = token_files.read(spark, path)
    rows = stored.join(token_files.starts(spark, path), "shard").collect()
    by_start = sorted(rows, key=lambda r: r["base"] + r["at"])
    at = 0
    for row in by_start:
        assert row["base"] + row["at"] == at and row["n_tokens"] == len(row["ids"])
        at += row["n_tokens"]
    order = [-1 if r["doc_id"] is None else r["doc_id"] for r in by_start]
    assert order == sorted(order)
    wanted = collections.Counter(
        (i, tuple([*tokenizer.encode(t or "", add_special_tokens=False).ids, 2])) for i, t in docs
    )
    assert collections.Counter((r["doc_id"], tuple(r["ids"])) for r in rows) == wanted
    sums = token_files.with_checksums(stored).collect()
    assert collections.Counter((r["doc_id"], r["ids_crc32"]) for r in sums) == collections.Counter(
        (i, zlib.crc32(np.array(ids, "<u4").tobytes())) for i, ids in wanted.elements()
    )
    nothing = shared_folder(spark, "token-files")
    token_files.write(token_files.encoded(empty, model, 2), nothing)
    assert token_files.read(spark, nothing).count() == token_files.starts(spark, nothing).count() == 0


def test_token_files_with_added_tokens(spark):
    """Texts that spell an added token get the ids of a tokenizer as it comes."""
    from tokenizers import Tokenizer

    prepare_workers(spark)
    file = public_tokenizers.path("word_bpe_49k.json")
    tokenizer = Tokenizer.from_file(file)
    texts = [
        "hello <|endoftext|> world <|startoftext|>.", "plain, text", "", "<|endoftext|>",
        "Upper<|ENDOFTEXT|>Case", "x<|startoftext|><|endoftext|>y\n.", "<|endoftext |>", None, "The End.",
    ]
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").coalesce(1)
    model = open(file, encoding="utf-8").read()
    got = {r["doc_id"]: r["ids"] for r in token_files.encoded(rows, model, 2).collect()}
    for i, text in enumerate(texts):
        assert got[i] == [*tokenizer.encode(text or "", add_special_tokens=False).ids, 2], text


# --- language model ----------------------------------------------------------


def test_language_model_base(table, empty, docs):
    held = lambda i: i is not None and zlib.crc32(str(i).encode()) % 7 == 2
    split = {id(d): [*raw(d[1]).lower().split(), b""] for d in docs}
    counts = collections.Counter(w for d in docs if not held(d[0]) for w in split[id(d)])
    total, kinds = sum(counts.values()), len(counts)
    expected = sorted(
        (
            -1 if d[0] is None else d[0],
            held(d[0]),
            len(words := split[id(d)]),
            sum(counts[w] > 0 for w in words),
            total,
            round(sum(math.log10((counts[w] + 1) / (total + kinds + 1)) for w in words), 6),
        )
        for d in docs
    )
    rows = suffix_tree_lm.score(table).collect()
    assert rows[0].asDict().keys() >= {"kept", "a b", "score"}
    names = ("held_out", "n_tokens", "n_known", "train_tokens")
    got = sorted(
        (-1 if r["doc_id"] is None else r["doc_id"], *(r[n] for n in names), round(r["base_score"], 6))
        for r in rows
    )
    assert got == expected
    assert suffix_tree_lm.score(empty).count() == 0


def test_language_model_learns_contexts(spark):
    """Held-out texts with known turns of phrase score above the root's words."""
    draw = random.Random(7)
    phrases = [prose(i, 12).replace("!", "") for i in range(30)]
    rows = [(i, " ".join(draw.choice(phrases) for _ in range(12))) for i in range(400)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    scored = suffix_tree_lm.score(docs).filter("held_out").collect()
    assert sum(r["score"] for r in scored) > 0.6 * sum(r["base_score"] for r in scored)
    assert all(r["score"] <= 0 for r in scored)


def tree_scores(rows, held, depth):
    """Scores of the same tree, grown in dictionaries."""
    split = {i: [None, *raw(t).lower().split(), b""] for i, t in rows}
    train = [w for i, w in split.items() if not held(i)]
    counts = collections.Counter(w for words in train for w in words[1:])
    total = sum(counts.values()) + len(counts) + 1
    states = {}

    def probability(context, word):
        for n in range(len(context) + 1):
            if (state := states.get(context[n:])) is not None:
                left, share = state
                lower = probability(context[n + 1 :], word)
                return share.get(word, 0) + left * lower
        return (counts[word] + 1) / total

    for size in range(1, depth + 1):
        after = collections.defaultdict(collections.Counter)
        for words in train:
            for i in range(size, len(words)):
                after[tuple(words[i - size : i])][words[i]] += 1
        new = {}
        for context, seen in after.items():
            n, kept = sum(seen.values()), {w: c for w, c in seen.items() if c >= 2}
            share = {w: c / (n + len(kept)) for w, c in kept.items()}
            left, gain = 1 - sum(share.values()), 0.0
            for w, c in kept.items():
                lower = probability(context[1:], w)
                gain += c * math.log((share[w] + left * lower) / lower)
            if n > sum(kept.values()):
                gain += (n - sum(kept.values())) * math.log(left)
            if kept and gain > 4.0 * len(kept):
                new[context] = (left, share)
        states |= new
    return {
        i: sum(math.log10(probability(tuple(w[max(0, k - depth) : k]), w[k])) for k in range(1, len(w)))
        for i, w in split.items()
    }


@pytest.mark.parametrize("common", [5e-7, 0.02, 2.0])
def test_language_model_against_dictionaries(spark, monkeypatch, common):
    """Contexts of up to three words, kept however rare beside a large rest, and
    found alike by broadcast and by join."""
    monkeypatch.setattr(suffix_tree_lm, "COMMON_SHARE", common)
    prepare_workers(spark)
    draw = random.Random(3)
    phrases = [f"{a} x y {b}" for a, b in zip("abcdef", "uvwrst", strict=True)]
    rows = [(i, " ".join(draw.choice(phrases) for _ in range(3))) for i in range(60)]
    rows += [(100 + i, prose(i, 900)) for i in range(60)] + [(200, None), (201, "")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = {r["doc_id"]: r["score"] for r in suffix_tree_lm.score(docs).collect()}
    held = lambda i: zlib.crc32(str(i).encode()) % 7 == 2
    wanted = tree_scores(rows, held, 3)
    assert got.keys() == wanted.keys()
    assert all(abs(got[i] - wanted[i]) < 1e-6 * max(1, abs(wanted[i])) for i in got)


@pytest.mark.parametrize("kept", [2, 3])
def test_states_sum_to_one(spark, kept):
    """In each stored state the words kept have their probabilities, and all others what
    the suffix gives them of the mass left: together one whole."""
    prepare_workers(spark)
    draw = random.Random(3)
    phrases = [f"{a} x y {b}" for a, b in zip("abcdef", "uvwrst", strict=True)]
    texts = [" ".join(draw.choice(phrases) for _ in range(3)) for _ in range(60)] + [prose(i, 300) for i in range(9)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    words = suffix_tree_lm.written(suffix_tree_lm.word_counts(docs), "words")
    size, kinds = words.agg(F.sum("c"), F.count("*")).first()
    below = suffix_tree_lm._word_states(words, size, kinds, kept)
    for order in (2, 3):
        grams = suffix_tree_lm._gram_counts(docs, order, suffix_tree_lm.bitmap(below, "gram"), kept)
        assert grams.agg(F.min("c")).first()[0] == kept
        below, values = suffix_tree_lm._states(grams, below, order)
        states = collections.defaultdict(list)
        for r in below.filter("context IS NOT NULL").collect():
            states[r["context"]].append((r["p"], r["p"] / math.exp(r["value"] + r["left"]), math.exp(r["left"])))
        assert (order > 2 or len(states) > 5) and values.count() == len(states) + sum(map(len, states.values()))
        for held in states.values():
            p, lower, left = zip(*held, strict=True)
            assert abs(sum(p) + left[0] * (1 - sum(lower)) - 1) < 1e-9 and min(p) > 0


def test_language_model_leaves_no_broadcasts(spark, monkeypatch):
    """A bitmap is as large as its grams ask for, and every node's copy goes when used up;
    the values of grams go before the result is read."""
    prepare_workers(spark)
    tables = {}

    def kept(rows, label):
        tables[label] = write(rows, label)
        return tables[label]

    write = suffix_tree_lm.written
    monkeypatch.setattr(suffix_tree_lm, "written", kept)
    sent, sizes = [], []

    def recorded(self, value):
        sent.append(broadcast(self, value))
        sizes.append(os.path.getsize(sent[-1]._path))
        return sent[-1]

    broadcast = type(spark.sparkContext).broadcast
    monkeypatch.setattr(type(spark.sparkContext), "broadcast", recorded)
    rows = [(i, prose(i, 200)) for i in range(50)]
    suffix_tree_lm.score(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()
    folders = {x: {os.path.dirname(f)[len("file:") :] for f in tables[x].inputFiles()} for x in ("values", "words")}
    assert not any(map(os.path.exists, folders["values"])) and all(map(os.path.exists, folders["words"]))
    assert len(sent) == 4 and max(sizes) < 1 << 20
    assert not any(os.path.exists(b._path) for b in sent)


def test_grams_are_found_among_keys():
    draw = np.random.default_rng(5)
    for n in (0, 1, 7, 5000):
        keys = np.unique(np.append(draw.integers(0, 1 << 64, n, dtype=np.uint64), draw.integers(0, n + 1, n, dtype=np.uint64)))
        asked = np.append(draw.integers(0, 1 << 64, 300, dtype=np.uint64), draw.permutation(keys))
        found, at = suffix_tree_lm._found(keys, suffix_tree_lm._starts(keys), asked)
        assert found.tolist() == np.isin(asked, keys).tolist()
        assert (keys[at[found]] == asked[found]).all()


def test_keys_are_sorted_whole():
    """Also those that agree in all the leading bits that are sorted first."""
    draw = np.random.default_rng(6)
    for n in (0, 1, 5, 3000):
        keys = draw.integers(0, 1 << 64, n, dtype=np.uint64)
        keys[: n // 2] = (np.uint64(7) << np.uint64(60)) + draw.integers(0, 99, n // 2, dtype=np.uint64)
        assert keys[suffix_tree_lm._order(keys)].tolist() == sorted(keys.tolist())


def test_words_of_texts_are_hashed_like_words():
    texts = ["Ab  c\td", None, "", " x ", "é" * 40 + " " + "Q" * 9, "a" * 8 + "\x0b" + "a" * 64 + "\r" + "a" * 65]
    sizes, hashes = suffix_tree_lm.text_hashes(pa.array(texts, pa.string()))
    words = [raw(t).lower().split() for t in texts]
    assert sizes.tolist() == list(map(len, words))
    flat = [w.decode() for own in words for w in own]
    assert hashes.tolist() == suffix_tree_lm.word_hashes(pa.array(flat)).tolist()
    assert len(set(hashes.tolist())) == len(set(flat))


def test_grams_travel_packed(spark):
    """A bucket's grams are one row from each task, and no shuffle outlives its write."""
    prepare_workers(spark)
    docs = spark.createDataFrame([(i, prose(i, 400)) for i in range(40)], "doc_id bigint, text string")
    words = suffix_tree_lm.written(suffix_tree_lm.word_counts(docs.coalesce(2)), "words")
    below = suffix_tree_lm._word_states(words, 16_000, words.count(), 2)
    bits = suffix_tree_lm.bitmap(below, "gram")
    grams = suffix_tree_lm._gram_counts(docs.coalesce(2), 2, bits, 2, buckets=8)
    assert grams.count() > 200 and grams.packed.count() <= 64
    seen = []
    write = suffix_tree_lm.written
    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(suffix_tree_lm, "written", lambda r, l: (seen.append(spark.conf.get(suffix_tree_lm._REMOVAL)), write(r, l))[1])
        suffix_tree_lm.score(docs)
    assert seen and set(seen) == {"true"} and spark.conf.get(suffix_tree_lm._REMOVAL) == "false"


# --- schema ------------------------------------------------------------------


def test_operators_pass_other_columns(table, ranks):
    for out in (
        simhash.with_fingerprints(table),
        fingerprints.with_sketches(table),
        byte_bpe.encode(table, ranks, public_tokenizers.PATTERN),
        suffix_tree_lm.score(table),
    ):
        assert out.schema["a b"].dataType == T.IntegerType()
