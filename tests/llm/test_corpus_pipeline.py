"""The pipeline against a brute-force version of its stages, one after the other."""

import hashlib
import math
import random
import re
from collections import Counter, defaultdict

import public_tokenizers
import pytest
import xxhash

import corpus_pipeline
from daybook.llm import byte_bpe, mixing, quality_rules, queries
from daybook.session import prepare_workers

COLUMNS = "doc_id bigint, text string, lang string, source string, n_chars bigint"
WORDS = "the of and to der die la que thanedble erntand enachberau ñosll ció été".split()


def prose(seed, words):
    draw = random.Random(seed)
    return " ".join(draw.choice(WORDS) + (str(draw.randint(0, 999)) if i % 4 else "") for i in range(words))


def corpus():
    shared = prose(1, 120)
    texts = [prose(100 + i, 60 + 7 * i) for i in range(24)]
    texts += [f"{prose(200 + i, 40)} {shared} {prose(300 + i, 40)}" for i in range(6)]
    texts += [texts[3]] * 5 + [texts[4] + " end", texts[5].replace("die", "der", 1)]
    texts += [None, "", "short", "Heer " * 60, "*** $$$ " + prose(7, 30).replace(" ", "### "), "é" * 900]
    rows = [(i, t, "en", f"src{i % 5}" if i % 7 else None, len(t or "")) for i, t in enumerate(texts)]
    return [*rows, rows[10], (None, texts[11], None, "src9", None)]


def quality(rows):
    stops = {*quality_rules.STOP_WORDS, *(w.capitalize() for w in quality_rules.STOP_WORDS)}
    for row in rows:
        text = row[1] or ""
        words = [w.decode() for w in text.encode().split()]
        windows = Counter(tuple(words[i : i + 5]) for i in range(len(words) - 4))
        repeated = {
            i + k for i in range(len(words) - 4) if windows[tuple(words[i : i + 5])] > 1 for k in range(5)
        }
        lines = [x for x in text.split("\n") if x.encode().split()]
        counts = {
            "n_words": len(words),
            "word_chars": sum(map(len, words)),
            "n_symbols": len(re.findall(r"[#*$%&|<>]", text)),
            "n_dup_lines": len(lines) - len(set(lines)),
            "n_lines": len(lines),
            "n_bullet_lines": sum(bool(re.match(r"[ \t-\r]*[-*•]", x)) for x in lines),
            "n_ellipsis_lines": sum(bool(re.search(r"(\.\.\.|…)[ \t-\r]*\Z", x)) for x in lines),
            "n_stop_words": sum(w in stops for w in words),
            "n_stuttered": sum(a == b for a, b in zip(words, words[1:], strict=False)),
        }
        if len(words) < 10 or 100 * len(repeated) > 20 * len(words):
            continue
        if not any(
            counts["n_words"] >= r.min_words
            and (
                r.low is not None and 100 * counts[r.part] < r.low * counts[r.whole]
                or r.high is not None and 100 * counts[r.part] > r.high * counts[r.whole]
            )
            for r in quality_rules.RULES
        ):
            yield row


def near_duplicates(rows):
    def bits(text):
        words = (text or "").encode().lower().split()
        shingles = [b" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))] if words else []
        hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
        return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))

    rows = list(rows)
    prints, group = [bits(r[1]) for r in rows], list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= 4 and group[i] != group[j]:
                group = [group[j] if g == group[i] else g for g in group]
    classes = defaultdict(list)
    for place, g in enumerate(group):
        classes[g].append(rows[place])
    for found in classes.values():
        yield min(found, key=lambda r: (r[0] is None, r[0]))


def long_repeats(rows, length=corpus_pipeline.REPEAT_BYTES):
    rows = list(rows)
    raw = [(r[1] or "").encode() for r in rows]
    met = Counter(t[i : i + length] for t in raw for i in range(len(t) - length + 1))
    for row, t in zip(rows, raw, strict=True):
        gone = bytearray(len(t))
        for i in range(len(t) - length + 1):
            if met[t[i : i + length]] > 1:
                gone[i : i + length] = b"\1" * length
        text = bytes(c for c, g in zip(t, gone, strict=True) if not g).decode(errors="ignore")
        yield (row[0], text, *row[2:4], len(text))


def mixture(rows):
    rows = list(rows)
    size = Counter()
    for r in rows:
        size[r[3]] += len(r[1])
    weights = queries.TARGET_WEIGHTS
    total = sum(size.values())
    others = sum(n for s, n in size.items() if s not in weights)
    present = sum(w for s, w in weights.items() if size[s])
    for row in rows:
        weight = weights.get(row[3], (1 - present) * size[row[3]] / others)
        rate = queries.EPOCHS * total * weight / size[row[3]]
        key = f"{mixing.SEED}:{'' if row[0] is None else row[0]}:{hashlib.md5(row[1].encode()).hexdigest()}"
        uniform = int(hashlib.md5(key.encode()).hexdigest()[:13], 16) / 16**13
        count, p = 0, math.exp(-rate)
        upto = p
        while upto <= uniform:
            count += 1
            p *= rate / count
            upto += p
        yield from [row] * count


def test_pipeline_against_brute_force(spark, tmp_path):
    import tiktoken

    rows = corpus()
    folder = str(tmp_path)
    spark.createDataFrame(rows, COLUMNS).repartition(3).write.parquet(f"{folder}/documents.parquet")
    found = corpus_pipeline.run(spark, folder).collect()
    vocabulary = byte_bpe._vocabulary(
        byte_bpe.read_ranks(public_tokenizers.path(queries.RANK_FILE))
    )
    tokenizer = tiktoken.Encoding(
        "own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=vocabulary, special_tokens={}
    )
    expected = Counter()
    for ident, text, lang, source, chars in mixture(long_repeats(near_duplicates(quality(rows)))):
        ids = tuple(tokenizer.encode_ordinary(text))
        expected[ident, text, lang, source, chars, ids, len(ids)] += 1
    got = Counter(
        (r["doc_id"], r["text"], r["lang"], r["source"], r["n_chars"], tuple(r["ids"]), r["n_tokens"])
        for r in found
    )
    assert got == expected
    assert 10 < len(got) < len(rows)


def test_stages(spark):
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "quality_rules", "simhash_near_dedup", "suffix_array_dedup", "poisson_mixing", "byte_bpe",
    ]
    empty = spark.createDataFrame([], COLUMNS)
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, empty, "")
        assert out.count() == 0
        if name != "byte_bpe":
            assert out.columns == empty.columns


@pytest.mark.parametrize("column", ["kept", "ids", "row", "held", "data", "copy", "n_words", "ident"])
def test_stages_pass_clashing_columns(spark, column):
    rows = spark.createDataFrame([(*r, "mine") for r in corpus()[:6]], f"{COLUMNS}, {column} string")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, rows, "")
        assert out.columns == rows.columns, name
        assert {r[column] for r in out.collect()} <= {"mine"}, name


def test_planted_passages_go_and_clean_texts_stay(spark):
    """Passages of 51 words and more that documents share, in documents that are no near
    copies of each other; of the others nothing goes."""
    prepare_workers(spark)
    passages = [prose(7000 + i, 51 + 4 * i) for i in range(6)]
    rows, planted = [], {}
    for n in range(30):
        text = f"{prose(8000 + n, 150)} {passages[n % 6]} {prose(9000 + n, 150)}"
        planted[n] = passages[n % 6]
        rows.append((n, text, "en", "src0", len(text)))
    clean = [(100 + n, prose(5000 + n, 300), "en", "src1", None) for n in range(30)]
    docs = spark.createDataFrame(rows + clean, COLUMNS)
    kept = {r["doc_id"]: r["text"] for r in corpus_pipeline.long_repeats(spark, docs, "").collect()}
    caught = sum(len(p) > 255 and p not in kept[n] for n, p in planted.items())
    assert caught == sum(len(p) > 255 for p in planted.values()) >= 25
    assert all(kept[n] == text for n, text, *_ in clean)
