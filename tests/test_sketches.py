"""What sketches say of sets of keys, and how sure they are of it."""

import pytest
from pyspark.sql import functions as F

from daybook.functions import sketches
from daybook.plans import rollups


def test_head_of_a_sketch(spark):
    """Counts and shares as the estimate has them, from the empty sketch on."""
    sizes = [0, 1, 2, 255, 256, 4096, 4097, 70000]
    groups = spark.createDataFrame([(n,) for n in sizes], "n bigint")
    keys = groups.join(spark.range(70000), F.expr("id < n"), "left")
    made = keys.groupBy("n").agg(sketches.key_sketch(F.col("id")).alias("s"))
    rows = made.select(
        "n",
        sketches.distinct_estimate(F.col("s")).alias("estimate"),
        sketches.retained_keys(F.col("s")).alias("k"),
        sketches.retained_share(F.col("s")).alias("p"),
        sketches.key_bounds(F.col("s")).alias("b"),
    ).collect()
    assert len(rows) == len(sizes)
    for r in rows:
        assert abs(r["k"] / r["p"] - r["estimate"]) <= 1
        if r["n"] <= 4096:
            assert (r["k"], r["p"], r["b"]["lower"], r["b"]["upper"]) == (r["n"], 1.0, r["n"], r["n"])
        else:
            assert r["p"] < 1 and r["b"]["lower"] < r["n"] < r["b"]["upper"]


def test_plain_sketch_layout(spark):
    """The third version of the format, whose counts are not packed."""
    head = bytes([3, 3, 3, 0, 0, 0x1A, 0xCC, 0x93]) + (300).to_bytes(4, "little") + b"\0\0\x80\x3f"
    whole = head + (1 << 61).to_bytes(8, "little")
    rows = spark.createDataFrame([(whole,), (bytes([2]) + head[1:],)], "s binary")
    found = rows.select(sketches.retained_keys(F.col("s")), sketches.retained_share(F.col("s"))).collect()
    assert [tuple(r) for r in found] == [(300, 0.25), (300, 1.0)]


def test_bounds_hold_for_most_sets(spark):
    keys = spark.range(100 * 9000).select((F.col("id") % 100).alias("g"), F.xxhash64("id").alias("key"))
    made = keys.groupBy("g").agg(sketches.key_sketch(F.col("key")).alias("s"))
    bounds = made.select(sketches.key_bounds(F.col("s")).alias("b"), sketches.key_bounds(F.col("s"), 1.0).alias("near"))
    rows = bounds.collect()
    assert sum(r["b"]["lower"] <= 9000 <= r["b"]["upper"] for r in rows) >= 95
    assert all(r["b"]["upper"] - r["b"]["lower"] < 1500 for r in rows)
    assert 45 <= sum(r["near"]["lower"] <= 9000 <= r["near"]["upper"] for r in rows) <= 90


def test_expressions_against_sets(spark):
    members = {"a": set(range(0, 900)), "b": set(range(300, 1500, 2)), "c": {7, 400, 402}, "none": set()}
    rows = [(name, k) for name, keys in members.items() for k in keys]
    cube = (
        spark.createDataFrame(rows, "name string, key int")
        .groupBy("name", F.col("key") % 5)
        .agg(sketches.key_sketch(F.col("key")).alias(rollups.SKETCH))
    )
    a, b, c, none = (sketches.KeySet(n) for n in members)
    asked = {
        "x": (a & b) - c, "y": (a | c) & (b | c), "z": a - (b - c), "nothing": a & none, "all_a": a | none,
        "left": none - a, "rest": a - none,
    }
    sets = {n: F.col("name") == n for n in members}
    found = rollups.incident_sets(cube, sets, asked).first()
    A, B, C = members["a"], members["b"], members["c"]
    wanted = {
        "x": (A & B) - C, "y": (A | C) & (B | C), "z": A - (B - C), "nothing": set(), "all_a": A,
        "left": set(), "rest": A,
    }
    for name, keys in wanted.items():
        assert found[name] == found[f"{name}_lower"] == found[f"{name}_upper"] == len(keys), name
    with pytest.raises(ValueError, match="sets not named: \\['d'\\]"):
        rollups.incident_sets(cube, sets, {"x": a & sketches.KeySet("d")})
