"""Results that must not change with the size of the table."""

import hashlib
import math
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tessera.operators import ordered, sketches
from tessera.operators import ranking as K


@pytest.mark.parametrize("spare", [3.0, 0.0])
def test_quantiles_beyond_the_size_of_a_sketch_are_exact(spark, tmp_path, spare):
    """Without room around the sketch's value the bounds miss, and the group is counted in full."""
    made = random.Random(4)
    values = {"a": [made.randrange(100_000) for _ in range(9_000)], "b": [made.randrange(50) for _ in range(2_001)], "c": [7]}
    rows = spark.createDataFrame([(g, float(v), i % 3) for g, vs in values.items() for i, v in enumerate(vs)] + [("b", None, 0), ("d", None, 0)], "g string, v double, part int")
    sketches.write(rows, ["g"], "v", "part", str(tmp_path / "s"), size=64)
    points = {"p05": 0.05, "p50": 0.5, "p95": 0.95, "p99": 0.99, "all": 1.0}
    got = {r.g: r for r in sketches.exact_quantiles(rows, spark.read.parquet(str(tmp_path / "s")), ["g"], "v", points, 64, spare).collect()}
    assert got.keys() == values.keys()
    for g, vs in values.items():
        assert got[g].n == len(vs)
        assert {n: got[g][n] for n in points} == {n: sorted(vs)[max(0, math.ceil(round(p * len(vs), 6)) - 1)] for n, p in points.items()}


def test_a_tree_of_fixed_height_grows_its_leaves(spark):
    keys = [i // 2 for i in range(300)]
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    entries = sorted(f"{h}:{n}" for h, n in Counter(sha(f"{len(str(k))}:{k}") for k in keys).items())
    nodes = {}
    for e in entries:
        nodes.setdefault(e[0], []).append(e)
    want = sha("\n".join(sorted(f"{x}:" + sha("\n".join(es)) for x, es in nodes.items())))
    rows = spark.createDataFrame([(k,) for k in keys], "k int")
    assert ordered.tree_digest(rows, "k", [], 2, deepest=1).first()["digest"] == want != ordered.tree_digest(rows, "k", [], 2).first()["digest"]


def test_overlaps_pass_as_a_stream(spark):
    made = random.Random(5)
    spans = [(q, made.randrange(3), a, a + made.randrange(1, 20), i) for q in range(40) for i, a in enumerate(made.randrange(40) for _ in range(30))]
    df = spark.createDataFrame(spans, "q int, d int, a int, b int, o int")
    got = K.suppress_overlaps(df, "q", "d", "a", "b", "o", 2, 5, 0.3)
    want = []
    for q in range(40):
        kept = []
        for s in sorted((x for x in spans if x[0] == q), key=lambda x: (x[4], x[1], x[2])):
            mates = [x for x in kept if x[1] == s[1]]
            if len(kept) < 5 and len(mates) < 2 and not any(max(0, min(s[3], y) - max(s[2], x)) >= 0.3 * (max(s[3], y) - min(s[2], x)) for _, _, x, y in mates):
                kept.append(s[:4])
        want += [(*s, i + 1) for i, s in enumerate(kept)]
    assert sorted(map(tuple, got.collect())) == sorted(want)
    assert "FlatMapGroups" not in got._jdf.queryExecution().executedPlan().toString()


def test_a_sweep_multiplies_lists_and_not_places(spark):
    ranking = spark.range(20).select((F.col("id") % 4).alias("q"), F.col("id").alias("v"), (F.col("id") / 4).cast("int").alias("rank"), F.lit(0.5).alias("score"))
    got = K.cutoff_sweep(ranking, ranking.select("q", "v"), "q", "v", [{"minimum": 1, "maximum": 3}, {"minimum": 2, "maximum": 9, "floor": 0.9}])
    assert [(r.setting, r["size"]) for r in got.collect()] == [(0, 12), (1, 8)]
    assert "Window" not in got._jdf.queryExecution().analyzed().toString().replace("WindowFunction", "")
