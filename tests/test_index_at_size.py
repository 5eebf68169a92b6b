"""The index search judges every vector of a probed cell and shuffles no row for a query and a vector."""

import numpy as np

from tessera.operators import retrieval, vector_index


def test_vectors_of_one_code_are_told_apart(spark):
    rows = [(j, [1.0, j * 1e-5]) for j in range(150)] + [(900, [-1.0, 1.0])]
    e = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(3)
    index = vector_index.build(e, cells=1)
    assert index.table.where("vec_id < 200").select("code").distinct().count() == 1
    q = spark.createDataFrame([(1, [1.0, 1.0]), (2, [1.0, -1.0])], "query_id long, embedding array<double>")
    assert sorted((r.query_id, r.vec_id) for r in vector_index.search(index, q, e, 2, 1).collect()) == [(1, 148), (1, 149), (2, 0), (2, 1)]


def test_all_cells_give_the_exact_result_in_turns_and_tiles(spark, monkeypatch):
    rng = np.random.default_rng(2)
    m = rng.standard_normal((400, 8))
    m[200:240] = m[200]  # copies: ties go to the smaller key
    e = spark.createDataFrame(list(enumerate(m.tolist())), "vec_id long, embedding array<double>").repartition(4)
    q = e.where("vec_id % 20 = 0").withColumnRenamed("vec_id", "query_id")
    index = vector_index.build(e)
    whole = lambda df: sorted((r.query_id, r["rank"], r.vec_id, round(r.score, 6)) for r in df.collect())
    want = whole(retrieval.exact_topk(q, e, 5))
    assert whole(vector_index.search(index, q, e, 5, len(index.centres))) == want
    monkeypatch.setattr(vector_index, "MOST", 12)
    monkeypatch.setattr(vector_index, "PAIRS", 9)
    monkeypatch.setattr(retrieval, "WAITING", 3)
    assert whole(vector_index.search(index, q, e, 5, len(index.centres))) == want


def test_only_the_best_of_a_task_are_shuffled(spark):
    e = spark.createDataFrame([(i, [float(i % 7), float(i % 5)]) for i in range(60)], "vec_id long, embedding array<double>")
    found = vector_index.search(vector_index.build(e), e.where("vec_id < 9").withColumnRenamed("vec_id", "query_id"), e, 3, 2)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "Join" not in plan and "CoGroup" not in plan
