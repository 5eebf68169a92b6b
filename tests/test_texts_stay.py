"""What a search found meets the texts where they are, whatever the session's threshold for broadcasts."""

import pytest
from pyspark.sql import DataFrame

from tessera import session
from tessera.operators import replay
from tessera.plans import retrieval as plans


@pytest.fixture
def no_broadcasts(spark):
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_windows_are_not_shuffled_to_meet_their_hits(spark, sf_dir, no_broadcasts, monkeypatch):
    written: list[DataFrame] = []

    def held(df, name):
        written.append(df)
        return session.materialise(df, name)

    monkeypatch.setattr(plans, "materialise", held)
    got = sorted(plans._candidates(spark, sf_dir).select("item_id", "child", "rank", "tokens").collect())
    assert "Exchange hashpartitioning" not in plan(written[-1]) and "BroadcastHashJoin" in plan(written[-1])
    monkeypatch.setattr(session, "FEW", 0)  # more hits than are sent: Spark's own join, the same rows
    assert sorted(plans._candidates(spark, sf_dir).select("item_id", "child", "rank", "tokens").collect()) == got and got
    assert "Exchange hashpartitioning" in plan(written[-1])


def test_documents_are_not_shuffled_to_meet_their_hits(spark, no_broadcasts, monkeypatch):
    docs = spark.createDataFrame([(i, f"one two three {i}. " * 90) for i in range(20)], "doc long, text string")
    hits = spark.createDataFrame([(1, 3, 0, 1), (1, 4, 1, 2), (2, 3, 1, 1)], "q int, doc long, chunk_order int, rank int")

    def tokenised():
        """The rows, and the part of the plan below the tokenisation."""
        found = replay.parents(hits, docs, "doc", "text", variants=((512, None),))
        assert "ArrowEvalPython" in plan(found)
        return sorted(found.collect()), plan(found).split("== Initial Plan ==")[0].split("ArrowEvalPython")[1]

    got, below = tokenised()
    assert "BroadcastHashJoin" in below and "SortMergeJoin" not in below and len(got) == 3
    monkeypatch.setattr(session, "FEW", 0)
    again, below = tokenised()
    assert again == got and "SortMergeJoin" in below
