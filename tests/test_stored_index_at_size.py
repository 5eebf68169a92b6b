"""Building and searching the stored index shuffles neither texts nor a row for a query and a document."""

import pytest
from pyspark.sql import functions as F

from tessera.operators import lexical_index as L
from tessera.operators import retrieval as R
from tessera.session import new_folder

def words():
    return F.split("text", " ")


def rows(df):
    return sorted((r.q, r["rank"], r.id, round(r.score, 6)) for r in df.collect())


@pytest.fixture(scope="module")
def tables(spark):
    docs = [(f"k{i:04d}", " ".join(f"w{(i * j + j) % (7 + i % 13)}" for j in range(i % 40 + 1))) for i in range(900)]
    docs += [(f"z{i}", docs[5][1]) for i in range(30)]  # copies: ties go to the smaller key
    asked = [(f"q{i % 11}", f"w{i % 17} w{i % 5} w{i * 3 % 19} w{i % 2} none") for i in range(14)]  # three keys stand twice
    return spark.createDataFrame(docs, "id string, text string").repartition(5), spark.createDataFrame(asked, "q string, text string")


@pytest.fixture(scope="module")
def index(spark, tables):
    folder = new_folder(spark, "index")
    L.create(spark, folder)
    for part in ("substring(id, 5, 1) < '4'", "substring(id, 5, 1) >= '4'", "id LIKE 'z%' AND length(id) < 5"):
        L.add(spark, folder, tables[0].where(f"({part}) AND (id LIKE 'z%' AND length(id) < 5) = {'z%' in part}"), "id", words(), 16)
        L.merge(spark, folder) if "z%" not in part else None
    return L.Index(spark, folder)


@pytest.mark.parametrize("most", [2_000, 3])
def test_equals_the_scan_with_ties_and_in_turns(tables, index, most, monkeypatch):
    monkeypatch.setattr(L, "WAITING", 20)
    docs, asked = tables
    scored = R.bm25(asked, "q", words(), docs, "id", words())
    assert rows(L.search(index, asked, "q", words(), 7, "id", most=most)[0]) == rows(R.ranked(scored, "q", "id", 7))


def test_only_terms_and_blocks_are_shuffled(spark, tables, index, monkeypatch):
    made, plain = [], L.materialise
    monkeypatch.setattr(L, "materialise", lambda df, name: made.append((name, df._jdf.queryExecution().executedPlan().toString())) or plain(df, name))
    L.add(spark, index.folder, tables[0].select(F.concat(F.lit("n"), "id").alias("id"), "text"), "id", words())
    L.search(index, tables[1], "q", words(), 7, "id")
    plans = dict(made)
    assert set(plans) == {"inverted", "scored"} and "__q" not in plans["scored"].split("MapInArrow", 1)[1].split("\n", 1)[1]
    assert [plans[n].count("Exchange hashpartitioning") for n in ("inverted", "scored")] == [0, 1]
