"""Every item that stands in a document is gold, however short, and also where it begins or ends within a word."""

import duckdb
import pytest

from tessera.plans import advanced, registry

DOCS = [
    (1, "The unstarting of all great rivers flows outwardly here.", "en"),
    (2, "Eins zwei drei, vier fünf sechs sieben acht!", "de"),
    (3, "starting of all great rivers flows outward", None),
    (4, "ΟΔΟΣ οδος ΟΔΟΣ; a.b.c -- 12 34 56 78 90 12", "en"),
    (5, "nothing of it", "en"),
    (6, None, "de"),
    (7, "病毒感染了很多人 ét́é", "de"),
]
ITEMS = [
    (0, "starting of all great rivers flows outward"),
    (1, "of"),
    (2, "vier fünf"),
    (3, "--"),
    (4, "ΔΟΣ οδος ΟΔ"),
    (5, ", vier fünf sechs sieben acht!"),
    (6, "2 34 56 78 90 1"),
    (7, "Starting of all great rivers flows outward"),
    (8, "absent"),
    (9, ""),
    (10, "感染"),
    (11, "e"),
    (12, "starting of all great riv"),
    (13, None),
    (14, "́t́"),
    (15, " of all great rivers flows "),
]


@pytest.fixture(scope="module")
def gold_dir(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("gold")
    spark.createDataFrame(DOCS, "doc_id long, text string, lang string").write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(ITEMS, "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    return str(folder)


@pytest.mark.parametrize("turn", [10_000, 4])
def test_gold_is_every_pair(spark, gold_dir, monkeypatch, turn):
    monkeypatch.setattr(advanced, "TURN", turn)
    got = sorted((r.item_id, r.doc_id, r.lang) for r in advanced.gold_passages(spark, gold_dir, "lang").collect())
    assert got == sorted((i, d, lang) for i, t in ITEMS for d, text, lang in DOCS if t and text and t in text)


@pytest.mark.parametrize("name", ["leg_ablations", "metrics_by_slice", "slice_regression_gate"])
def test_judged_as_in_sql(spark, gold_dir, name):
    plain = lambda row: str(sorted((c, v + 0.0 if isinstance(v, float) else v) for c, v in row.items()))
    with duckdb.connect() as db:
        for t in ("documents", "benchmark"):
            db.sql(f"CREATE VIEW {t} AS SELECT * FROM '{gold_dir}/{t}.parquet/*.parquet'")
        rel = db.sql(registry.oracle_sql()[name])
        want = sorted(plain(dict(zip(rel.columns, r, strict=True))) for r in rel.fetchall())
    assert sorted(plain(r.asDict()) for r in registry.queries()[name](spark, gold_dir).collect()) == want
