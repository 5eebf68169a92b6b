"""Parts of a manifest are hashed in pieces, whatever their size and file system."""

import hashlib

import pytest

from tessera.sources import tables


@pytest.mark.parametrize("opened", [("file",), ()])
def test_no_part_is_held_whole(spark, tmp_path, monkeypatch, opened):
    monkeypatch.setattr(tables, "OPENED", opened)
    monkeypatch.setattr(tables, "PIECE", 1000)
    folder = tmp_path / "a b%20c"
    folder.mkdir()
    bodies = {f"p{i}": bytes([i]) * 4321 for i in range(5)} | {"empty": b""}
    for name, body in bodies.items():
        (folder / name).write_bytes(body)
    want = {n: hashlib.sha256(b).hexdigest() for n, b in bodies.items()}
    spark.conf.set("spark.sql.sources.binaryFile.maxLength", 100)  # Spark's reader, which holds a file as one value, refuses larger ones
    try:
        assert tables.part_digests(spark, [f"file://{folder}/p?", f"file://{folder}/empty"]) == want
        assert tables.damaged_parts(spark, str(folder), want).isEmpty()
        bad = tables.damaged_parts(spark, str(folder), want | {"p1": want["p2"], "lost": want["p1"]}).collect()
    finally:
        spark.conf.unset("spark.sql.sources.binaryFile.maxLength")
    assert {(r["name"], r.expected, r.found) for r in bad} == {("p1", want["p2"], want["p1"]), ("lost", want["p1"], None)}
    with pytest.raises(FileNotFoundError):
        tables.part_digests(spark, [f"file://{folder}/q*"])
