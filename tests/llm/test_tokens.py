"""BPE and token shards against the tokenizers library."""

import hashlib
import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from tessera.llm import bpe, sstable
from tessera.llm.chunks import chunk_codes, slices
from tessera.llm.registry import vocabulary_path

TEXTS = [None, "", " \t\n", "The   cat's 12 mats!!", "ΑΣ ΣΑΣ İstanbul ß", "<|endoftext|>x<|startoftext|>", "aaaa aaaaa aaa", "漢字かな 🎉🎉", "á é", "x" * 5000, "the " * 3000, "   q​z \x1c\x00"]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(vocabulary_path())


@pytest.fixture(scope="module")
def vocabulary():
    with open(vocabulary_path(), encoding="utf-8") as f:
        return bpe.Vocabulary(f.read())


def table(spark, rows, extra=False):
    df = spark.createDataFrame(rows, "doc_id long, text string")
    return df.selectExpr("*", "'k' as key", "1 as ids", "2 as n_tokens", "3 as h") if extra else df


def test_chunks_rebuild_words():
    texts = pa.array([None, "", "  a b\t\na ", "c"])
    offsets, words, codes = chunk_codes(texts)
    words = words.to_pylist()
    assert [[words[c] for c in codes[a:b]] for a, b in zip(offsets, offsets[1:])] == [[], [], ["a", "b", "a"], ["c"]]
    batch = pa.RecordBatch.from_arrays([texts], names=["t"])
    assert sum(p.num_rows for p in slices(batch, "t", 3)) == 4
    assert not list(slices(batch.slice(0, 0), "t"))


def test_merges_equal_the_library(vocabulary, library):
    rng = random.Random(4)
    parts = [*"aaabAB'sStre09.-!?<|> Σİßé\n漢🎉", "<|endoftext|>", "'re", "ing", "՘", "Ᲊ", "the"]
    for _ in range(600):
        text = "".join(rng.choice(parts) for _ in range(rng.randrange(40)))
        chunks = [c for c in text.replace("\n", " ").split(" ") if c]
        want = library.encode(text, add_special_tokens=False).ids
        assert [i for c in vocabulary.encode_chunks(chunks) for i in c] == want, text
        assert vocabulary.decode(want) == library.decode(want, skip_special_tokens=False)


def test_overlapping_pairs_merge_from_the_left(vocabulary, library):
    for n in range(1, 40):
        assert list(vocabulary.encode_chunks(["a" * n])[0]) == library.encode("a" * n, add_special_tokens=False).ids


def test_caches_change_nothing(vocabulary, monkeypatch):
    chunks = [f"w{i}x" for i in range(300)]
    want = vocabulary.encode_chunks(chunks)
    monkeypatch.setattr(bpe, "CACHED_WORDS", 10)
    assert [vocabulary.encode_chunks(chunks[i : i + 7])[0] for i in range(0, 300, 7)] == want[::7]


def test_encode_and_decode_frames(spark, library):
    rows = [(i, t) for i, t in enumerate(TEXTS)] + [(3, TEXTS[3])]
    got = bpe.encode(table(spark, rows, extra=True), vocabulary_path(), outputs=("ids", "decoded", "digests")).collect()
    assert len(got) == len(rows)
    for r in got:
        want = library.encode(TEXTS[r.doc_id] or "", add_special_tokens=False).ids
        assert r.ids == want and r.n_tokens == len(want)
        assert r.decoded == library.decode(want, skip_special_tokens=False)
        assert r.ids_sha256 == hashlib.sha256(" ".join(map(str, want)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(r.decoded.encode()).hexdigest()
    ids = bpe.encode(table(spark, rows), vocabulary_path())
    assert bpe.decode_ids(ids.drop("decoded"), vocabulary_path()).where("decoded is null").count() == 0
    assert bpe.encode(table(spark, []), vocabulary_path()).count() == 0


def test_shards_read_back_in_order(spark, library, monkeypatch):
    rows = [(i * 3 - 9, t) for i, t in enumerate(TEXTS)] + [(6, "twice"), (6, "twice"), (None, "lost")]
    monkeypatch.setattr(sstable, "SHARD_BYTES", 4000)
    manifest = sstable.write_shards(table(spark, rows, extra=True), vocabulary_path())
    got = sorted(sstable.read_shards(manifest, ("ids", "crc32")).collect(), key=lambda r: r.start)
    assert [r.doc_id for r in got] == [None, *sorted(k for k, _ in rows if k is not None)]
    assert manifest.count() > manifest.select("shard").distinct().count()  # a task writes several files
    at, texts = 0, {}
    for k, t in rows:
        texts.setdefault(k, []).append(library.encode(t or "", add_special_tokens=False).ids + [1])
    for r in got:
        assert r.start == at and r.ids in texts[r.doc_id] and r.n_tokens == len(r.ids)
        assert r.ids_crc32 == zlib.crc32(np.array(r.ids, "<u4").tobytes())
        at += r.n_tokens
    empty = sstable.write_shards(table(spark, []), vocabulary_path())
    assert empty.count() == 0 and sstable.read_shards(empty, ("crc32",)).count() == 0


def test_lookup_by_identifier(tmp_path, monkeypatch):
    from tessera.llm.files import opened, publishing

    monkeypatch.setattr(sstable, "BLOCK_BYTES", 64)
    path = f"file://{tmp_path}/s.sst"
    rows = [(i, np.arange(i % 7 + 1, dtype="<u4")) for i in range(-50, 50, 2)] + [(60, np.array([8], "<u4")), (60, np.array([9], "<u4"))]
    with publishing(path) as f:
        w = sstable.Writer(f)
        for k, v in rows:
            w.add(k, v.tobytes())
        assert w.finish() == (len(rows), sum(len(v) for _, v in rows))
    with opened(path) as f:
        r = sstable.Reader(f)
        assert len(r.index) > 5 and [k for k, _ in r] == [k for k, _ in rows]
        for k, v in rows[:-2]:
            assert [x.tolist() for x in r.get(k)] == [v.tolist()]
        assert [x.tolist() for x in r.get(60)] == [[8], [9]] and r.get(1) == [] and r.get(999) == []
    with pytest.raises(ValueError), publishing(path) as f:
        w = sstable.Writer(f)
        w.add(2, b"")
        w.add(1, b"")
