"""Token ids in sorted-string-table shards.

A shard holds the documents of one range of keys in ascending order:

    data blocks      entries (shared prefix, rest of the key, value), compressed with Zstandard
    block index      last key, offset and size of each block: sparse, one entry a block
    Bloom filter     over the keys, ten bits each
    footer           offsets and sizes of index and filter, counts of documents and ids, magic

A key is one byte 1 and the big-endian identifier with its sign bit flipped, so bytes order as
numbers do; documents without an identifier come first, under nine zero bytes. A value is the ids
as little-endian unsigned 32-bit integers. Lookup reads the footer, asks the filter,
searches the index in halves and reads one block.
"""

from __future__ import annotations

import bisect
import itertools
import struct
import zlib

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.bpe import _vocabulary, share
from tessera.llm.chunks import chunk_codes, listed, slices, spread
from tessera.llm.files import opened, publishing
from tessera.session import new_folder, ship_package, shuffle_partitions

BLOCK_BYTES, BLOOM_BITS, BLOOM_HASHES = 1 << 18, 10, 7
#: A task begins a new file after so many bytes of values, which bounds the keys that it holds.
SHARD_BYTES, KEY_BYTES = 1 << 28, 9
FOOTER, MAGIC = struct.Struct("<QQQQQQ8s"), b"TSRSST02"


def key_bytes(identifier: int | None) -> bytes:
    return bytes(KEY_BYTES) if identifier is None else struct.pack(">BQ", 1, (identifier + (1 << 63)) & 0xFFFFFFFFFFFFFFFF)


def key_value(key: bytes) -> int | None:
    return struct.unpack(">Q", key[1:])[0] - (1 << 63) if key[0] else None


def _varint(n: int) -> bytes:
    out = bytearray()
    while n > 127:
        out.append(n & 127 | 128)
        n >>= 7
    return bytes([*out, n])


def _read_varint(data: bytes, at: int) -> tuple[int, int]:
    n = shift = 0
    while True:
        b = data[at]
        n |= (b & 127) << shift
        at += 1
        if b < 128:
            return n, at
        shift += 7


def _bloom_bits(keys: list[bytes], bits: int) -> np.ndarray:
    """Positions of each key by double hashing, one row a key."""
    h = np.array([xxhash.xxh3_64_intdigest(k) for k in keys], np.uint64)
    step = (h >> np.uint64(32)) | np.uint64(1)
    return (h[:, None] + step[:, None] * np.arange(BLOOM_HASHES, dtype=np.uint64)) % np.uint64(bits)


class Writer:
    """Takes (identifier, ids as bytes) in ascending order."""

    def __init__(self, stream):
        self.stream, self.block, self.held, self.last = stream, [], 0, b""
        self.index, self.keys, self.offset, self.ids = [], [], 0, 0
        self.zstd = zstandard.ZstdCompressor(level=1)

    def add(self, identifier: int | None, value: bytes) -> None:
        key = key_bytes(identifier)
        if self.block and key < self.last:
            raise ValueError("identifiers must ascend")
        shared = 0
        if self.block:
            while shared < len(key) and key[shared] == self.last[shared]:
                shared += 1
        self.block += [bytes([shared, len(key) - shared]), _varint(len(value)), key[shared:], value]
        self.held += len(value) + 16
        self.last = key
        self.keys.append(key)
        self.ids += len(value) // 4
        if self.held >= BLOCK_BYTES:
            self._flush()

    def _flush(self) -> None:
        data = self.zstd.compress(b"".join(self.block))
        self.stream.write(data)
        self.index.append((self.last, self.offset, len(data)))
        self.offset += len(data)
        self.block, self.held = [], 0

    def finish(self) -> tuple[int, int]:
        if self.block:
            self._flush()
        index = b"".join(k + struct.pack("<QQ", o, n) for k, o, n in self.index)
        bits = max(64, BLOOM_BITS * len(self.keys))
        field = np.zeros(bits, np.uint8)
        if self.keys:
            field[_bloom_bits(self.keys, bits).ravel()] = 1
        bloom = struct.pack("<Q", bits) + np.packbits(field).tobytes()
        self.stream.write(index + bloom)
        self.stream.write(FOOTER.pack(self.offset, len(index), self.offset + len(index), len(bloom), len(self.keys), self.ids, MAGIC))
        return len(self.keys), self.ids


class Reader:
    def __init__(self, file):
        self.file, size = file, file.size()
        index_at, index_n, bloom_at, bloom_n, self.documents, self.ids, magic = FOOTER.unpack(file.read_at(FOOTER.size, size - FOOTER.size))
        if magic != MAGIC:
            raise ValueError("not a token shard")
        raw = file.read_at(index_n, index_at)
        self.index = [(raw[i : i + KEY_BYTES], *struct.unpack_from("<QQ", raw, i + KEY_BYTES)) for i in range(0, len(raw), KEY_BYTES + 16)]
        bloom = file.read_at(bloom_n, bloom_at)
        self.bits, self.bloom = struct.unpack_from("<Q", bloom)[0], np.frombuffer(bloom, np.uint8, offset=8)
        self.zstd = zstandard.ZstdDecompressor()

    def block(self, i: int):
        """(identifier, ids as bytes) of the entries of one block."""
        _, offset, n = self.index[i]
        data, at, key = self.zstd.decompress(self.file.read_at(n, offset)), 0, b""
        while at < len(data):
            shared, rest = data[at], data[at + 1]
            size, at = _read_varint(data, at + 2)
            key = key[:shared] + data[at : at + rest]
            at += rest
            yield key_value(key), data[at : at + size]
            at += size

    def __iter__(self):
        for i in range(len(self.index)):
            yield from self.block(i)

    def get(self, identifier: int | None) -> list[np.ndarray]:
        """The ids of every document of that identifier; an empty list if the shard has none."""
        key, found = key_bytes(identifier), []
        at = _bloom_bits([key], self.bits)[0].astype(np.int64)
        if not (self.bloom[at >> 3] >> (7 - (at & 7)) & 1).all():
            return found
        i = bisect.bisect_left(self.index, key, key=lambda e: e[0])
        while i < len(self.index):
            entries = [(k, v) for k, v in self.block(i) if k == identifier]
            found += [np.frombuffer(v, "<u4") for _, v in entries]
            if not entries or self.index[i][0] > key:
                break
            i += 1
        return found


def write_shards(docs: DataFrame, vocabulary_path: str, folder: str | None = None, end_id: int = 1, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Encode every whole text with the tokenizers library, append end_id and write shards.

    Texts are dealt by range of (key, hash of the text), so one identifier with very many rows
    spreads over shards; each task sorts its range, encodes it and publishes a file for every
    SHARD_BYTES of ids. Returns the manifest, one row a file: shard, path, documents, ids, start
    (ids of all files before it). The manifest alone passes the driver. Null and empty texts hold
    end_id only; rows without an identifier come first; repeated rows are kept, ties in the order
    of their texts' hashes.
    """
    spark = docs.sparkSession
    ship_package(spark)
    folder = folder or new_folder(spark, "sstable")
    shared = share(spark, vocabulary_path)
    n = shuffle_partitions(spark)
    source = docs.select(F.col(key).cast("long").alias("k"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    dealt = source.withColumn("h", F.xxhash64("text")).repartitionByRange(n, "k", "h").sortWithinPartitions("k", "h").drop("h")

    def files(parts, shard: int):
        """(path, documents, ids) of the files of one task."""
        v, end, part, row = _vocabulary(shared), np.array([end_id], "<u4").tobytes(), next(parts, None), 0
        for file in itertools.count():
            if part is None:
                return
            path = f"{folder}/shard-{shard:06d}-{file:06d}.sst"
            with publishing(path) as stream:
                w = Writer(stream)
                while part is not None and w.ids * 4 < SHARD_BYTES:
                    if not row:
                        offsets, chunks, codes = chunk_codes(part.column("text"))
                        flat, sizes = v.encode_flat(listed(chunks), by_library=True)
                        flat, starts, keys = flat.astype("<u4"), np.cumsum(sizes) - sizes, part.column("k").to_pylist()
                    while row < len(keys) and w.ids * 4 < SHARD_BYTES:
                        w.add(keys[row], flat[spread(sizes, starts, codes[offsets[row] : offsets[row + 1]])].tobytes() + end)
                        row += 1
                    if row == len(keys):
                        part, row = next(parts, None), 0
                documents, total = w.finish()
            yield path, documents, total

    def run(batches):
        from pyspark import TaskContext

        shard = TaskContext.get().partitionId()
        for path, documents, total in files((p for b in batches for p in slices(b, "text")), shard):
            yield pa.RecordBatch.from_pydict({"shard": pa.array([shard], pa.int32()), "path": [path], "documents": pa.array([documents], pa.int64()), "ids": pa.array([total], pa.int64())})

    rows = sorted(dealt.mapInArrow(run, "shard int, path string, documents long, ids long").collect())
    starts = np.cumsum([0, *[r.ids for r in rows]])
    return spark.createDataFrame([(*r, int(s)) for r, s in zip(rows, starts, strict=False)], "shard int, path string, documents long, ids long, start long")


def read_shards(manifest: DataFrame, outputs=("ids",)) -> DataFrame:
    """doc_id, start and n_tokens of every document in the files, with "ids" (array<long>) or
    "crc32" (ids_crc32, of the ids as little-endian unsigned 32-bit integers)."""
    spark = manifest.sparkSession
    ship_package(spark)

    def run(batches):
        for batch in batches:
            for path, start in zip(batch.column("path").to_pylist(), batch.column("start").to_pylist(), strict=True):
                with opened(path) as f:
                    reader, at = Reader(f), start
                    for i in range(len(reader.index)):
                        entries = list(reader.block(i))
                        sizes = [len(x) // 4 for _, x in entries]
                        made = {"doc_id": pa.array([k for k, _ in entries], pa.int64()), "start": pa.array((np.cumsum([at, *sizes])[:-1]), pa.int64()), "n_tokens": pa.array(sizes, pa.int64())}
                        at += sum(sizes)
                        if "ids" in outputs:
                            made["ids"] = pa.array([np.frombuffer(x, "<u4").astype(np.int64) for _, x in entries], pa.list_(pa.int64()))
                        if "crc32" in outputs:
                            made["ids_crc32"] = pa.array([zlib.crc32(x) for _, x in entries], pa.int64())
                        yield pa.RecordBatch.from_pydict(made)

    extra = {"ids": ", ids array<long>", "crc32": ", ids_crc32 long"}
    files = manifest.select("path", "start")
    files = files.repartition(max(1, min(shuffle_partitions(spark), files.count())))
    return files.mapInArrow(run, "doc_id long, start long, n_tokens long" + "".join(extra[o] for o in outputs))
