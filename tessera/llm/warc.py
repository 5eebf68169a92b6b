"""WARC archives as seekable Zstandard bundles.

Records are grouped into frames that decompress alone. After the frames stand two skippable frames:
the record index (identifier, frame, offset in the frame) and the seek table of Zstandard's public
seekable format (compressed and decompressed size of each frame, footer with magic number). A
record is found by its identifier with two reads: the tail of the file, and one frame.

Of records with equal payloads of at least `least` bytes, that with the largest identifier is the
response and the others are revisits that name it; smaller payloads are responses all. Rows that
repeat the identifier of the response are responses too, as none is the larger. A null payload is
empty; a null URL leaves its header out; rows without an identifier are left out of the archive.
"""

from __future__ import annotations

import hashlib
import struct
from urllib.parse import quote

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.chunks import slices
from tessera.llm.files import opened, publishing
from tessera.session import new_folder, ship_package, shuffle_partitions

LEAST, FRAME_BYTES = 1000, 1 << 20
#: Fixed by the Zstandard seekable format: skippable frame and footer magic numbers.
SEEK_SKIPPABLE, SEEK_MAGIC = 0x184D2A5E, 0x8F92EAB1
INDEX_SKIPPABLE = 0x184D2A5D
HTTP_HEAD = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"


def record_id(identifier: int | str) -> str:
    """A name-based UUID, so that any job gives a page the same record identifier."""
    import uuid

    return f"urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'page:{identifier}')}"


def record(identifier: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None) -> bytes:
    revisit = refers_to is not None
    block = HTTP_HEAD if revisit else HTTP_HEAD + payload
    head = ["WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: <{record_id(f'{digest} {url}' if identifier is None else identifier)}>", "WARC-Date: 1970-01-01T00:00:00Z"]
    if url is not None:
        head.append(f"WARC-Target-URI: {quote(url, safe='%/:=&?~#+!$,;@()*[]')}")
    head += [f"WARC-Payload-Digest: sha1:{digest}", f"Payload-Length: {len(payload)}"]
    if identifier is not None:
        head.append(f"Page-ID: {identifier}")
    if revisit:
        head += [f"WARC-Refers-To: <{record_id(refers_to)}>", f"Refers-To-Page-ID: {refers_to}", "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"]
    head += ["Content-Type: application/http;msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse(data: bytes, at: int) -> tuple[dict[str, str], bytes, int]:
    """(headers, block, where the next record begins) of the record at `at`."""
    end = data.index(b"\r\n\r\n", at)
    lines = data[at:end].decode().split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError("not a WARC record")
    headers = {k.lower(): v for k, _, v in (x.partition(": ") for x in lines[1:])}
    start = end + 4
    stop = start + int(headers["content-length"])
    return headers, data[start:stop], stop + 4


class BundleWriter:
    def __init__(self, stream):
        self.stream, self.held, self.size, self.frames, self.index = stream, [], 0, [], []
        self.zstd = zstandard.ZstdCompressor(level=3)
        self.bytes = 0

    def add(self, identifier: int | None, data: bytes) -> None:
        if identifier is not None:  # nothing could look the others up
            self.index.append((identifier, len(self.frames), self.size))
        self.held.append(data)
        self.size += len(data)
        if self.size >= FRAME_BYTES:
            self._flush()

    def _write(self, data: bytes) -> None:
        self.stream.write(data)
        self.bytes += len(data)

    def _flush(self) -> None:
        data = self.zstd.compress(b"".join(self.held))
        self._write(data)
        self.frames.append((len(data), self.size))
        self.held, self.size = [], 0

    def finish(self) -> None:
        if self.held:
            self._flush()
        index = b"".join(struct.pack("<qIQ", *e) for e in sorted(self.index))
        self._write(struct.pack("<II", INDEX_SKIPPABLE, len(index)) + index)
        self.frames.append((len(index) + 8, 0))  # the index is a frame of no content
        table = b"".join(struct.pack("<II", *f) for f in self.frames)
        self._write(struct.pack("<II", SEEK_SKIPPABLE, len(table) + 9) + table + struct.pack("<IBI", len(self.frames), 0, SEEK_MAGIC))


class Bundle:
    """Reads a bundle: its frames in order, or one record by identifier."""

    def __init__(self, file):
        self.file, size = file, file.size()
        n, flags, magic = struct.unpack("<IBI", file.read_at(9, size - 9))
        if magic != SEEK_MAGIC or flags:
            raise ValueError("no seek table")
        table = file.read_at(8 * n, size - 9 - 8 * n)
        self.frames, at = [], 0
        for i in range(n):
            packed, plain = struct.unpack_from("<II", table, 8 * i)
            self.frames.append((at, packed, plain))
            at += packed
        self.zstd, self._index = zstandard.ZstdDecompressor(), None

    def frame(self, i: int) -> bytes:
        at, packed, plain = self.frames[i]
        return self.zstd.decompress(self.file.read_at(packed, at), max_output_size=plain)

    def records(self):
        for i, (_, _, plain) in enumerate(self.frames):
            if plain:
                data, at = self.frame(i), 0
                while at < len(data):
                    headers, block, at = parse(data, at)
                    yield headers, block

    def find(self, identifier: int):
        """(headers, block) of the record of that identifier, or None."""
        if self._index is None:
            at, packed, _ = self.frames[-1]
            raw = self.file.read_at(packed, at)[8:]
            self._index = {k: (f, o) for k, f, o in struct.iter_unpack("<qIQ", raw)}
        place = self._index.get(identifier)
        return None if place is None else parse(self.frame(place[0]), place[1])[:2]


def write_archives(pages: DataFrame, folder: str | None = None, key: str = "page_id", url: str = "url", html: str = "html", least: int = LEAST) -> DataFrame:
    """Write one bundle for each task and return the manifest: path, records, bytes.

    Equal payloads meet by digest and length in an aggregate that combines before its shuffle; its
    few rows, one for each payload that occurs twice, are joined back. Pages without an identifier are
    written too, and revisit a page that has one. Payloads cross at most one
    shuffle, and that join can be split where one payload is very frequent.
    """
    spark = pages.sparkSession
    ship_package(spark)
    folder = folder or new_folder(spark, "warc")
    source = pages.select(F.col(key).cast("long").alias("k"), F.col(url).alias("url"), F.coalesce(F.col(html), F.lit("")).alias("html"))
    source = source.withColumn("digest", F.sha1(F.encode("html", "utf-8"))).withColumn("size", F.octet_length("html"))
    repeated = source.where(F.col("size") >= least).groupBy("digest", "size").agg(F.max("k").alias("chosen"), F.count("*").alias("n")).where("n > 1").select("digest", "size", "chosen")
    marked = source.join(repeated, ["digest", "size"], "left").select("k", "url", "html", "digest", F.when(~F.col("chosen").eqNullSafe(F.col("k")), F.col("chosen")).alias("refers_to"))

    def run(batches):
        from pyspark import TaskContext

        part = TaskContext.get().partitionId()
        path, n = f"{folder}/part-{part:06d}.warc.zst", 0
        with publishing(path) as stream:
            w = BundleWriter(stream)
            for batch in batches:
                for piece in slices(batch, "html"):
                    for k, u, h, d, r in zip(*[piece.column(c).to_pylist() for c in ("k", "url", "html", "digest", "refers_to")], strict=True):
                        w.add(k, record(k, u, h.encode("utf-8"), d, r))
                        n += 1
            w.finish()
        yield pa.RecordBatch.from_pydict({"path": [path], "records": pa.array([n], pa.int64()), "bytes": pa.array([w.bytes], pa.int64())})

    rows = marked.mapInArrow(run, "path string, records long, bytes long").where("records > 0").collect()
    return spark.createDataFrame(rows, "path string, records long, bytes long")


def read_archives(manifest: DataFrame, payload: bool = False) -> DataFrame:
    """One row a record: page_id, payload_bytes, payload_digest, record_type, refers_to, and with
    `payload` the payload of responses. The digest of a response is taken anew from its payload."""
    spark = manifest.sparkSession
    ship_package(spark)
    names = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"] + ["payload"] * payload
    schema = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long" + ", payload binary" * payload
    arrow = pa.schema([("page_id", pa.int64()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64())] + [("payload", pa.binary())] * payload)

    def run(batches):
        for batch in batches:
            for path in batch.column("path").to_pylist():
                with opened(path) as f:
                    rows, held = [], 0
                    for headers, block in Bundle(f).records():
                        body = block[block.index(b"\r\n\r\n") + 4 :]
                        kind = headers["warc-type"]
                        digest = headers["warc-payload-digest"].partition(":")[2]
                        if kind == "response" and hashlib.sha1(body).hexdigest() != digest:
                            raise ValueError(f"payload of page {headers.get('page-id')} is damaged")
                        refers = headers.get("refers-to-page-id")
                        page = headers.get("page-id")
                        row = [None if page is None else int(page), int(headers["payload-length"]), digest, kind, None if refers is None else int(refers)]
                        rows.append(row + [body if kind == "response" else None] * payload)
                        held += len(body) if payload else 1
                        if held > (1 << 23 if payload else 20_000):
                            yield pa.RecordBatch.from_pylist([dict(zip(names, r, strict=True)) for r in rows], schema=arrow)
                            rows, held = [], 0
                    yield pa.RecordBatch.from_pylist([dict(zip(names, r, strict=True)) for r in rows], schema=arrow)

    files = manifest.select("path")
    return files.repartition(max(1, min(shuffle_partitions(spark), files.count()))).mapInArrow(run, schema)
