"""White-space chunks of a batch of texts as a dictionary: unique chunks once, codes per document."""

from __future__ import annotations

import ctypes

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Texts handled at once inside a task: bounds memory whatever the size of Arrow's batches.
SLICE_BYTES = 12_000_000


def tidy() -> None:
    """Give freed memory back to the system. A worker serves many tasks and stages, and what its
    allocators keep would otherwise pile up beside the executor's heap."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # not the GNU C library
        pass


def slices(batch: pa.RecordBatch, column: str, limit: int = SLICE_BYTES):
    """Cut a batch into runs of rows with about `limit` bytes of text; a longer row stands alone."""
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    start = total = 0
    for i, n in enumerate(sizes):
        if total and total + n > limit:
            yield batch.slice(start, i - start)
            tidy()
            start, total = i, 0
        total += int(n)
    if start < batch.num_rows:
        yield batch.slice(start)
        tidy()


def chunk_codes(texts: pa.Array) -> tuple[np.ndarray, pa.Array, np.ndarray]:
    """(offsets, unique chunks, codes): document i has codes[offsets[i]:offsets[i+1]].

    Chunks are split at runs of ASCII white space only. Null and empty texts have no chunks.
    """
    lists = pc.ascii_split_whitespace(pc.fill_null(texts.cast(pa.large_string()), ""))
    lists = lists.combine_chunks() if isinstance(lists, pa.ChunkedArray) else lists
    offsets = lists.offsets.to_numpy(zero_copy_only=False).astype(np.int64)
    offsets = offsets - offsets[0]
    coded = lists.flatten().dictionary_encode()
    codes, words = coded.indices.to_numpy(zero_copy_only=False), coded.dictionary
    empty = pc.index(words, pa.scalar("", words.type)).as_py()
    if empty >= 0:  # leading and trailing white space give empty chunks
        keep = codes != empty
        offsets = np.concatenate(([0], np.cumsum(keep)))[offsets]
        codes = codes[keep]
    return offsets, words, codes


def listed(chunks: pa.Array) -> list[str]:
    """The chunks as Python strings: cut from one text, which costs a tenth of converting each."""
    chunks = chunks.cast(pa.large_string())
    if not len(chunks):
        return []
    bounds = np.frombuffer(chunks.buffers()[1], np.int64)[chunks.offset : chunks.offset + len(chunks) + 1]
    data = np.frombuffer(chunks.buffers()[2], np.uint8)[bounds[0] : bounds[-1]]
    out = np.full(len(data) + len(chunks) - 1, 10, np.uint8)  # line feeds, which no chunk holds
    inner = np.ones(len(out), bool)
    inner[bounds[1:-1] - bounds[0] + np.arange(len(chunks) - 1)] = False
    out[inner] = data
    return out.tobytes().decode("utf-8").split("\n")


def spread(lengths: np.ndarray, starts: np.ndarray, codes: np.ndarray) -> np.ndarray:
    """Indices of all items of all codes in order, where code c owns starts[c] .. +lengths[c]."""
    n = lengths[codes]
    ends = np.cumsum(n)
    out = np.repeat(starts[codes] - (ends - n), n)
    out += np.arange(len(out))
    return out
