"""Lower-cased words of Arrow text batches as integer codes.

A word is a run without ASCII white space (``[^\\x20\\x09-\\x0D]+``); only
A-Z is lower-cased.  Documents are taken in chunks of whole documents, so a
task holds a few megabytes of text (or one document) at a time.
"""

from __future__ import annotations

import ctypes
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash

CHUNK_BYTES = 8 << 20
CHUNK_DOCS = 60_000


@dataclass
class Chunk:
    """``rows``: the input rows; words of row i are codes[offsets[i]:offsets[i+1]]."""

    rows: pa.Table
    offsets: np.ndarray
    codes: np.ndarray
    vocab: pa.Array

    def lengths(self) -> np.ndarray:
        return np.diff(self.offsets)

    def word_hashes(self) -> np.ndarray:
        """A 64-bit hash of each vocabulary entry."""
        h = xxhash.xxh3_64_intdigest
        return np.fromiter((h(w) for w in self.vocab.to_pylist()), np.uint64, len(self.vocab))


def split_words(text: pa.Array) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """(offsets, codes, vocabulary) of a text array; null counts as empty."""
    text = pc.fill_null(text.cast(pa.large_string()), "")
    lists = pc.ascii_split_whitespace(pc.ascii_lower(text))
    if isinstance(lists, pa.ChunkedArray):
        lists = lists.combine_chunks()
    offsets = np.asarray(lists.offsets, dtype=np.int64)
    words = lists.values.dictionary_encode()
    codes = np.asarray(words.indices, dtype=np.int64)
    vocab = words.dictionary
    empty = pc.index(vocab, pa.scalar("", vocab.type)).as_py()
    if empty >= 0:  # white space at the ends of a text leaves empty strings
        keep = codes != empty
        offsets = np.concatenate([[0], np.cumsum(keep)])[offsets]
        codes = codes[keep]
    return offsets - offsets[0], codes, vocab


def table_chunks(batches: Iterator[pa.RecordBatch], column: str = "text",
                 chunk_bytes: int = CHUNK_BYTES) -> Iterator[pa.Table]:
    """The batches as tables of about ``chunk_bytes`` of ``column`` and at
    most CHUNK_DOCS rows each."""
    held: list[pa.RecordBatch] = []
    size = rows = 0
    for batch in batches:
        at = 0
        lens = np.asarray(pc.fill_null(pc.binary_length(batch.column(column)), 0), dtype=np.int64)
        ends = np.cumsum(lens)
        while at < batch.num_rows:
            before = ends[at - 1] if at else 0
            to = int(np.searchsorted(ends, before + chunk_bytes - size, side="left")) + 1
            to = max(at + 1, min(to, batch.num_rows, at + CHUNK_DOCS - rows))
            held.append(batch.slice(at, to - at))
            size += int(ends[to - 1] - before)
            rows += to - at
            at = to
            if size >= chunk_bytes or rows >= CHUNK_DOCS:
                yield pa.Table.from_batches(held)
                held, size, rows = [], 0, 0
                release()
    if held:
        yield pa.Table.from_batches(held)
    release()


def word_chunks(batches: Iterator[pa.RecordBatch], column: str = "text",
                chunk_bytes: int = CHUNK_BYTES) -> Iterator[Chunk]:
    for table in table_chunks(batches, column, chunk_bytes):
        offsets, codes, vocab = split_words(table.column(column).combine_chunks())
        yield Chunk(table, offsets, codes, vocab)


def mix(h: np.ndarray) -> np.ndarray:
    """Spread every input bit over all output bits (in place)."""
    h ^= h >> np.uint64(33)
    h *= np.uint64(0xFF51AFD7ED558CCD)
    h ^= h >> np.uint64(33)
    return h


def ngram_hashes(hashes: np.ndarray, n: int) -> np.ndarray:
    """Hash of each run of n consecutive words, over document borders too."""
    size = len(hashes) - n + 1
    if size <= 0:
        return np.empty(0, np.uint64)
    out = hashes[:size].copy()
    for k in range(1, n):
        out *= np.uint64(0x9E3779B97F4A7C15)
        out += hashes[k:k + size]
    return mix(out)


def bucket_runs(sorted_hashes: np.ndarray, bits: int) -> list[tuple[int, int, int]]:
    """(bucket, from, to) of the runs of equal upper ``bits``, those that occur."""
    if not len(sorted_hashes):
        return []
    top = sorted_hashes >> np.uint64(64 - bits) if bits else np.zeros(len(sorted_hashes), np.uint64)
    edge = np.flatnonzero(np.concatenate([[True], top[1:] != top[:-1], [True]]))
    return list(zip(top[edge[:-1]].tolist(), edge[:-1].tolist(), edge[1:].tolist(), strict=True))


def pack_sorted(h: np.ndarray, size: int = 8) -> bytes:
    """Sorted hashes, of which the upper ``size`` bytes are used, as two
    planes; the upper one is long runs, which the shuffle's compression
    removes."""
    b = h.view(np.uint8).reshape(-1, 8)
    return b[:, 6:].tobytes() + b[:, 8 - size:6].tobytes()


def unpack_sorted(data: bytes, size: int = 8) -> np.ndarray:
    n = len(data) // size
    b = np.zeros((n, 8), np.uint8)
    raw = np.frombuffer(data, np.uint8)
    b[:, 6:], b[:, 8 - size:6] = raw[:2 * n].reshape(n, 2), raw[2 * n:].reshape(n, size - 2)
    return b.reshape(-1).view(np.uint64)


def squeeze(data: np.ndarray) -> bytes:
    """An array's bytes compressed, the plain length first."""
    raw = data.tobytes()
    return len(raw).to_bytes(8, "little") + pa.compress(raw, codec="zstd", asbytes=True)


def unsqueeze(data: bytes, kind) -> np.ndarray:
    return np.frombuffer(pa.decompress(data[8:], int.from_bytes(data[:8], "little"), codec="zstd"), kind)


def pack_counts(counts: np.ndarray) -> bytes:
    """Counts from 0 up, compressed by byte plane: the upper ones are nearly
    all zeros."""
    return squeeze(counts.astype("<u8").view(np.uint8).reshape(-1, 8).T)


def unpack_counts(data: bytes) -> np.ndarray:
    return unsqueeze(data, np.uint8).reshape(8, -1).T.copy().view("<i8").reshape(-1)


def release() -> None:
    """Give the memory that a finished chunk has freed back to the system;
    a Python worker lives on and would keep it for its next task."""
    pa.default_memory_pool().release_unused()
    ctypes.CDLL(None).malloc_trim(0)
