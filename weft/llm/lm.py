"""Deleted interpolation: a bigram language model over words.

    p(w | v) = l2(b) c(v w) / c(v) + l1(b) c(w) / N + l0(b) / (V + 1)

b is the bucket of the context's count c(v) (its binary order of magnitude);
the weights of a bucket are learned by expectation-maximisation on training
documents that are held back from the counts (Jelinek and Mercer).  The
scores then use the counts of all training documents.  A text is its words
and one end; the end before a text is the first word's context.

Scale: counts are gathered by hash over the whole corpus.  Each chunk of
documents sends the sorted hashes of its distinct words and bigrams with
their counts, packed by bucket; a bucket adds them up and answers every chunk
in the same order.  The chunk's word codes travel along, so a text is read
and cut once.  A task holds one bucket or one chunk.  What is collected is
one pair of totals per bucket and the histogram that the weights are learned
from (at most some ten thousand cells, by bucket and by ratios of the three
estimates in eighths of a power of two).

Defined results: null or blank text is the end alone; a null doc_id is scored
and not learned from; repeated rows count as often as they come; without
training text every probability is 1; without held-back text each bucket's
weights stay at ``START``.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weft.llm.common import bucket_bits, doc_texts, stored
from weft.llm.words import (bucket_runs, mix, pack_counts, pack_sorted, release, squeeze, unpack_counts, unpack_sorted,
                            unsqueeze, word_chunks)

END = np.uint64(0x5DEECE66D1CE4E5B)  # the end's hash
CHUNK = 8 << 20
BUCKET_WORDS = 1 << 17
ROOM = ~np.uint64(0xFF)  # n-gram hashes have 56 bits
START = (0.3, 0.6, 0.1)  # weights of bigram, word and uniform
ROUNDS = 40
BINS = 8  # in a power of two
NONE = -(1 << 20)  # bin of an estimate that is 0

SENT = "bucket int, chunk long, hashes binary, counts binary, codes binary, vocab binary, docs binary"
JOINED = "chunk long, counts binary, pairs binary, docs binary, cells binary"
SCORES = "doc_id long, n_tokens long, n_known long, base_score double, score double"


def _rows(rows: list[tuple], schema: str) -> pa.RecordBatch:
    fields = [f.split() for f in schema.split(", ")]
    kinds = {"int": pa.int32(), "long": pa.int64(), "binary": pa.binary()}
    columns = zip(*rows, strict=True) if rows else [[]] * len(fields)
    return pa.RecordBatch.from_arrays([pa.array(c, kinds[k]) for c, (_, k) in zip(columns, fields, strict=True)],
                                      names=[n for n, _ in fields])


def _with_ends(codes: np.ndarray, offsets: np.ndarray, end: int) -> tuple[np.ndarray, np.ndarray]:
    """Codes of the texts with an end after each, and the new offsets."""
    offsets = offsets + np.arange(len(offsets))
    out = np.full(offsets[-1], end, np.int64)
    keep = np.ones(len(out), bool)
    keep[offsets[1:] - 1] = False
    out[keep] = codes
    return out, offsets


def _grams(hashes: np.ndarray, tokens: np.ndarray, offsets: np.ndarray):
    """(sorted distinct hashes, place of each word, place of each token's
    bigram).  ``hashes`` are the words', the end's last; the lowest bit of a
    result tells words (0) from bigrams (1)."""
    before = np.empty_like(tokens)
    before[1:] = tokens[:-1]
    before[offsets[:-1]] = len(hashes) - 1
    # distinct pairs first, by code, as these sort faster than hashes
    pairs, at = np.unique(before * len(hashes) + tokens, return_inverse=True)
    v, w = np.divmod(pairs, len(hashes))
    two = mix(hashes[v] * np.uint64(0x9E3779B97F4A7C15) + hashes[w]) & ROOM | np.uint64(1 << 8)
    one = mix(hashes.copy()) & ROOM & ~np.uint64(1 << 8)
    every, place = np.unique(np.concatenate([one, two]), return_inverse=True)
    return every, place[:len(hashes)], place[len(hashes):][at], before


def _chunks(batches):
    """(name, hashes, tokens, offsets, rows) of each chunk."""
    part = TaskContext.get().partitionId()
    for k, chunk in enumerate(word_chunks(batches, chunk_bytes=CHUNK)):
        hashes = np.concatenate([chunk.word_hashes(), [END]])
        yield (part << 20) + k, hashes, *_with_ends(chunk.codes, chunk.offsets, len(hashes) - 1), chunk.rows
        release()


def _describe(batches):
    """A row for each chunk with its tokens and documents."""
    for name, hashes, tokens, offsets, rows in _chunks(batches):
        ids, kind = rows.column("doc_id").combine_chunks(), rows.column("kind").to_numpy().astype(np.int64)
        docs = np.stack([ids.fill_null(0).to_numpy(), np.asarray(ids.is_valid()).astype(np.int64), kind,
                         np.diff(offsets)])
        yield _rows([(-1, name, None, None, squeeze(tokens.astype("<u4")), hashes.tobytes(), docs.tobytes())], SENT)


def _emit(batches, bits: int):
    """The sorted n-grams of each chunk with their counts, by bucket."""
    for name, hashes, tokens, offsets, rows in _chunks(batches):
        every, word, pair, _ = _grams(hashes, tokens, offsets)
        kind = np.repeat(rows.column("kind").to_numpy(), np.diff(offsets))
        counts = np.empty((2, len(every)), np.int64)
        for i, at in enumerate((np.flatnonzero(kind > 0), np.flatnonzero(kind == 1))):  # learned from, not held back
            counts[i] = (np.bincount(word[tokens[at]], minlength=len(every))
                         + np.bincount(pair[at], minlength=len(every)))
        out = [(b, name, pack_sorted(every[x:y], 7), _pair(counts[:, x:y]), None, None, None)
               for b, x, y in bucket_runs(every, bits)]
        for i in range(0, len(out), 256):
            yield _rows(out[i:i + 256], SENT)


def _pair(counts: np.ndarray) -> bytes:
    """(all, not held back): the second is sent as what it lacks, mostly 0."""
    return pack_counts(np.concatenate([counts[0], counts[0] - counts[1]]))


def _unpair(data: bytes) -> np.ndarray:
    counts = unpack_counts(data).reshape(2, -1)
    return np.stack([counts[0], counts[0] - counts[1]])


def _add(batches):
    """Buckets, in order -> the total counts of each chunk's hashes, and a
    row without chunk with the bucket's words and distinct words."""
    held: list[tuple] = []
    for b in batches:
        for row in zip(*(b.column(i).to_pylist() for i in range(7)), strict=True):
            if held and held[0][0] != row[0]:
                yield _totals(held)
                held = []
            held.append(row)
    if held:
        yield _totals(held)


def _totals(rows: list[tuple]) -> pa.RecordBatch:
    hashes = [unpack_sorted(r[2], 7) for r in rows]
    counts = np.concatenate([_unpair(r[3]) for r in rows], axis=1)
    known, at = np.unique(np.concatenate(hashes), return_inverse=True)
    total = np.stack([np.bincount(at, c, len(known)).astype(np.int64) for c in counts])
    word = (known & np.uint64(1 << 8)) == 0
    sums = np.array([total[0][word].sum(), (total[0][word] > 0).sum(), total[1][word].sum()], np.int64)
    out = [(rows[0][0], -1, None, sums.tobytes(), None, None, None)]
    x = 0
    for r, h in zip(rows, hashes, strict=True):
        out.append((r[0], r[1], None, _pair(total[:, at[x:x + len(h)]]), None, None, None))
        x += len(h)
    return _rows(out, SENT)


def _join(batches):
    """Rows of a chunk, in order of bucket -> its tokens with their counts."""
    key, about, parts = None, None, []
    for b in batches:
        for row in zip(*(b.column(i).to_pylist() for i in range(7)), strict=True):
            if row[1] != key:
                if about or parts:
                    yield _joined(about, parts)
                key, about, parts = row[1], None, []
            if row[1] < 0:
                yield _rows([(-1, row[3], None, None, None)], JOINED)
            elif row[0] < 0:
                about = row
                release()
            else:
                parts.append(_unpair(row[3]))
    if about or parts:
        yield _joined(about, parts)


def _joined(about: tuple, parts: list[np.ndarray]) -> pa.RecordBatch:
    hashes, tokens = np.frombuffer(about[5], np.uint64), unsqueeze(about[4], "<u4").astype(np.int64)
    docs = np.frombuffer(about[6], np.int64).reshape(4, -1)
    offsets = np.concatenate([[0], np.cumsum(docs[3])])
    every, word, pair, before = _grams(hashes, tokens, offsets)
    counts = np.concatenate(parts, axis=1)
    if counts.shape[1] != len(every):
        raise RuntimeError("a chunk was cut differently when read again")
    cells = _histogram(counts[1], word, pair, tokens, before, np.repeat(docs[2] == 2, docs[3]))
    return _rows([(about[1], pack_counts(counts[0][word[tokens]]), pack_counts(counts[0][pair]), about[6],
                   cells.tobytes())], JOINED)


def bucket_of(context: np.ndarray) -> np.ndarray:
    """Bucket of a context count: its binary order of magnitude, 0 for none."""
    return np.ceil(np.log2(context + 1)).astype(np.int64)


def _histogram(fit: np.ndarray, word, pair, tokens, before, held: np.ndarray) -> np.ndarray:
    """(bucket, bin of c(vw) / (c(v) c(w)), bin of c(w), number) of the held
    back tokens, by the counts without them; flat int64."""
    at = np.flatnonzero(held)
    c1, c2, c12 = (fit[word[before[at]]], fit[word[tokens[at]]], fit[pair[at]])
    with np.errstate(divide="ignore", invalid="ignore"):
        ratio = np.where(c12 > 0, np.round(BINS * np.log2(c12 / np.maximum(c1 * c2, 1))), NONE)
        single = np.where(c2 > 0, np.round(BINS * np.log2(np.maximum(c2, 1))), NONE)
    cells, n = np.unique(np.stack([bucket_of(c1), ratio, single]).astype(np.int64), axis=1, return_counts=True)
    return np.concatenate([cells, n[None]]).astype(np.int64)


def learn_weights(cells: np.ndarray, n: float, v: float) -> dict[int, np.ndarray]:
    """Weights (bigram, word, uniform) by bucket, by expectation-maximisation
    on the histogram ``cells`` (4, cells)."""
    out = {}
    for b in np.unique(cells[0]).tolist():
        _, ratio, single, number = cells[:, cells[0] == b]
        c2 = np.where(single > NONE, np.exp2(single / BINS), 0.0)
        p2 = np.where(ratio > NONE, np.exp2(ratio / BINS) * c2, 0.0)
        p = np.stack([p2, c2 / max(n, 1), np.full(len(c2), 1 / (v + 1))])
        w = np.array(START if b else (0.0, START[0] + START[1], START[2]))
        for _ in range(ROUNDS):
            share = w[:, None] * p
            share /= share.sum(axis=0)
            w = (share * number).sum(axis=1) / number.sum()
        # a trace of the uniform part keeps every probability above 0
        out[b] = (w + [0, 0, 1e-6]) / (1 + 1e-6)
    return out


def score(docs: DataFrame, learn: Column, hold: Column | None = None) -> DataFrame:
    """(doc_id, n_tokens, n_known, train_tokens, base_score, score) of every
    row; ``learn`` marks the training rows, ``hold`` those of them on which
    the weights are learned (default: a tenth, by hash of doc_id)."""
    hold = F.pmod(F.xxhash64("doc_id"), F.lit(10)) == 0 if hold is None else hold
    kind = F.when(learn & hold, 2).when(learn, 1).otherwise(0).cast("int").alias("kind")
    bits = bucket_bits(docs, BUCKET_WORDS)
    rows = doc_texts(docs, kind)
    sent = rows.mapInArrow(lambda it: _emit(it, bits), SENT)
    added = sent.repartition("bucket").sortWithinPartitions("bucket").mapInArrow(_add, SENT)
    # The texts are read a second time rather than sent through both shuffles.
    # Chunks are named by partition: this branch is the first of the union, so
    # its partitions have the numbers that they have in the stage of ``sent``.
    added = rows.mapInArrow(_describe, SENT).unionByName(added)
    # the totals have no chunk; they stay apart by bucket
    place = F.when(F.col("chunk") < 0, -F.col("bucket") - 2).otherwise(F.col("chunk")).alias("chunk")
    by_chunk = added.select("bucket", place, "hashes", "counts", "codes", "vocab", "docs").repartition("chunk")
    joined = stored(by_chunk.sortWithinPartitions("chunk", "bucket").mapInArrow(_join, JOINED), "lm-counts")
    n, v, n_fit = _sums(joined)
    weights = learn_weights(_cells(joined), n_fit, v)
    default = (np.array(START), np.array((0.0, START[0] + START[1], START[2])))
    table = np.stack([weights.get(b, default[b == 0]) for b in range(65)])

    def scores(batches):
        for b in batches:
            for i in range(b.num_rows):
                counts, pairs, docs = (b.column(k)[i].as_py() for k in range(3))
                yield _scores(unpack_counts(counts), unpack_counts(pairs), np.frombuffer(docs, np.int64).reshape(4, -1),
                              table, n, v)
                release()

    chunks = joined.where("chunk >= 0").select("counts", "pairs", "docs")
    return chunks.mapInArrow(scores, SCORES).withColumn("train_tokens", F.lit(n).cast("long"))


def _sums(joined: DataFrame) -> list[int]:
    """Words, distinct words and words not held back of all buckets."""

    def spread(batches):
        for b in batches:
            sums = np.frombuffer(b"".join(b.column(0).to_pylist()), np.int64).reshape(-1, 3)
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in sums.T.copy()], names=["n", "v", "f"])

    rows = joined.where("chunk < 0").select("counts").mapInArrow(spread, "n long, v long, f long")
    return [int(x or 0) for x in rows.agg(F.sum("n"), F.sum("v"), F.sum("f")).first()]


def _cells(joined: DataFrame) -> np.ndarray:
    """The chunks' histograms added up."""

    def spread(batches):
        for b in batches:
            for cells in b.column(0).to_pylist():
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in np.frombuffer(cells, np.int64).reshape(4, -1)],
                                                 names=["b", "r", "s", "n"])

    cells = joined.where("chunk >= 0").select("cells").mapInArrow(spread, "b long, r long, s long, n long")
    rows = cells.groupBy("b", "r", "s").agg(F.sum("n").alias("n")).orderBy("b", "r", "s").collect()
    return np.array([tuple(r) for r in rows], np.int64).reshape(-1, 4).T


def _scores(c2, c12, docs, table, n: int, v: int) -> pa.RecordBatch:
    """Scores of a chunk's documents by the counts of each token's word and
    bigram.  Every document ends in the end, whose count is the context of
    its first word."""
    offsets = np.concatenate([[0], np.cumsum(docs[3])])
    c1 = np.empty_like(c2)
    c1[1:] = c2[:-1]
    c1[offsets[:-1]] = c2[offsets[1:] - 1]
    w = table[bucket_of(c1)]
    p = w[:, 0] * (c12 / np.maximum(c1, 1)) + w[:, 1] * (c2 / max(n, 1)) + w[:, 2] / (v + 1)
    if n == 0:
        p = np.ones(len(c2))
    base = np.log10((c2 + 1) / (n + v + 1))
    sums = [np.add.reduceat(x, offsets[:-1]) for x in ((c2 > 0).astype(np.int64), base, np.log10(p))]
    return pa.RecordBatch.from_arrays(
        [pa.array(docs[0], mask=docs[1] == 0), pa.array(docs[3]), *map(pa.array, sums)],
        names=["doc_id", "n_tokens", "n_known", "base_score", "score"])
