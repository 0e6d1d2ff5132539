"""Benchmark decontamination by spaced-seed hashing.

A seed mask names the word positions of a window that are hashed; the others
may differ.  Windows of benchmark items and documents with equal hashes under
a mask are joined, and around each hit the two word sequences are compared
along their diagonal: the longest stretch from one equal word to another, of whose
words ``min_share`` are equal, is the overlap.  It counts if it has
``min_words`` words.

Scale: the documents are only mapped, never shuffled.  The benchmark is the
stated query set: it is dealt into blocks of about ``block_bytes`` of text,
and each block in turn is broadcast (so a broadcast never exceeds that, but
for a single longer item) against all documents.

Defined results: words and lower case as in ``words``; null and empty texts
overlap with nothing; items of fewer than ``MIN_ITEM`` words are left out, as
they would mark ordinary prose; items shorter than a window must occur as
they are; per document and item the longest overlap is returned (ties: the
earliest), once per repeated row.
"""

from __future__ import annotations

from fractions import Fraction

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weft.llm.common import doc_texts
from weft.llm.words import Chunk, mix, split_words, word_chunks

# Fixed masks of seven hashed positions.  Together they hit every pattern of 2
# substitutions in 12 words, 3 in 15, 4 in 20 and 5 in 25; a longer stretch with a
# fifth substituted holds such a part, so at 12 or more words of which 4/5 are equal none
# is missed (tested over all patterns).
MASKS = (
    (0, 1, 2, 3, 4, 5, 6),
    (0, 1, 2, 3, 5, 6, 7),
    (0, 1, 4, 6, 7, 8, 9),
    (0, 1, 3, 4, 7, 9, 10),
    (0, 1, 2, 6, 8, 9, 10),
    (0, 1, 3, 6, 8, 10, 11),
    (0, 1, 2, 4, 7, 10, 11),
)
SPAN = 12  # shorter items must occur as they are
SURE_SHARE = Fraction(4, 5)
MIN_ITEM = 5
TABLE_BITS = 22

OVERLAPS = "doc_id long, item_id long, doc_start int, item_start int, n_words int, n_equal int"


def seed_hashes(words: np.ndarray, mask: tuple[int, ...]) -> np.ndarray:
    """Masked hash of the window at each position of a word-hash array."""
    size = len(words) - mask[-1]
    if size <= 0:
        return np.empty(0, np.uint64)
    out = np.full(size, len(mask), np.uint64)
    for o in mask:
        out *= np.uint64(0x9E3779B97F4A7C15)
        out += words[o:o + size]
    return mix(out)


def _inside(offsets: np.ndarray, size: int, span: int) -> np.ndarray:
    """True at positions whose window of ``span`` words ends in its text."""
    left = np.repeat(offsets[1:], np.diff(offsets))[:size] - np.arange(size)
    return left >= span


def masks_for(min_words: int, share: Fraction) -> tuple[tuple[int, ...], ...]:
    """Masks that hit every stretch of ``min_words`` words of which ``share``
    are equal: MASKS, and for a weaker demand than theirs a plain run."""
    if min_words >= SPAN and share >= SURE_SHARE:
        return MASKS
    # a long stretch holds a part of these sizes with the share; k substitutions leave k + 1 runs
    gaps = ((n, int((1 - share) * n)) for n in range(max(1, min_words), 2 * max(1, min_words)))
    run = min(-(-(n - k) // (k + 1)) for n, k in gaps)
    return (*MASKS, tuple(range(max(1, min(run, SPAN)))))


class Seeds:
    """The masked windows of one block of benchmark items."""

    def __init__(self, item_ids: list, texts: list, masks: tuple[tuple[int, ...], ...] = MASKS):
        self.item_ids = item_ids
        self.offsets, self.codes, self.vocab = split_words(pa.array(texts, pa.string()))
        n = np.diff(self.offsets)
        rng = np.random.default_rng(9)
        # the last entry stands for every word that no item has
        self.hashes = rng.integers(1, 1 << 63, len(self.vocab) + 1, dtype=np.uint64)
        words = self.hashes[self.codes]
        item = np.repeat(np.arange(len(n)), n)
        found = []
        for mask in masks:
            h = seed_hashes(words, mask)
            at = np.flatnonzero(_inside(self.offsets, len(h), mask[-1] + 1) & (n[item[:len(h)]] >= SPAN))
            found.append((mask, h[at], at))
        for size in range(MIN_ITEM, SPAN):  # items shorter than a window
            mask = tuple(range(size))
            at = self.offsets[:-1][n == size]
            if len(at):
                found.append((mask, seed_hashes(words, mask)[at], at))
        self.masks = []
        for mask, h, at in found:
            order = np.argsort(h, kind="stable")
            table = np.zeros(1 << TABLE_BITS, bool)
            table[(h >> np.uint64(64 - TABLE_BITS)).astype(np.int64)] = True
            self.masks.append((mask, h[order], at[order], item[at[order]], table))

    def hits(self, chunk: Chunk, words: np.ndarray) -> np.ndarray:
        """Distinct (row, item, diagonal) of equal masked windows."""
        got = []
        row = np.repeat(np.arange(len(chunk.offsets) - 1), chunk.lengths())
        for mask, sorted_h, at, item, table in self.masks:
            h = seed_hashes(words, mask)
            p = np.flatnonzero(table[(h >> np.uint64(64 - TABLE_BITS)).view(np.int64)])
            low, high = (np.searchsorted(sorted_h, h[p], side) for side in ("left", "right"))
            some = (high > low) & (p + mask[-1] < chunk.offsets[row[p] + 1])
            p, low, n = p[some], low[some], (high - low)[some]
            k = np.repeat(low - np.cumsum(n) + n, n) + np.arange(n.sum())
            p = np.repeat(p, n)
            # diagonal: document position less item position, each in its own text
            diagonal = (p - chunk.offsets[row[p]]) - (at[k] - self.offsets[item[k]])
            got.append(np.stack([row[p], item[k], diagonal], axis=1))
        return np.unique(np.concatenate(got), axis=0) if got else np.empty((0, 3), np.int64)

    def overlaps(self, chunk: Chunk, min_words: int, min_share: float) -> list[tuple]:
        """(row, item, doc_start, item_start, n_words, n_equal), the longest
        overlap of each row and item."""
        known = pc.index_in(chunk.vocab.cast(self.vocab.type), self.vocab).fill_null(len(self.vocab)).to_numpy()
        doc = known[chunk.codes]
        share = Fraction(str(min_share))  # 0.8 is 4/5, as 4 of 5 words count
        best: dict[tuple[int, int], tuple] = {}
        for row, item, diagonal in self.hits(chunk, self.hashes[doc]).tolist():
            d0, d1 = chunk.offsets[row], chunk.offsets[row + 1]
            i0, i1 = self.offsets[item], self.offsets[item + 1]
            start = max(0, -diagonal)
            stop = min(i1 - i0, d1 - d0 - diagonal)
            equal = doc[d0 + diagonal + start:d0 + diagonal + stop] == self.codes[i0 + start:i0 + stop]
            at, n = longest_stretch(equal, share)
            same = int(equal[at:at + n].sum())
            if n < min(min_words, int(i1 - i0)):
                continue
            found = (-n, -same, int(diagonal + start + at), int(start + at))
            if found < best.get((row, item), (1,)):
                best[row, item] = found
        return [(r, i, d, s, -n, -e) for (r, i), (n, e, d, s) in sorted(best.items())]


def longest_stretch(equal: np.ndarray, share: Fraction) -> tuple[int, int]:
    """(start, length) of the longest stretch that starts and ends with an
    equal word and of whose words ``share`` are equal; of those the one with
    the most equal words, then the first."""
    ends = np.flatnonzero(equal) + 1
    if not len(ends):
        return 0, 0
    # a stretch has the share where its sum is not below 0
    up, down = share.denominator - share.numerator, -share.numerator
    total = np.concatenate([[0], np.cumsum(np.where(equal, up, down))])
    low = np.minimum.accumulate(np.where(equal, total[:-1], np.iinfo(np.int64).max))
    starts = np.searchsorted(-low, -total[ends])  # the first that is low enough
    n = ends - starts
    count = np.concatenate([[0], np.cumsum(equal)])
    k = np.lexsort((starts, count[starts] - count[ends], -n))[0]
    return int(starts[k]), int(n[k])


def seed_blocks(benchmark: DataFrame, block_bytes: int, masks: tuple[tuple[int, ...], ...] = MASKS):
    """The benchmark's items as Seeds of about ``block_bytes`` of text each."""
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.col("text"))
    size = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = max(1, -(-size // block_bytes))
    dealt = items.withColumn("_block", F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)))
    for k in range(blocks):
        rows = dealt.where(F.col("_block") == k).orderBy("item_id", "text").collect()
        yield Seeds([r.item_id for r in rows], [r.text for r in rows], masks)


def overlaps(docs: DataFrame, benchmark: DataFrame, min_words: int = 13, min_share: float = 0.8,
             block_bytes: int = 8 << 20) -> DataFrame:
    """(doc_id, item_id, doc_start, item_start, n_words, n_equal): the longest
    overlap of each document with each item, in words."""
    sc = docs.sparkSession.sparkContext
    out = None
    for seeds in seed_blocks(benchmark, block_bytes, masks_for(min_words, Fraction(str(min_share)))):
        shared = sc.broadcast(seeds)

        def find(batches, shared=shared):
            seeds = shared.value
            for c in word_chunks(batches):
                got = seeds.overlaps(c, min_words, min_share)
                rows = pa.array([g[0] for g in got], pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [c.rows.column(0).combine_chunks().take(rows),
                     pa.array([seeds.item_ids[g[1]] for g in got], pa.int64()),
                     *(pa.array([g[k] for g in got], pa.int32()) for k in range(2, 6))],
                    names=["doc_id", "item_id", "doc_start", "item_start", "n_words", "n_equal"])

        part = doc_texts(docs).mapInArrow(find, OVERLAPS)
        out = part if out is None else out.unionByName(part)
    return out


def without_overlaps(docs: DataFrame, benchmark: DataFrame, min_words: int = 13, min_share: float = 0.8,
                     block_bytes: int = 8 << 20) -> DataFrame:
    """The documents that overlap with no benchmark item, all columns kept."""
    sc = docs.sparkSession.sparkContext
    out = docs
    for seeds in seed_blocks(benchmark, block_bytes, masks_for(min_words, Fraction(str(min_share)))):
        shared = sc.broadcast(seeds)

        def clean(batches, shared=shared):
            for c in word_chunks(batches):
                keep = np.ones(c.rows.num_rows, bool)
                keep[[g[0] for g in shared.value.overlaps(c, min_words, min_share)]] = False
                yield from c.rows.filter(pa.array(keep)).to_batches()

        out = out.mapInArrow(clean, out.schema)
    return out
