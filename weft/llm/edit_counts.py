"""Edit-aware token counting with a segment tree per document.

``build_trees`` cuts each text into leaves at borders that no pre-token
crosses (a non-blank character before an ASCII blank) and counts each leaf's
tokens.  ``apply_edits`` finds the leaves that an edit touches by descending
the sums, joins them, takes a neighbour in where the edit made the border
unsafe, encodes that region alone, and updates the sums on the way up.  The
leaf sizes are the tree's stored form, so a later batch of edits goes on from
them.

Scale: both are maps over documents; edits arrive as a column of the
document's row, and the k-th edits of a batch of documents are encoded
together.

Defined results: null text is empty; an edit is (pos, del, ins) in code
points of the text as the edits before it left it; positions and lengths are
clipped to the text, a null pos is the start, a null del 0, a null ins empty;
null edits are none; repeated rows are counted each.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weft.llm.encode import STEP_BYTES, encoder
from weft.llm.words import table_chunks

LEAF_CHARS = 400
# any blank, in any definition in use
BLANK = " \t\n\r\x0b\x0c\x1c-\x1f\u0085  ᠎ -​    　﻿"
_BORDER = re.compile(f"(?<=[^{BLANK}])(?=[ \n])")
_BLANK = re.compile(f"[{BLANK}]")

TREES = "doc_id long, text string, edits {edits}, leaf_chars array<int>, leaf_tokens array<int>"
EDITS = "array<struct<pos:int,del:int,ins:string>>"
EDITED = ("doc_id long, text string, leaf_chars array<int>, leaf_tokens array<int>, n_tokens long, "
          "edited_tokens long, encoded_chars long")


def leaves_of(text: str) -> list[str]:
    """The text in leaves of about LEAF_CHARS characters (at least one)."""
    out, at = [], 0
    while len(text) - at > 2 * LEAF_CHARS:
        border = _BORDER.search(text, at + LEAF_CHARS)
        if not border:
            break
        out.append(text[at:border.start()])
        at = border.start()
    out.append(text[at:])
    return out


def safe(left: str, right: str) -> bool:
    """Whether the border between two neighbouring texts may stay."""
    return not left or not right or (right[0] in " \n" and not _BLANK.match(left[-1]))


class Tree:
    """Sums of characters and tokens over a document's leaves."""

    def __init__(self, leaves: list[str], tokens: list[int]):
        self.leaves, self.n = leaves, len(leaves)
        self.width = 1 << (self.n - 1).bit_length()
        pad = [0] * (self.width - self.n)
        self.chars = [0] * self.width + [len(x) for x in leaves] + pad
        self.tokens = [0] * self.width + list(tokens) + pad
        for i in range(self.width - 1, 0, -1):
            self._sum(i)

    def _sum(self, i: int) -> None:
        self.chars[i] = self.chars[2 * i] + self.chars[2 * i + 1]
        self.tokens[i] = self.tokens[2 * i] + self.tokens[2 * i + 1]

    def find(self, at: int) -> tuple[int, int]:
        """(leaf, place in it) of character ``at``; the end is in the last leaf."""
        at = min(at, self.chars[1])
        i = 1
        while i < self.width:
            i *= 2
            if at >= self.chars[i] and (at > self.chars[i] or self.chars[i + 1]):
                at -= self.chars[i]
                i += 1
        return min(i - self.width, self.n - 1), at

    def put(self, leaf: int, text: str, tokens: int) -> None:
        self.leaves[leaf] = text
        i = leaf + self.width
        self.chars[i], self.tokens[i] = len(text), tokens
        while i > 1:
            i //= 2
            self._sum(i)

    def edit(self, pos: int, size: int, text: str) -> tuple[int, str]:
        """Apply an edit; (leaf, its new text), whose tokens are not known
        yet.  The other leaves of the region are empty now."""
        pos = max(0, min(pos, self.chars[1]))
        first, start = self.find(pos)
        last, stop = self.find(pos + max(0, size))
        middle = self.leaves[first][:start] + text + self.leaves[last][stop:]
        gone = list(range(first + 1, last + 1))
        left, right = first - 1, last + 1
        while True:  # boundary context
            while left >= 0 and not self.leaves[left]:
                left -= 1
            while right < self.n and not self.leaves[right]:
                right += 1
            if left >= 0 and (not middle or not safe(self.leaves[left], middle)):
                middle, gone, left = self.leaves[left] + middle, [*gone, left], left - 1
            elif right < self.n and not safe(middle, self.leaves[right]):
                middle, gone, right = middle + self.leaves[right], [*gone, right], right + 1
            else:
                break
        for leaf in gone:
            self.put(leaf, "", 0)
        keep = min([first, *gone])
        if keep != first:
            self.put(first, "", 0)
        return keep, middle


def build_trees(docs: DataFrame, tokenizer: str, edits: Column) -> DataFrame:
    """TREES rows: the texts with their leaves' sizes, and ``edits``."""

    def build(batches):
        enc = encoder(tokenizer, True)
        for t in table_chunks(batches, chunk_bytes=STEP_BYTES):
            leaves = [leaves_of(x or "") for x in t.column("text").to_pylist()]
            offsets, _ = enc.encode(pa.array([x for one in leaves for x in one], pa.large_string()))
            tokens = np.diff(offsets).astype(np.int32)
            chars = np.fromiter((len(x) for one in leaves for x in one), np.int32, len(tokens))
            at = pa.array(np.concatenate([[0], np.cumsum([len(x) for x in leaves])]).astype(np.int32))
            t = t.append_column("leaf_chars", pa.ListArray.from_arrays(at, pa.array(chars)))
            yield from t.append_column("leaf_tokens", pa.ListArray.from_arrays(at, pa.array(tokens))).to_batches()

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", edits.cast(EDITS).alias("edits"))
    return rows.mapInArrow(build, TREES.format(edits=EDITS))


def apply_edits(trees: DataFrame, tokenizer: str) -> DataFrame:
    """EDITED rows of TREES rows: the edited text with its tree, the tokens
    before and after, and how many characters were encoded for that."""

    def apply(batches):
        enc = encoder(tokenizer, True)
        for t in table_chunks(batches, chunk_bytes=STEP_BYTES):
            rows = [t.column(c).to_pylist() for c in ("text", "edits", "leaf_chars", "leaf_tokens")]
            held, edits = [], []
            for text, todo, chars, tokens in zip(*rows, strict=True):
                ends = np.cumsum(chars).tolist()
                held.append(Tree([(text or "")[a:b] for a, b in zip([0, *ends[:-1]], ends, strict=True)], tokens))
                edits.append(todo or [])
            before = [x.tokens[1] for x in held]
            encoded = np.zeros(len(held), np.int64)
            for k in range(max(map(len, edits), default=0)):
                some = [i for i, e in enumerate(edits) if len(e) > k and e[k] is not None]
                new = [held[i].edit(edits[i][k]["pos"] or 0, edits[i][k]["del"] or 0, edits[i][k]["ins"] or "")
                       for i in some]
                offsets, _ = enc.encode(pa.array([x for _, x in new], pa.large_string()))
                for i, (leaf, text), n in zip(some, new, np.diff(offsets).tolist(), strict=True):
                    held[i].put(leaf, text, n)
                    encoded[i] += len(text)
            kept = [[j for j in range(x.n) if x.leaves[j]] or [0] for x in held]
            columns = {
                "doc_id": t.column("doc_id").combine_chunks(),
                "text": pa.array(["".join(x.leaves) for x in held], pa.string()),
                "leaf_chars": pa.array([[len(x.leaves[j]) for j in k] for x, k in zip(held, kept, strict=True)],
                                       pa.list_(pa.int32())),
                "leaf_tokens": pa.array([[x.tokens[x.width + j] for j in k] for x, k in zip(held, kept, strict=True)],
                                        pa.list_(pa.int32())),
                "n_tokens": pa.array(before, pa.int64()),
                "edited_tokens": pa.array([x.tokens[1] for x in held], pa.int64()),
                "encoded_chars": pa.array(encoded),
            }
            yield pa.RecordBatch.from_arrays(list(columns.values()), names=list(columns))

    return trees.mapInArrow(apply, EDITED)


def sample_edits() -> Column:
    """Three edits of every text, by its own characters: a replacement after
    a third, an insertion at the start, a deletion after two thirds."""
    n = F.coalesce(F.length("text"), F.lit(0))

    def one(pos: Column, size: int, ins: Column) -> Column:
        return F.struct(pos.cast("int").alias("pos"), F.lit(size).alias("del"), ins.alias("ins"))

    return F.array(one(F.floor(n / 3), 20, F.reverse(F.left(F.coalesce("text", F.lit("")), F.lit(30)))),
                   one(F.lit(0), 0, F.lit("Edited copy.\n")),
                   one(F.floor(2 * n / 3), 25, F.lit("")))
