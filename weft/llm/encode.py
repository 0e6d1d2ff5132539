"""Token ids of whole texts by a public tokenizer file, cached by text piece.

A text is cut where a non-blank character is followed by a space or line
feed, and between a letter or digit and a full stop or comma.  No pre-token
of the supported tokenizers crosses such a border, so the ids of the pieces,
joined, are the ids of the text.  Pieces repeat heavily: each is encoded once
and found in an Arrow array of known pieces afterwards, so only new ones
become Python strings.  Texts with other blanks or runs of blanks, where the
border rule might not hold, are encoded whole.  Where blanks are dropped, a
text is cut at them first and only its distinct words at the other borders;
if the tokenizer lower-cases, words of ASCII alone are known in lower case.
"""

from __future__ import annotations

import json
import os
from array import array

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

# Blanks other than space and LF in any definition in use, the mark that cuts
# texts here, and runs of blanks.
_WHOLE = ("[\x01\t\r\x0b\x0c\x1c-\x1f\u0085\u00a0\u1680\u180e\u2000-\u200b\u2028\u2029\u202f\u205f\u3000\ufeff]"
          "|[ \n][ \n]")
_BEFORE_POINT = "([A-Za-z0-9\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff])([.,])"

CACHE_PIECES = 600_000  # of some 40 bytes
STEP_BYTES = 4 << 20  # of text encoded at once
PIECE_CHARS = 48
GROUP = 50
MARK = "\x01"  # of no piece: texts that have it are encoded whole

_made: dict[tuple[str, bool], "Encoder"] = {}


class Encoder:
    """``keeps_blanks``: a blank belongs to the token behind it (byte-level
    BPE); else the tokenizer drops blanks."""

    def __init__(self, path: str, keeps_blanks: bool, cache_pieces: int = CACHE_PIECES):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True  # their strings are ordinary text
        self.keeps_blanks, self.cache_pieces = keeps_blanks, cache_pieces
        norm = json.loads(self.tokenizer.to_str())["normalizer"] or {}
        self.lowers = any(x["type"] == "Lowercase" for x in norm.get("normalizers", [norm]) if x)
        marked = [self.tokenizer.encode(x, add_special_tokens=False).ids for x in (MARK, f"a {MARK} a")]
        # id of the mark, if it is one token and stays so between blanks
        self.mark = marked[0][0] if not keeps_blanks and len(marked[0]) == 1 and marked[1][1:-1] == marked[0] else None
        # pieces met before; ids[starts[i]:starts[i + 1]] are those of pieces[i]
        self.pieces = pa.array([""], pa.large_string())
        self.starts, self.ids = np.zeros(2, np.int64), np.empty(0, np.uint32)

    def _whole(self, texts: list[str]) -> list[bytes]:
        return [array("I", e.ids).tobytes() for e in self.tokenizer.encode_batch(texts, add_special_tokens=False)]

    def _new(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(sizes, ids) of the pieces, encoded in runs, as one text."""
        if self.mark is not None:
            by = f" {MARK} "
            runs = [by.join(pieces[i:i + GROUP]) + by for i in range(0, len(pieces), GROUP)]
            found = self.tokenizer.encode_batch_fast(runs, add_special_tokens=False)
            ids = np.frombuffer(b"".join(array("I", e.ids).tobytes() for e in found), np.uint32)
            ends = np.flatnonzero(ids == self.mark)
            if len(ends) == len(pieces):
                return np.diff(ends, prepend=-1) - 1, np.delete(ids, ends)
        blobs = self._by_offsets(pieces)
        return np.fromiter(map(len, blobs), np.int64, len(blobs)) // 4, np.frombuffer(b"".join(blobs), np.uint32)

    def _by_offsets(self, pieces: list[str]) -> list[bytes]:
        """Ids of each piece; pieces that begin with a blank (or all, where
        blanks are dropped) are encoded in runs, as one text."""
        out: dict[str, bytes] = {}
        joins = [p for p in pieces if p[0] == " " and len(p) > 1] if self.keeps_blanks else pieces
        if self.keeps_blanks:
            rest = [p for p in pieces if p[0] != " " or len(p) == 1]
            out.update(zip(rest, self._whole(rest), strict=True))
        by = "" if self.keeps_blanks else " "
        runs = [joins[i:i + GROUP] for i in range(0, len(joins), GROUP)]
        for run, e in zip(runs, self.tokenizer.encode_batch([by.join(r) for r in runs], add_special_tokens=False),
                          strict=True):
            ids = np.array(e.ids, np.uint32)
            at = np.array([x for x, _ in e.offsets], np.int64)
            ends = np.cumsum([len(p) + len(by) for p in run])
            cut = np.searchsorted(at, ends, side="left").tolist()
            for p, x, y in zip(run, [0, *cut[:-1]], cut, strict=True):
                out[p] = ids[x:y].tobytes()
        return [out[p] for p in pieces]

    def _pieces(self, text: pa.Array) -> pa.LargeListArray:
        if not self.keeps_blanks:
            return pc.ascii_split_whitespace(text)
        for blank in " \n":
            text = pc.replace_substring(text, blank, "\x01" + blank)
        return pc.split_pattern(pc.replace_substring_regex(text, _BEFORE_POINT, "\\1\x01\\2"), "\x01")

    def _known(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(start, number) of each word's ids in the ids given third; words
        not met before are encoded and, unless long, remembered."""
        at = np.array(pc.fill_null(pc.index_in(words, value_set=self.pieces), -1), np.int64)
        missing = np.flatnonzero(at < 0)
        starts, ids, kept = self.starts, self.ids, len(self.pieces)
        if len(missing):
            short = np.asarray(pc.less_equal(pc.utf8_length(words), PIECE_CHARS))[missing].astype(bool)
            missing = np.concatenate([missing[short], missing[~short]])
            new = words.take(pa.array(missing))
            sizes, got = self._new(new.to_pylist())
            at[missing] = kept + np.arange(len(missing))
            starts = np.concatenate([starts, starts[-1] + np.cumsum(sizes)])
            ids = np.concatenate([ids, got])
            kept += int(short.sum())
            self.pieces = pa.concat_arrays([self.pieces, new.slice(0, int(short.sum()))])
            self.starts, self.ids = starts[:kept + 1], ids[:starts[kept]]
        first, size = starts[at], starts[at + 1] - starts[at]
        if kept > self.cache_pieces:  # go on with those of this call
            held = np.unique(np.append(at[at < kept], 0))[:self.cache_pieces]
            sizes = np.diff(self.starts)[held]
            ends = np.concatenate([[0], np.cumsum(sizes)])
            self.ids = self.ids[np.arange(ends[-1]) + np.repeat(self.starts[held] - ends[:-1], sizes)]
            self.pieces, self.starts = self.pieces.take(pa.array(held)), ends
        return first, size, ids

    def _words(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """``_known`` of words between blanks, by their parts."""
        if self.lowers:  # other letters may compose differently in lower case
            words = pc.if_else(pc.string_is_ascii(words), pc.ascii_lower(words), words)
        lists = pc.split_pattern(pc.replace_substring_regex(words, _BEFORE_POINT, f"\\1{MARK}\\2"), MARK)
        parts = lists.values.dictionary_encode()
        codes = parts.indices.to_numpy()
        first, size, known = self._known(parts.dictionary)
        ids, ends = _gathered(first[codes], size[codes], known)
        offsets = ends[lists.offsets.to_numpy()]
        return offsets[:-1], np.diff(offsets), ids

    def encode(self, text: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(offsets, ids) of a text array; null counts as empty."""
        text = pc.fill_null(text.cast(pa.large_string()), "")
        odd = pc.match_substring_regex(text, _WHOLE).to_numpy(zero_copy_only=False)
        plain = pc.if_else(pa.array(odd), "", text) if odd.any() else text
        lists = self._pieces(plain)
        words = lists.values.dictionary_encode()
        codes = words.indices.to_numpy()
        first, size, known = (self._known if self.keeps_blanks else self._words)(words.dictionary)
        ids, ends = _gathered(first[codes], size[codes], known)
        offsets = ends[lists.offsets.to_numpy()]
        if odd.any():
            at = np.flatnonzero(odd)
            whole = dict(zip(at.tolist(), self._whole(text.take(pa.array(at)).to_pylist()), strict=True))
            parts = [np.frombuffer(whole[i], np.uint32) if i in whole else ids[offsets[i]:offsets[i + 1]]
                     for i in range(len(text))]
            offsets = np.concatenate([[0], np.cumsum([len(x) for x in parts])]).astype(np.int64)
            ids = np.concatenate(parts)
        return offsets, ids

    def encode_closed(self, text: pa.Array, end_id: int) -> tuple[np.ndarray, np.ndarray]:
        """``encode`` with ``end_id`` after every text."""
        offsets, ids = self.encode(text)
        closed = np.full(len(ids) + len(text), end_id, np.uint32)
        keep = np.ones(len(closed), bool)
        offsets = offsets + np.arange(len(offsets))
        keep[offsets[1:] - 1] = False
        closed[keep] = ids
        return offsets, closed


def _gathered(first: np.ndarray, size: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The runs of ``ids`` of the given starts and sizes, and where each ends."""
    ends = np.concatenate([[0], np.cumsum(size)])
    return ids[np.arange(ends[-1]) + np.repeat(first - ends[:-1], size)], ends


def encoder(path: str, keeps_blanks: bool, cache_pieces: int = CACHE_PIECES) -> Encoder:
    """One encoder per Python worker and file."""
    if (path, keeps_blanks) not in _made:
        _made[path, keeps_blanks] = Encoder(path, keeps_blanks, cache_pieces)
    return _made[path, keeps_blanks]
