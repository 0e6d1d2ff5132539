"""Words are known by their lower-case parts; ids are those of whole texts."""

import numpy as np
import pyarrow as pa
import pytest

from weft.llm.encode import Encoder

ODD = ["J̌ H̱ T̈ W̊ Y̊.", "A.́b A,́ x, İ, İ.", "x\x01y a", "it's I'LL, we'Re. don'T.",
       "a..b,,c 3.14,5 ...", "", None, " a b. ", "ǅ ß ẞ. K.", "<|endoftext|> <|startoftext|>.", "你好. naïve, É.",
       "ΣΑΣ. Σ,", "\x00 a.\x00 b \x7f.", "  lead", "A.\nB,\nc"]


@pytest.fixture
def words():
    public_tokenizers = pytest.importorskip("public_tokenizers")
    return lambda *more: Encoder(public_tokenizers.path("word_bpe_49k.json"), False, *more)


@pytest.mark.parametrize("known", [3, 1000])
def test_ids_are_those_of_whole_texts(words, known):
    rng = np.random.default_rng(7)
    letters = np.array(list("aAjJ \n.,'sStT19̌́éİΣ-_\x02"))
    texts = ODD + ["".join(rng.choice(letters, n)) for n in rng.integers(1, 60, 500)]
    enc = words(known)
    for _ in range(2):
        offsets, ids = enc.encode(pa.array(texts, pa.string()))
        for i, text in enumerate(texts):
            want = enc.tokenizer.encode(text or "", add_special_tokens=False).ids
            assert ids[offsets[i]:offsets[i + 1]].tolist() == want, text


def test_case_and_points_make_no_new_words(words):
    enc = words()
    enc.encode(pa.array(["Word word. WORD, word", "É word."]))
    assert sorted(enc.pieces.to_pylist()) == ["", ",", ".", "word", "É"]


def test_pieces_are_split_by_offsets_where_there_is_no_mark(words):
    plain, marked = words(), words()
    plain.mark = None
    texts = pa.array(["It's one, two. Threé 4.5"])
    assert plain.encode(texts)[1].tolist() == marked.encode(texts)[1].tolist()
