"""The suffix array of words and what is done once for each text."""

import random

import numpy as np
import public_tokenizers
import pytest

from newscorpus.llm import pieces

MODEL = public_tokenizers.path("piece_bpe_32k.model")


def test_texts_are_cut_once_and_long_lists_searched_by_their_heads(monkeypatch):
    v = pieces.Vocabulary(MODEL)
    cut, words = [], pieces._words
    monkeypatch.setattr(pieces, "_words", lambda text: cut.append(text) or words(text))
    monkeypatch.setattr(pieces, "CACHE_WORDS", 3)
    sorts, argsort = [], np.argsort
    monkeypatch.setattr(np, "argsort", lambda *a, **k: sorts.append(1) or argsort(*a, **k))
    texts = ["the news of the day", "", "news in the evening", "the day"]
    first = [ids.tolist() for ids in pieces._encode_texts(texts, v)]
    assert cut == texts
    # one last sort; doubling from single characters made it after four others
    assert len(sorts) == 1
    assert len(v.known) == 3  # words beyond the bound are forgotten and learnt again
    assert [ids.tolist() for ids in pieces._encode_texts(texts, v)] == first


@pytest.mark.parametrize("alphabet", ["ab", "abcdefgh\n▁", "".join(map(chr, range(0x3041, 0x4E41)))])
def test_heads_against_plain_strings(alphabet):
    rng = random.Random(len(alphabet))
    text = "".join(rng.choice(alphabet) for _ in range(900))
    codes = np.array(list(map(ord, text)), np.int64)
    for depth in (1, 5, 16, 70):
        order = pieces.suffix_array(codes, depth).tolist()
        assert sorted(order) == list(range(len(text)))
        heads = [text[i : i + depth] for i in order]
        assert heads == sorted(heads)
    v = pieces.Vocabulary(MODEL)
    low = [rng.randrange(len(text)) for _ in range(300)]
    v.pieces = sorted({text[i : i + rng.randint(1, v.longest)] for i in low} | {"zq", "a😀", alphabet[0] * v.longest})
    v.lengths = np.array(list(map(len, v.pieces)))
    v.codes = np.array([[*map(ord, p), *[0] * (v.longest - len(p))] for p in v.pieces])
    order = pieces.suffix_array(codes, v.longest)
    for p, lo, hi in zip(v.pieces, *pieces.occurrences(codes, order, v)):
        assert sorted(order[lo:hi].tolist()) == [i for i in range(len(text)) if text.startswith(p, i)]
