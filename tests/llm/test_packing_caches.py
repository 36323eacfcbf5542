"""The word caches of the packing stage."""

import public_tokenizers as P

from loomgraph.llm import packing


def test_emptied_caches_give_the_same_ids():
    bpe = packing.WordBPE(P.path("word_bpe_49k.json"))
    text = "don't stop, naïve 中文 words 12345"
    before = bpe.encode(text).tolist()
    bpe.words["plain"], bpe.words.older = b"x", {"old": b"y"}
    bpe.forget()
    assert not any(len(c) or c.older for c in (bpe.words, bpe.pieces, bpe.others))
    assert bpe.encode(text).tolist() == before
