"""Ids by pieces of the word pattern: equal to the library's, and each piece is encoded once."""

import random

import public_tokenizers
from recordlens.llm.transducer import Pieces, Transducer

PATH = public_tokenizers.path("byte_bpe_50k.json")


def test_pieces_met_again_are_not_encoded_again(monkeypatch):
    machine = Transducer(PATH)
    rnd = random.Random(1)
    words = [f"{rnd.choice(['wort', 'où', '日本', 'don\'t', '12', '😀', ' \n '])}{k % 40}" for k in range(400)]
    texts = [" ".join(rnd.choices(words, k=300)) for _ in range(40)]
    want = [list(e.ids) for e in machine.library.encode_batch(texts, add_special_tokens=False)]
    asked = []
    real = Pieces._bpe
    monkeypatch.setattr(Pieces, "_bpe", lambda self, piece: asked.append(piece) or real(self, piece))
    for _ in range(2):
        assert [x.tolist() for x in machine.encode(texts)] == want
    assert asked and len(asked) == len(set(asked))


def test_generations_lose_nothing():
    machine = Transducer(PATH)
    machine.pieces.most = 5
    texts = ["one two three", "", "two four\n\n five  six's", "seven one", "ééé où ", "x" * 500, "one two"] * 3
    for at in range(len(texts)):
        part = texts[at : at + 2]
        assert [x.tolist() for x in machine.encode(part)] == [list(e.ids) for e in machine.library.encode_batch(part, add_special_tokens=False)]
    assert len(machine.pieces) < 20
