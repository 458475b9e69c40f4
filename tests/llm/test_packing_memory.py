import numpy as np

from revlens.llm import packing

TEXTS = ["alpha beta gamma, delta", "one two three", "alpha, Beta one gamma,"]


def test_words_of_a_full_memory_are_taken_back(monkeypatch):
    monkeypatch.setattr(packing, "CACHE", 6)
    monkeypatch.setattr(packing, "TOGETHER", 1)  # one text at a time: the memory is full after the second
    enc, learned = packing.Encoder(packing.vocabulary("word_bpe_49k.json")), []
    plain = enc._letter_words
    monkeypatch.setattr(enc, "_letter_words", lambda words: (learned.extend(words), plain(words)))
    for text, raw in zip(TEXTS, enc.encode(TEXTS), strict=True):
        assert np.frombuffer(raw, "<u4").tolist() == enc.tok.encode(text, add_special_tokens=False).ids
    assert sorted(learned) == ["alpha", "beta", "delta", "gamma", "one", "three", "two"]
