"""Spans take their words straight from the text, and cut it as ``sentences`` does."""

import random

from tallyline.llm import sentence_spans as spans

PARTS = ["Σ", "ΑΣ.Β", "a", "b, c", "İx", ". ", "\n", "! ", "word", "Über", " ", "\x1c", "; ", "foo|bar", "..", "?a", " "]


def test_words_are_those_of_the_sentences():
    pick = random.Random(5)
    texts = ["".join(pick.choice(PARTS) + pick.choice(["", " "]) for _ in range(pick.randint(0, 120))) for _ in range(400)]
    for text in ["", " ", "\n", *texts]:
        words = [s.lower().split() for s in spans.sentences(text)]
        joined, counts = spans._joined(text)
        assert joined == [" ".join(w) for w in words]
        assert counts.tolist() == [sum(map(len, words[:i])) for i in range(len(words) + 1)]
        assert "".join(spans.sentences(text)) == text


def test_words_are_split_off_once(monkeypatch):
    text = "one two three four five six seven eight nine ten eleven twelve thirteen, fourteen. Fifteen sixteen."
    want = spans._joined(text)[0]
    monkeypatch.setattr(spans, "sentences", lambda _: 1 / 0)
    assert spans._joined(text)[0] == want
