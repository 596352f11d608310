"""Repeated passages found by brute force against what the sentence spans remove."""

import random

from tallyline.llm import sentence_spans

R = random.Random(11)


def words(n, marks=0.0):
    return " ".join("".join(R.choice("abcdefgh") for _ in range(6)) + (R.choice([".", ",", "!"]) if R.random() < marks else "") for _ in range(n))


def test_every_repeated_passage_is_removed(spark):
    texts = []
    for marks in (0.0, 0.03, 0.1, 0.3):
        for n in (50, 60, 90):
            passage = words(n, marks)
            # Both ends of the passage fall inside sentences.
            texts += [f"{words(30, marks)} {passage} {words(30, marks)}", f"{words(5, marks)} {passage} {words(60, marks)}"]
    texts += ["the a " * 40 + words(9), words(9) + " " + "the a " * 40]
    a, b, c = (words(n) + "." for n in (12, 12, 3))
    texts += [f"{words(9)}. {a} {b} {c} {words(9)}.", f"{words(15)}. {a} {b} {c} {words(7)}."]
    tail = len(texts) - 1
    texts += [words(80)] * 2 + ["one short text"] * 2 + ["two lines.\nmore"] * 2
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    removed = {r.doc_id: set(r.removed) for r in sentence_spans.removals(docs, ending=True).collect()}
    kept = {r.doc_id: r.text for r in sentence_spans.deduplicated(docs).collect()}
    seen, hit = {}, 0
    for d, text in enumerate(texts):
        gone = [i in removed.get(d, ()) for i, s in enumerate(sentence_spans.sentences(text)) for _ in s.split()]
        low = text.lower().split()
        assert len(gone) == len(low)
        for i in range(len(low) - 49):
            run = tuple(low[i:i + 50])
            if run in seen:
                assert sum(gone[i:i + 50]) >= 26, (d, i)
                hit += 1
            seen.setdefault(run, d)
    assert hit > 100
    assert not any(x in kept[tail] for x in (a, b, c))
    assert all(kept[d] == "" and kept[d - 1] == texts[d - 1] for d in range(tail + 2, len(texts), 2))


def test_cuts_leave_no_gaps():
    for text in ("  x " * 30, words(100) + "\n\n " + words(50), "\t".join(words(40).split()), " \n", "a,b;" * 40):
        assert "".join(sentence_spans.sentences(text)) == text


def test_equal_runs_of_sentences_hash_alike_and_others_do_not():
    """Whatever stands before them."""
    body = [words(8) + "." for _ in range(60)]
    seen = {}
    for lead in ("", words(3) + ". ", words(30) + ". " + words(11) + ". "):
        text = lead + " ".join(body)
        cut = sentence_spans.sentences(text)
        for at, n, value in zip(*sentence_spans.all_spans(text)):
            run = "\n".join(" ".join(x.lower().split()) for x in cut[at:at + n])
            assert seen.setdefault(int(value), run) == run
    assert len(set(seen.values())) == len(seen) > 50
