"""Rows that share an id, have none or repeat, and letters that leave the common range."""

import random

import numpy as np
import public_tokenizers
import xxhash
from tokenizers import Tokenizer

from tallyline.llm import decontamination, neighbours, sentence_spans, vocabulary

R = random.Random(21)
ITEM = "if Anna has 12 apples and buys 7 kg of pears at the old market near the river how many does Anna carry"


def words(n):
    return " ".join("".join(R.choice("abcdefgh") for _ in range(6)) + R.choice(["", "", "", ".", ","]) for _ in range(n))


def test_items_in_rows_that_share_an_id(spark):
    """Each row is judged by its own text, and each gets its own result."""
    one = ITEM.replace("Anna", "Boris").replace("12", "31").replace("7 kg", "9 lb")
    two = ITEM.replace("Anna", "Clara").replace("12", "40").replace("7 kg", "8 g")
    names = "so Anna met Bert while Anna saw Carl and Anna told Bert that Anna left"
    mixed = names.replace("Anna", "Dora", 1).replace("Anna", "Emma", 1).replace("Anna", "Fay", 1)  # one name for several
    rows = [(5, one), (5, two), (None, one), (None, two), (None, mixed), (None, words(40)), (7, mixed), (8, one), (8, one), (9, None), (9, ITEM)]
    docs = spark.createDataFrame([(*r, "x", 1) for r in rows], "doc_id long, text string, item_id string, row int").repartition(3)
    benchmark = spark.createDataFrame([(1, ITEM), (2, names)], "item_id long, text string")
    found = decontamination.matches(decontamination.keyed(docs), benchmark)
    hits = [(None, one), (None, two), (5, one), (5, two), (8, one), (9, ITEM)]
    key = lambda r: (r[0] is not None, r[0] or 0, r[1])
    hashed = lambda t: xxhash.xxh64_intdigest(t.encode(), 42) - (1 << 64) * (xxhash.xxh64_intdigest(t.encode(), 42) >> 63)
    assert sorted(((r.doc_id, r.row) for r in found.collect()), key=key) == sorted(((d, hashed(t)) for d, t in hits), key=key)
    kept = [(r.doc_id, r.text) for r in decontamination.clean(docs, benchmark).collect()]
    left = [r for r in rows if r not in hits]
    assert sorted(kept, key=str) == sorted(left, key=str)


def test_every_row_has_its_matches(spark, tmp_path):
    docs = spark.createDataFrame([(8, ITEM), (8, ITEM), (None, ITEM), (1, "no")], "doc_id long, text string")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, ITEM)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    got = decontamination.query(spark, str(tmp_path)).collect()
    assert sorted(((r.doc_id, r.item_id) for r in got), key=str) == [(8, 1), (8, 1), (None, 1)]


def brute_removals(rows):
    """By all spans of all different (id, text): what each loses."""
    signed = lambda v: v - (1 << 64) if v >> 63 else v
    docs = {(sentence_spans.LAST if d is None else d, signed(xxhash.xxh64_intdigest(t.encode(), 42)) if t is not None else 42): t for d, t in rows}
    found = [(key, int(p), int(n), int(h)) for key, t in docs.items() for p, n, h in zip(*sentence_spans.all_spans(t or ""))]
    first = {}
    for key, p, _, h in found:
        first[h] = min(first.get(h, (key, p)), (key, p))
    gone = {}
    for key, p, n, h in found:
        if first[h] != (key, p):
            gone.setdefault(key, set()).update(range(p, p + n))
    return docs, gone


def test_spans_of_rows_that_share_an_id(spark):
    passages = [words(60) for _ in range(4)]
    rows = [(1, passages[0]), (None, passages[0]), (None, words(66)), (7, words(70)), (7, words(50) + " " + passages[1]), (7, passages[1]),
            (8, passages[2]), (8, passages[2]), (9, words(30) + " " + passages[2] + " " + words(30)), (None, None), (None, ""), (3, words(500)),
            (None, passages[3] + " " + words(40)), (None, words(40) + " " + passages[3])]
    docs = spark.createDataFrame([(*r, 1, "x") for r in rows], "doc_id long, text string, id int, row string").repartition(4)
    texts, gone = brute_removals(rows)
    got = sorted(((sentence_spans.LAST if r.doc_id is None else r.doc_id, sorted(r.removed))
                  for r in sentence_spans.removals(docs, ending=True).collect()))
    assert got == sorted((d, sorted(g)) for (d, _), g in gone.items()) and len(got) >= 4
    want = []
    for d, t in rows:
        own = next(k for k, v in texts.items() if v == t and k[0] == (sentence_spans.LAST if d is None else d))
        want.append((d, None if t is None else "".join(s for i, s in enumerate(sentence_spans.sentences(t)) if i not in gone.get(own, ()))))
    cut = sentence_spans.deduplicated(docs)
    assert cut.columns == docs.columns
    assert sorted(((r.doc_id, r.text) for r in cut.collect()), key=str) == sorted(want, key=str)
    # What is repeated nowhere stays whole.
    assert (None, rows[2][1]) in want and (7, rows[3][1]) in want


def test_letters_that_leave_the_common_range():
    """All letters from U+0080 to U+024F, alone and in words, as the library has them."""
    path = public_tokenizers.path("word_bpe_49k.json")
    library, own = Tokenizer.from_file(path), vocabulary.Encoder(path)
    letters = [chr(c) for c in range(0x80, 0x250)]
    texts = [f"{c}li g{c}ldi {c}. {c}{c}, ok" for c in letters] + ["\u018fli g\u0259ldi", "\u0181ala \u2013 ok", "\u0186\u0189\u0190 Ewe, \u01e6. x"]
    texts += ["".join(R.choice([*letters, "a", "B", " ", ". ", ", "]) for _ in range(20)) for _ in range(4000)]
    ids, sizes = own.encode(texts)
    want = [c.ids for c in library.encode_batch(texts, add_special_tokens=False)]
    ends = np.append(0, np.cumsum(sizes))
    assert [ids[a:b].tolist() for a, b in zip(ends, ends[1:])] == want


def test_neighbours_of_ids_that_repeat(spark):
    """A query id with two vectors has five different neighbours, each with its best score."""
    draw = np.random.default_rng(3)
    rows = [(50, v) for v in draw.normal(size=(2, 8)).tolist()] + [(n, v) for n, v in enumerate(draw.normal(size=(40, 8)).tolist(), 1) if n != 50]
    rows += [(37, v) for v in draw.normal(size=(9, 8)).tolist()] + [rows[5]] * 20
    frame = spark.createDataFrame([(*r, "x", 1) for r in rows], "vec_id long, embedding array<double>, rank string, score int").repartition(4)
    got = [(r.vec_id, r.score) for r in neighbours.nearest(frame.filter("vec_id = 50"), frame).orderBy("rank").collect()]
    best = {}
    for q in (v for i, v in rows if i == 50):
        for i, v in rows:
            if i != 50:
                score = np.dot(q, v) / np.linalg.norm(q) / np.linalg.norm(v)
                best[i] = max(best.get(i, -2), score)
    want = sorted(best.items(), key=lambda x: (-x[1], x[0]))[:5]
    assert [i for i, _ in got] == [i for i, _ in want] and len({i for i, _ in got}) == 5
    assert np.allclose([s for _, s in got], [s for _, s in want])
