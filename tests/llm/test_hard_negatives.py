"""Hard negatives: odd rows against brute force. The given tables are held against SQL in test_registry."""

import math
import random
from fractions import Fraction

import numpy as np

from tallyline.llm import hard_negatives as hard

SCHEMA = "vec_id long, embedding array<float>, label int, id string, score int, slot int"


def brute(rows):
    usable = {}
    for vec_id, vector, label in rows:
        if label is None or vector is None or any(x is None or not math.isfinite(np.float32(x)) for x in vector):
            continue
        label = (label + 1) % 10 if vec_id is not None and vec_id % 7 == 0 else label
        usable[vec_id, label, tuple(math.floor(Fraction(float(np.float32(x))) * 256) for x in vector)] = None
    out = []
    for a in usable:
        if a[0] is None or a[0] % 100:
            continue
        scored = [(sum(x * y for x, y in zip(a[2], r[2])), r) for r in usable if len(r[2]) == len(a[2])]
        order = lambda x: (-x[0], x[1][0] is None, x[1][0] or 0)
        likes = sorted(((s, r) for s, r in scored if r[1] == a[1] and r[0] != a[0]), key=order)[:5]
        for p, r in likes:
            others = sorted(((s, n) for s, n in scored if n[1] != a[1] and 30 * p <= 100 * s <= 90 * p), key=order)[:10]
            out += [(a[0], r[0], rank, n[0], p, s) for rank, (s, n) in enumerate(others, 1)]
    return out


def run(spark, rows, path):
    spark.createDataFrame([(i, v, label, "x", 1, 2) for i, v, label in rows], SCHEMA).repartition(3).write.parquet(
        f"{path}/embeddings.parquet")
    return [tuple(r) for r in hard.query(spark, str(path)).collect()]


def same(got, want):
    key = lambda r: tuple((x is None, x or 0) for x in r)
    return sorted(got, key=key) == sorted(want, key=key)


def test_odd_rows(spark, tmp_path, monkeypatch):
    """Nulls, ties, repeated rows and ids, other lengths, huge components; blocks smaller than the table."""
    monkeypatch.setattr(hard, "ANCHOR_BLOCK", 3)
    monkeypatch.setattr(hard, "ROW_BLOCK", 40)
    dice = random.Random(2)
    rows = [(n, [dice.choice([-0.5, 0.0, 0.25, 0.5, 0.51, 1.0]) for _ in range(4)], dice.randrange(4)) for n in range(0, 900, 4)]
    rows += [(None, [0.5] * 4, 1), (4, None, 1), (8, [0.5, None, 0.5, 0.5], 1), (12, [float("nan")] * 4, 1), (16, [float("inf")] * 4, 2),
             (20, [0.5] * 4, None), (24, [1.0] * 3, 1), (28, [], 1), (100, [], 1), (200, [], 2), (300, [0.5] * 3, 1), (32, [0.75] * 3, 2)]
    rows += [rows[3]] * 40 + [(rows[5][0], [1.0, 1.0, 1.0, 0.5], 2), (500, [1.0] * 4, 3)]
    rows += [(5000 + n, [0.5] * 4, 1) for n in range(60)]
    assert same(run(spark, rows, tmp_path), brute(rows))


def test_components_beyond_64_bits(spark, tmp_path):
    dice = random.Random(3)
    rows = [(n, [dice.choice([-3.0e4, 1.0e5, 7.0e6, 0.1]) for _ in range(3)], n % 3) for n in range(0, 400, 10)]
    assert same(run(spark, rows, tmp_path / "a"), brute(rows))
    huge = rows + [(1, [1.0e30, 1.0e30, 1.0], 0), (100, [2.0e30, 1.0, 1.0], 1)]
    assert all(abs(r[4]) < 1 << 63 for r in run(spark, huge, tmp_path / "b"))


def test_empty_table(spark, tmp_path):
    assert run(spark, [], tmp_path / "none") == []
    assert run(spark, [(1, [1.0], 2), (2, [1.0], 3)], tmp_path / "no_anchor") == []


def test_slots_answer_every_window():
    dice = random.Random(8)
    for _ in range(200):
        uppers = sorted({dice.randint(0, 30) for _ in range(5)}, reverse=True)
        rows = [(dice.randint(-5, 35), n) for n in range(dice.randint(0, 80))]
        slots = [[] for _ in uppers]
        for score, n in rows:
            fits = [s for s, u in enumerate(uppers) if score <= u]
            if fits:
                slots[fits[-1]].append((score, n))
        kept = [(s, *r) for s, own in enumerate(slots) for r in sorted(own, key=lambda r: (-r[0], r[1]))[:10]]
        for upper, got in zip(uppers, hard.suffix_merges(kept, len(uppers))):
            assert got == sorted((r for r in rows if r[0] <= upper), key=lambda r: (-r[0], r[1]))[:10]
