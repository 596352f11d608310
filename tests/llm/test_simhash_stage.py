"""The pipeline's near copies against brute force over all pairs of fingerprints."""

import random

from tallyline.llm import simhash_dedup

SCHEMA = "doc_id long, text string, source string, tags map<string, int>, h int, fp string, row long"


def test_one_of_each_group_stays(spark):
    r = random.Random(9)
    word = lambda: "".join(r.choice("abcdefgh") for _ in range(5))
    texts = [None, "", " \n", "a b", "A  b", "a b c"]
    for n in (12, 40, 400, 1500):
        for _ in range(4):
            base = [word() for _ in range(n)]
            texts.append(" ".join(base))
            for _ in range(6):
                other = list(base)
                other[r.randrange(n)] = word()
                texts.append(" ".join(other))
                base = other if r.random() < 0.5 else base
    texts += texts[10:14]
    ids = list(range(len(texts)))
    r.shuffle(ids)
    ids[20], ids[100], ids[0] = ids[60], None, None  # one id for two texts, rows without any
    rows = [(d, t, None if i % 7 else "s", {"a": 1} if i % 3 else None, 1, "x", 2) for i, (d, t) in enumerate(zip(ids, texts))]
    rows += [rows[8]] * 5
    prints = [simhash_dedup.fingerprint(t) % (1 << 64) for _, t, *_ in rows]
    group = list(range(len(rows)))
    for i, a in enumerate(prints):
        for j in range(i):
            if (a ^ prints[j]).bit_count() <= simhash_dedup.RADIUS and group[i] != group[j]:
                old, new = group[i], group[j]
                group = [new if g == old else g for g in group]
    kept = simhash_dedup.keep_one(spark.createDataFrame(rows, SCHEMA).repartition(5))
    assert kept.columns == [c.split()[0] for c in SCHEMA.replace("<string, int>", "").split(", ")]
    kept = kept.collect()
    left = {}
    for g, (d, t, *_) in zip(group, rows):
        left.setdefault(g, []).append((d is None, d or 0))
    assert 10 < len(left) < len(rows) - 30
    assert sorted((k.doc_id is None, k.doc_id or 0) for k in kept) == sorted(min(part) for part in left.values())
    where = {t: g for g, (_, t, *_) in zip(group, rows)}
    assert sorted(where[k.text] for k in kept) == sorted(left)
    assert simhash_dedup.keep_one(spark.createDataFrame([], SCHEMA)).count() == 0
