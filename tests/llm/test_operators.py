"""Each operator against a brute-force version, on small tables with nulls, empty and repeated texts, and clashing columns."""

import hashlib
import math
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
import xxhash
from tokenizers import Tokenizer

from tallyline.llm import (
    decontamination, mixing, neighbours, sentence_spans, simhash_dedup, suffix_dedup, token_counts, token_files, toxicity, url_filters,
)

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, row int, fp long, key long, size long"
R = random.Random(5)
WORDS = ["".join(R.choice("abcdefgh") for _ in range(R.randint(2, 7))) for _ in range(300)]


def prose(n):
    return " ".join(R.choice(WORDS) + ("." if R.random() < 0.15 else "") for _ in range(n))


@pytest.fixture(scope="module")
def rows():
    base = [prose(R.randint(5, 200)) for _ in range(30)]
    passage = prose(60)
    texts = base + [base[3], base[3], base[7] + " x", base[0] + "\n" + passage, passage + " " + base[1], None, "", " \n", "a b", "é" * 40 + "x" * 90,
                    prose(8000), "the " * 300]
    out = [(i * 3 % 1000, t) for i, t in enumerate(texts)] + [(None, base[2]), (None, base[2]), (999, base[4]), (999, base[4])]
    return [(d, t, "en", ["src1", "src0", None][i % 3], 1, 1, 2, 3, 4) for i, (d, t) in enumerate(out)]


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).repartition(5)


@pytest.fixture(scope="module")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)


def simhash(text):
    words = (text or "").encode().lower().split()
    shingles = [b" ".join(words[i:i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_simhash(docs, rows, nothing):
    prints = [(r[0], simhash(r[1])) for r in rows]
    group = list(range(len(prints)))
    for _ in prints:
        for i, (_, a) in enumerate(prints):
            group[i] = min(group[j] for j, (_, b) in enumerate(prints) if (a ^ b).bit_count() <= 3)
    least = {g: min((d for (d, _), h in zip(prints, group) if h == g and d is not None), default=None) for g in group}
    want = sorted(((d, p, least[g]) for (d, p), g in zip(prints, group)), key=str)
    got = [(r.doc_id, r.fp % (1 << 64), r.component_id) for r in simhash_dedup.near_duplicates(docs).collect()]
    assert sorted(got, key=str) == want
    kept = simhash_dedup.keep_one(docs)
    assert kept.columns == docs.columns and kept.count() == len(set(group))  # no two texts share an id here
    assert simhash_dedup.near_duplicates(nothing).count() == 0


def test_simhash_links(spark):
    near = [x ^ y for x in (0, R.getrandbits(63), R.getrandbits(63)) for y in (0, 1, 6, 1 << 40, 7 << 20, 15, (1 << 62) | 3)]
    prints = sorted(set(near))
    want = {(a, b) for a in prints for b in prints if a < b and (a ^ b).bit_count() <= 3}
    got = simhash_dedup.link_pairs(spark.createDataFrame([(p,) for p in prints], "fp long")).collect()
    assert len(got) == len(want) and {tuple(r) for r in got} == want


def test_suffix_dedup(docs, rows, nothing):
    known = [(1 << 62 if r[0] is None else r[0], (r[1] or "").encode()) for r in rows]
    first = {}
    for d, t in known:
        for i in range(len(t) - 49):
            first[t[i:i + 50]] = min(first.get(t[i:i + 50], d), d)
    want = []
    for (d, t), r in zip(known, rows):
        gone = bytearray(len(t))
        for i in range(len(t) - 49):
            if first[t[i:i + 50]] < d:
                gone[i:i + 50] = b"\1" * 50
        want.append((r[0], len(t), hashlib.sha256(bytes(b for b, g in zip(t, gone) if not g)).hexdigest()))
    got = [(r.doc_id, r.n_bytes, hashlib.sha256(r.kept).hexdigest()) for r in suffix_dedup.deduplicated(docs).collect()]
    assert sorted(got, key=str) == sorted(want, key=str)
    assert suffix_dedup.deduplicated(nothing).count() == 0


def test_suffix_order():
    for text in (b"abracadabra" * 30 + b"x" * 200, bytes(R.choice(b"ab") for _ in range(2000))):
        at = np.arange(len(text) - 50)
        order, begin = suffix_dedup.suffix_classes(np.frombuffer(text, np.uint8), at)
        got = [text[i:i + 50] for i in order]
        assert got == sorted(got)
        assert begin.tolist() == [i for i in range(len(got)) if i == 0 or got[i] != got[i - 1]]


def test_token_files(docs, rows, nothing):
    coder = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    want = {(r[0], tuple(coder.encode(r[1] or "", add_special_tokens=False).ids) + (1,)) for r in rows}
    want = {(d, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())) for d, ids in want}
    got = token_files.encoded(docs).collect()
    assert len(got) == len(rows) and {(r.doc_id, r.n_tokens, r.ids_crc32) for r in got} == want
    got.sort(key=lambda r: r.start)
    assert [r.start for r in got] == [sum(x.n_tokens for x in got[:i]) for i in range(len(got))]
    ids = [-1 if r.doc_id is None else r.doc_id for r in got]
    assert ids == sorted(ids)
    assert token_files.encoded(nothing).count() == 0


def test_code_is_bounded_and_round_trips():
    weights = np.array([1.6 ** i for i in range(40)])
    lengths = token_files.code_lengths(weights, 12)
    assert lengths.max() <= 12 and math.isclose((0.5 ** lengths).sum(), 1)
    code = token_files.Code(np.arange(40), lengths)
    ids = np.random.default_rng(1).integers(0, 40, 5000)
    payload, checkpoints = code.encode(ids)
    assert (code.decode(payload, checkpoints, len(ids)) == ids).all()


def test_mixing(docs, rows, nothing):
    got = mixing.copies(docs).collect()
    total = sum(len((r[1] or "").split()) for r in rows)
    targets = {r.row.source: (r.target, r.source_size) for r in got}
    assert math.isclose(sum(t for t, _ in targets.values()), 1.5 * total) and all(t <= 2 * s for t, s in targets.values())
    assert all(r.copies in (0, 1, 2) for r in got) and len(got) == len(rows)
    assert mixing.mix(docs).columns == docs.columns and mixing.mix(docs).count() == sum(r.copies for r in got)
    assert mixing.mix(nothing).count() == 0


def test_decontamination(spark, docs, nothing):
    dense = "when Anna gave 12 to Anna then Anna kept 12 of the 30 that Anna had as Anna left"
    item = "If Anna has 12 apples and buys 7 kg of pears at the old market near the river how many fruits does Anna carry home"
    benchmark = spark.createDataFrame([(1, item), (2, None), (3, "short one here"), (4, ""), (5, dense)], "item_id long, text string")
    other = item.replace("Anna", "Boris").replace("12", "31").replace("kg", "lb")
    same, mixed = dense.replace("Anna", "Boris").replace("12", "7"), dense
    for name in ("Boris", "Clara", "Dora", "Emil"):
        mixed = mixed.replace("Anna", name, 1)
    texts = [(1, "so. " + item + " yes"), (2, prose(20) + " " + other), (3, mixed), (4, prose(50)), (5, None), (6, "a short one here too"), (7, same)]
    found = decontamination.matches(decontamination.keyed(spark.createDataFrame(texts, "doc_id long, text string")), benchmark).collect()
    assert {(r.doc_id, r.item_id) for r in found} == {(1, 1), (2, 1), (6, 3), (7, 5)}
    assert decontamination.clean(docs, benchmark).count() == docs.count()
    assert decontamination.clean(nothing, benchmark).count() == 0


def test_sentence_spans(docs, rows, nothing):
    first, want = {}, {}
    known = [(sentence_spans.LAST if r[0] is None else r[0], r[1] or "") for r in rows]
    spans = [(d, i, h, n) for d, t in known for i, (h, n) in enumerate(zip(*sentence_spans.span_hashes(t))) if n]
    for d, i, h, _ in spans:
        first[h] = min(first.get(h, (d, i)), (d, i))
    for d, i, h, n in spans:
        if first[h] != (d, i):
            want.setdefault(None if d == sentence_spans.LAST else d, set()).update(range(i, i + n))
    got = {r.doc_id: set(r.removed) for r in sentence_spans.removals(docs).collect()}
    assert got == want and got
    assert "".join(sentence_spans.sentences("A b. C, d!\n e")) == "A b. C, d!\n e"
    assert sentence_spans.deduplicated(docs).count() == len(rows)
    assert sentence_spans.removals(nothing).count() == 0


def test_toxicity_learns_a_pair(spark, nothing):
    clean = [w for w in WORDS if len(w) > 3]
    texts = []
    for i in range(1600):
        words, kind = R.sample(clean, 10), i % 4
        words += [["zzinsult", "zzgroup"], ["zzinsult"], ["zzgroup"], []][kind]
        texts.append((i, " ".join(words), int(kind == 0)))
    texts += [(None, None, None), (7000, "", 0)]
    docs = spark.createDataFrame(texts, "doc_id long, text string, toxic int")
    got = toxicity.judged(docs.drop("toxic"), docs.select("doc_id", "toxic")).collect()
    truth = {d: t for d, _, t in texts}
    held = [r for r in got if r.held_out and r.doc_id is not None]
    assert len(got) == len(texts) and all(0 <= r.score <= 1 for r in got)
    bad, good = [[r.score for r in held if truth[r.doc_id] == k] for k in (1, 0)]
    assert np.mean([[b > g for g in good] for b in bad]) > 0.95  # the area under the curve
    assert np.mean([b >= toxicity.THRESHOLD for b in bad]) > 0.9
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in held)
    assert toxicity.judged(nothing, docs.select("doc_id", "toxic").limit(0)).count() == 0


def test_url_filters(spark):
    urls = [(i, f"http{'s' * (i % 2)}://a{i}.{h}.{s}/{p}/{i}?q={i}") for i in range(40) for h in ("Example", "other")
            for s, p in (("net", "en"), ("com", "de"), ("org", "fr"), ("net", "de"))]
    urls += [(900, None), (901, "no scheme"), (902, "x://net"), (903, "x://NET/"), (904, "x://example.net/en/?a"), (905, "x://h?/p")]
    got = {r.page_id: r for r in url_filters.judged(spark.createDataFrame(urls, "page_id long, url string")).filter("page_id >= 900").collect()}
    said = {k: (r.host, r.path, r.rule) for k, r in got.items()}
    assert said == {900: ("", "", None), 901: ("", "", None), 902: ("net", "", None), 903: ("net", "/", "net/"),
                    904: ("example.net", "/en/", "example.net/en/"), 905: ("h", "", None)}
    assert got[903].verdict == "block" and got[904].verdict == "allow" and all(r.verdict in ("allow", "block") for r in got.values())
    assert url_filters.judged(spark.createDataFrame([], "page_id long, url string")).count() == 0


def test_neighbours(spark):
    rng = np.random.default_rng(3)
    rows = [(i, rng.normal(size=16).astype(np.float32).tolist()) for i in range(300)]
    rows += [(300 + i, rows[50][1]) for i in range(30)]
    odd = [(400, None), (401, [0.0] * 16), (450, [float("nan")] * 16), (500, [None] * 16), (550, [])]
    table = spark.createDataFrame(rows + odd, "vec_id long, embedding array<float>")
    got = {}
    for r in neighbours.nearest(table.filter("vec_id % 50 = 0"), table).collect():
        got.setdefault(r.query_id, []).append((r.rank, r.vec_id))
    for q, v in rows:
        if q % 50 == 0:
            a = np.array(v, np.float64)
            score = [(-round(float(a @ np.array(w, np.float64) / np.linalg.norm(a) / np.linalg.norm(np.array(w, np.float64))), 12), c)
                     for c, w in rows if c != q]
            assert [c for _, c in sorted(got[q])] == [c for _, c in sorted(score)[:5]]
    assert set(got) == {q for q, _ in rows if q % 50 == 0}
    assert neighbours.nearest(table.limit(0), table.limit(0)).count() == 0


def test_token_counts(docs, rows, nothing):
    coder = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    coder.encode_special_tokens = True
    want = []
    for r in rows:
        spans = coder.encode(r[1] or "", add_special_tokens=False).offsets
        lines = (r[1] or "").split("\n")
        ends = np.cumsum([len(x) + 1 for x in lines])
        own = [int(np.searchsorted(ends, a, "right")) for a, _ in spans]
        n = 0 if not r[1] else len(lines) - r[1].endswith("\n")
        want.append((r[0], len(spans), [own.count(i) for i in range(n)]))
    got = [(r.doc_id, r.n_tokens, r.section_tokens) for r in token_counts.count_tokens(docs).collect()]
    assert sorted(got, key=str) == sorted(want, key=str)
    spans = np.array([(0, 4), (4, 10)])
    assert [token_counts.attribute(spans, np.array([3, 6, 10]), rule)[0].tolist() for rule in token_counts.RULES] == [[1, 1, 0], [0, 1, 1], [1, 0, 1]]
    assert token_counts.count_tokens(nothing).count() == 0
