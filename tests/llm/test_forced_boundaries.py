"""BPE by forced boundaries against the tokenizers library."""

import hashlib
import random

import public_tokenizers
import pytest
from tokenizers import Tokenizer

from tallyline.llm import forced_boundaries as bpe
from tallyline.llm.common import table

WORDS, BYTES = (public_tokenizers.path(name) for name in ("word_bpe_49k.json", "byte_bpe_50k.json"))
LETTERS = [*map(chr, range(0x250)), *map(chr, range(0x2000, 0x2070)), *"̧̀́ͅΣςσΑ中文日本한국ẞǅﬁ½²Ⅷ٣­‍﻿", "\U0001f600",
           "<|endoftext|>", "<|startoftext|>", "<|", "'s", "'LL", "  ", "\n", "abc", "ing", "The"]


def texts(seed, count):
    dice = random.Random(seed)
    return ["".join(dice.choice(LETTERS) for _ in range(dice.randint(0, 25))) for _ in range(count)]


def digests(library, text):
    ids = library.encode(text or "", add_special_tokens=False).ids
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    return len(ids), sha(" ".join(map(str, ids))), sha(library.decode(ids, skip_special_tokens=False))


@pytest.mark.parametrize("path", [WORDS, BYTES])
def test_like_the_library(path):
    own, library = bpe.ForcedBoundaries(path), Tokenizer.from_file(path)
    given = texts(3, 4000)
    ids, sizes = own.encode(given)
    want = library.encode_batch(given, add_special_tokens=False)
    assert sizes.tolist() == [len(w.ids) for w in want]
    assert ids.tolist() == [i for w in want for i in w.ids]
    assert own.decode(ids, sizes).to_pylist() == [library.decode(w.ids, skip_special_tokens=False) for w in want]


def test_each_latin_character_alone():
    own, library = bpe.ForcedBoundaries(WORDS), Tokenizer.from_file(WORDS)
    for text in [f"a{chr(c)}b {chr(c)}{chr(c)} x" for c in bpe.PROBED]:
        assert own.encode([text])[0].tolist() == library.encode(text, add_special_tokens=False).ids, repr(text)


def test_cuts_change_nothing():
    """Merging a word whole and merging its fragments give the same; some words are cut."""
    merger, cut = bpe.ForcedBoundaries(WORDS).merger, 0
    letters = bpe.byte_letters()
    dice = random.Random(4)
    for _ in range(3000):
        word = "".join(letters[b] for b in dice.choice(["qzxjvw", "etaoinshr", "äöüß", "aącćeę"]).encode() * 3 if dice.random() < 0.6)
        if word:
            fragments = merger.fragments(word)
            whole = (*word[:-1], word[-1] + merger.suffix)
            assert [s for f in fragments for s in f] == [*whole]
            assert merger.encode(word) == merger.merged(whole)
            cut += len(fragments) > 1
    assert cut > 500


def test_query(spark, sf):
    library = Tokenizer.from_file(WORDS)
    got = {r.doc_id: tuple(r)[1:] for r in bpe.query(spark, sf).collect()}
    assert got == {r.doc_id: digests(library, r.text) for r in table(spark, sf, "documents").collect()}


def test_odd_rows(spark, tmp_path):
    """Nulls, empty and very long texts, repeated rows and ids, clashing names, an empty table."""
    library = Tokenizer.from_file(WORDS)
    long = "Straße " * 400_000
    given = [(1, None), (1, "One."), (1, "One."), (None, "lost id"), (2, ""), (3, " \n\t "), (4, long), (5, "y" * 300_000),
             (6, "qx" * 100_000), *((10 + n, t) for n, t in enumerate(texts(7, 300)))]
    schema = "doc_id long, text string, ids string, n_tokens int"
    spark.createDataFrame([(*r, "x", 1) for r in given], schema).write.parquet(f"{tmp_path}/documents.parquet")
    got = [tuple(r) for r in bpe.query(spark, str(tmp_path)).collect()]
    want = [(i, *digests(library, t)) for i, t in given]
    key = lambda r: (r[0] is None, r)
    assert sorted(got, key=key) == sorted(want, key=key)
    spark.createDataFrame([], schema).write.parquet(f"{tmp_path}/none/documents.parquet")
    assert bpe.query(spark, f"{tmp_path}/none").count() == 0


def test_round_trip(spark):
    """A byte-level file gives every text back."""
    rows = spark.createDataFrame([(n, t) for n, t in enumerate(texts(9, 200))], "doc_id long, text string")
    back = bpe.decoded(bpe.encoded(rows, BYTES), BYTES)
    assert {r.doc_id: r.text for r in back.collect()} == {r.doc_id: r.text for r in rows.collect()}
    assert sorted(back.collect()) == sorted(bpe.round_trip(rows, BYTES).collect())
