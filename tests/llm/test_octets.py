"""Words found in the bytes of many texts at once, against plain Python."""

import random

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

from tallyline.llm import decontamination, octets, vocabulary

R = random.Random(11)
SIGNS = [*"abABzS.,;:'\"()-%$+ \t\n\r\x1c\x85\xa0  　«“éÉßÖ×÷µKΣςİ12٣½€/|\x00\x7f<>", "x" * 70, "É" * 40, "́", "\U0001f600",
         " five ", " 5 km ", " £7% ", " Hours ", " the ", "'s", "<|endoftext|>", "<|"]


def drawn(n):
    return [["".join(R.choice(SIGNS) for _ in range(R.randint(0, 60))) for _ in range(R.randint(1, 9))] for _ in range(n)]


def plain(text):
    """(slot value, own, named, slot or name) of the template tokens of a text, with words for hashes."""
    rows = [r for r in map(decontamination.classify, text.split()) if r]
    out = []
    for i, (low, number, unit, name) in enumerate(rows):
        unit = unit and i > 0 and rows[i - 1][1]
        own = "<number>" if number else "<unit>" if unit else low
        out.append((low, own, "<name>" if name and not unit else own, number or unit, number or unit or name))
    return out


def test_template_tokens_are_those_of_each_word():
    for texts in [*drawn(150), [""], ["", "5", "km"], ["Five hours. 3 KM « «Été»", "the " * 300]]:
        value, ends, ((own, slot), (named, loose)) = decontamination.Templates().tokens(texts)
        want = [plain(t) for t in texts]
        assert ends.tolist() == np.cumsum([len(w) for w in want]).tolist()
        rows = [r for w in want for r in w]
        assert [value(i) for i in range(len(own))] == [r[0] for r in rows]
        assert slot.tolist() == [r[3] for r in rows] and loose.tolist() == [r[4] for r in rows]
        # One hash for one word, and another for another.
        for hashes, words in ((own, [r[1] for r in rows]), (named, [r[2] for r in rows])):
            assert len(set(zip(hashes.tolist(), words))) == len(set(words)) == len(set(hashes.tolist()))


def test_common_words_need_no_table():
    """a text of common words costs no object for each of them."""
    cut = decontamination.Templates()
    value, ends, _ = cut.tokens([" ".join(f"Wort{'abcdefgh'[i % 8]} größe{'xyz'[i % 3]}, (garçon)." for i in range(500))])
    assert ends.tolist() == [1500] and value(1) == "größex"
    assert not cut.known


def test_hashes_of_long_and_short_runs():
    runs = [b"", b"a", b"ab", b"x" * 8, b"x" * 9, b"y" * 64, b"y" * 65, b"y" * 5000]
    got = octets.hashes_of(runs)
    assert len(set(got.tolist())) == len(runs)
    assert [octets.hashes_of([r])[0] for r in runs] == got.tolist()


def test_ids_are_those_of_the_library():
    path = public_tokenizers.path("word_bpe_49k.json")
    library, own = Tokenizer.from_file(path), vocabulary.Encoder(path)
    for texts in [*drawn(300), [""], ["", "b", "", "\n"]]:
        ids, sizes = own.encode(texts)
        want = [c.ids for c in library.encode_batch(texts, add_special_tokens=False)]
        assert sizes.tolist() == [len(w) for w in want] and ids.tolist() == [i for w in want for i in w]


def test_pieces_that_share_a_place(monkeypatch):
    """Places that many pieces contend for, and a table that is emptied between texts, give the same ids."""
    monkeypatch.setattr(vocabulary, "PLACES", 4)
    monkeypatch.setattr(vocabulary, "MOST_CACHED", 60)
    path = public_tokenizers.path("word_bpe_49k.json")
    library, own = Tokenizer.from_file(path), vocabulary.Encoder(path)
    words = ["".join(R.choice("abcdeé") for _ in range(R.randint(1, 20))) for _ in range(90)]
    for _ in range(30):
        texts = [" ".join(R.choice(words) for _ in range(40)) for _ in range(3)]
        assert own.encode(texts)[0].tolist() == [i for c in library.encode_batch(texts, add_special_tokens=False) for i in c.ids]


def test_a_piece_is_learnt_once():
    """marks, digits and capitals around a word make no further entry of it, and a known one is found by its bytes."""
    own = vocabulary.Encoder(public_tokenizers.path("word_bpe_49k.json"))
    texts = ["Größe, größe; (größe) GRÖSSE|größe-7.Größe", "größe:größe größe... größe"]
    own.encode(texts)
    assert len(own.index) <= 13
    own._numbers = None
    assert own.encode(texts)[1].sum() > 20
