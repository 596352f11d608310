"""Encoding with a public tokenizer file, a piece at a time and each distinct piece once.

Both kinds of file cut a text into pieces before they merge, and no token
crosses a piece. So a text's tokens are those of its pieces in a row, and a
dictionary of pieces does the work of the merge loop for all but new ones.
"""

from __future__ import annotations

import json
import os
import re
from itertools import chain

import numpy as np

from tallyline.llm import octets

# Letters that lower-case out of the range below, or to more than one.
_STRAY = "".join(chr(c) for c in range(0xC0, 0x250) if len(chr(c).lower()) > 1 or ord(chr(c).lower()) > 0x24F)
# Words of letters that lower-case to one letter and need no normalisation, and of other visible characters.
_PLAIN = re.compile(f"(?:(?![{_STRAY}])[!-~\u00a1-\u00ac\u00ae-\u024f])+")
# The letters and numbers among them.
_LETTERS, _NUMBERS = "A-Za-z\u00aa\u00b5\u00ba\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u024f", "0-9\u00b2\u00b3\u00b9\u00bc-\u00be"
# What a byte is to a word: an end of it, a letter, a digit, a mark; words with any other byte, or which may hold a contraction
# or a special token, are left whole.
_END, _LETTER, _DIGIT, _MARK, _WHOLE = range(5)
_KIND = np.array([_END if c in " \n" else _LETTER if c.isalpha() else _DIGIT if c.isdigit() else _WHOLE if c in "'<" else _MARK
                  for c in map(chr, range(128))] + [_WHOLE] * 128, np.uint8)
_KIND[[*(b for b in range(32) if b != 10), 127]] = _WHOLE
MOST_CACHED = 600_000
MOST_PIECES = 400_000
PLACES = 1 << 21


class Grown:
    """Rows that are added to, in an array of doubling size."""

    def __init__(self, kind, width: int | None = None):
        self.size, self.rows = 0, np.zeros(1024 if width is None else (1024, width), kind)

    def add(self, more: np.ndarray) -> None:
        if (need := self.size + len(more)) > len(self.rows):
            grown = np.zeros((max(need, 2 * len(self.rows)), *self.rows.shape[1:]), self.rows.dtype)
            grown[:self.size] = self.rows[:self.size]
            self.rows = grown
        self.rows[self.size:need] = more
        self.size = need


def _flat(lists: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
    sizes = np.fromiter(map(len, lists), np.int64, len(lists))
    return np.fromiter(chain.from_iterable(lists), np.uint32, int(sizes.sum())), sizes


def _runs(sizes: np.ndarray, begins: np.ndarray) -> np.ndarray:
    """Indexes of the runs (begin, size) laid end to end."""
    ends = np.cumsum(sizes)
    return np.arange(int(sizes.sum())) + np.repeat(begins - (ends - sizes), sizes)


class PlainWords:
    """A shorter way for words of common Latin letters, where a file lower-cases, cuts by one pattern and merges bytes.

    Such words need no Unicode normalisation, so they are lower-cased and cut
    here, and only distinct pieces go through the file's merges.
    """

    def __init__(self, path: str, pattern: str):
        from tokenizers import Tokenizer

        self.merges = Tokenizer.from_file(path)
        self.merges.normalizer = self.merges.pre_tokenizer = None
        self.cut = re.compile(pattern.replace(r"\p{L}", _LETTERS).replace(r"\p{N}", _NUMBERS)).findall
        # Byte-level files write each byte as a printable character: itself, or the next from 256 on.
        own = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
        self.letters = {b: chr(b) if b in own else chr(256 + b - sum(o < b for o in own)) for b in range(256)}
        self.forget()

    def forget(self) -> None:
        self.index: dict[str, int] = {}
        self.ids, self.sizes, self.begins = Grown(np.uint32), Grown(np.int64), Grown(np.int64)

    @classmethod
    def of(cls, path: str) -> PlainWords | None:
        """None if the file works in another way."""
        with open(path, encoding="utf-8") as file:
            said = json.load(file)
        normal, cut = said.get("normalizer") or {}, said.get("pre_tokenizer") or {}
        steps = [x["type"] for x in normal.get("normalizers", ())], [x["type"] for x in cut.get("pretokenizers", ())]
        if steps != (["NFC", "Replace", "Lowercase"], ["Split", "ByteLevel"]):
            return None
        split, byte_level = cut["pretokenizers"]
        if not split["invert"] or split["behavior"] != "Removed" or byte_level["add_prefix_space"] or byte_level["use_regex"]:
            return None
        return cls(path, split["pattern"]["Regex"])

    @staticmethod
    def fits(word: str) -> bool:
        return _PLAIN.fullmatch(word) is not None and "<|" not in word

    def encode(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all words end to end, and how many each has."""
        if len(self.index) > MOST_PIECES:
            self.forget()
        cut = [self.cut(w.lower()) for w in words]
        pieces = list(chain.from_iterable(cut))
        index = self.index
        new = [p for p in dict.fromkeys(pieces) if p not in index]
        if new:
            ids, sizes = self.merged([p.encode() for p in new])
            index.update(zip(new, range(len(index), len(index) + len(new))))
            self.begins.add(self.ids.size + np.cumsum(sizes) - sizes)
            self.sizes.add(sizes)
            self.ids.add(ids)
        numbers = np.fromiter(map(index.__getitem__, pieces), np.int64, len(pieces))
        own = self.sizes.rows[numbers]
        ids = self.ids.rows[_runs(own, self.begins.rows[numbers])]
        ends = np.append(0, np.cumsum(own))[np.cumsum([0, *map(len, cut)])]
        return ids, np.diff(ends)

    def merged(self, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of lower-cased pieces of the pattern, and how many each has."""
        letters = [p.decode() if p.isascii() else p.decode("latin-1").translate(self.letters) for p in pieces]
        return _flat([c.ids for c in self.merges.encode_batch_fast(letters, add_special_tokens=False)])

    @staticmethod
    def units(low: np.ndarray, latin: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Begin and size of every piece of the pattern, and which are words left whole.

        Between white space, runs of letters, single digits and runs of marks are what the pattern takes; letters of U+00C0 to U+00FF
        need no normalisation. All else is left whole, with the word that it is in.
        """
        kind = _KIND[low]
        kind[latin] = kind[latin + 1] = _LETTER
        begins, ends = octets.words(kind == _END)
        whole = np.zeros(len(begins), bool)
        whole[np.searchsorted(begins, np.flatnonzero(kind == _WHOLE), "right") - 1] = True
        kind[_runs((ends - begins)[whole], begins[whole])] = _WHOLE
        cuts = np.flatnonzero((kind[1:] != kind[:-1]) | (kind[1:] == _DIGIT)) + 1
        sizes, kinds = np.diff(np.append(cuts, len(kind))), kind[cuts]
        take = np.flatnonzero(kinds != _END)
        return cuts[take], sizes[take], kinds[take] == _WHOLE


class Encoder:
    """Token ids and character spans of texts.

    ``pieces`` cuts a text into (start, piece) parts that tokens never cross;
    the default cuts at spaces and line ends, right for vocabularies that drop
    white space. With ``spans`` the encoder also keeps character offsets, and
    takes the strings of special tokens in a text for ordinary text.
    """

    def __init__(self, path: str, split=None, spans: bool = False):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # Spark has a task on every core
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = spans
        self.split, self.with_spans = split, spans
        self.plain = None if spans or split else PlainWords.of(path)
        self.forget()

    def forget(self) -> None:
        self.index: dict[str | bytes, int] = {"": 0}  # pieces in bytes are lower-cased ones of the pattern
        self.ids, self.sizes, self.begins = Grown(np.uint32), Grown(np.int64), Grown(np.int64)
        self.offsets = Grown(np.int64, 2)
        self.sizes.add(np.zeros(1, np.int64))
        self.begins.add(np.zeros(1, np.int64))
        if self.plain is not None:
            # A short piece's bytes by its number, and the number that its place holds: another's, or none's, if they differ.
            self.first, self.second = Grown(np.uint64), Grown(np.uint64)
            self.place = np.zeros(PLACES, np.int32)

    def _learn(self, pieces: list[str | bytes]) -> None:
        if self.plain is not None:
            ready = [p for p in pieces if isinstance(p, bytes)]
            if ready:
                self._add(ready, *self.plain.merged(ready))
            simple = [p for p in pieces if isinstance(p, str) and PlainWords.fits(p)]
            if simple:
                self._add(simple, *self.plain.encode(simple))
            pieces = [p for p in pieces if p not in self.index]
        if pieces:
            encode = self.tokenizer.encode_batch if self.with_spans else self.tokenizer.encode_batch_fast
            coded = encode(pieces, add_special_tokens=False)
            self._add(pieces, *_flat([c.ids for c in coded]))
            if self.with_spans:
                self.offsets.add(np.array([o for c in coded for o in c.offsets], np.int64).reshape(-1, 2))

    def _add(self, pieces: list[str | bytes], ids: np.ndarray, sizes: np.ndarray) -> None:
        at = len(self.index)
        self.index.update(zip(pieces, range(at, at + len(pieces))))
        self.begins.add(self.ids.size + np.cumsum(sizes) - sizes)
        self.sizes.add(sizes)
        self.ids.add(ids)

    def pieces(self, text: str) -> list[str]:
        if self.split is not None:
            return self.split(text)
        return text.replace("\n", " ").split(" ")

    def _numbers(self, pieces: list[str | bytes]) -> np.ndarray:
        out = list(map(self.index.get, pieces))
        if None in out:
            missing = [i for i, n in enumerate(out) if n is None]
            self._learn(list(dict.fromkeys([pieces[i] for i in missing])))
            index = self.index
            for i in missing:
                out[i] = index[pieces[i]]
        return np.array(out, np.int64)

    def _found(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The number of each piece of all texts end to end, and where each text begins and the last ends among them.

        A short piece is told from its bytes, without an object of its own, if its place holds its number.
        """
        raw, ends = octets.joined(texts)
        low, latin = octets.lowered(raw)
        at, sizes, whole = self.plain.units(low, latin)
        first, second = octets.eight(low, at, sizes), np.zeros(len(at), np.uint64)
        longer = np.flatnonzero(sizes > 8)
        second[longer] = octets.eight(low, at[longer] + 8, sizes[longer] - 8)
        places = octets.places(first, second, PLACES)
        numbers = self.place[places].astype(np.int64)
        short = ~whole & (sizes <= 16)
        missing = np.flatnonzero(~(short & (self.first.rows[numbers] == first) & (self.second.rows[numbers] == second)))
        if len(missing):
            given, lower = raw.tobytes(), low.tobytes()
            begins, stops = at[missing], at[missing] + sizes[missing]
            own = self._numbers([given[a:b].decode() if w else lower[a:b]
                                 for a, b, w in zip(begins.tolist(), stops.tolist(), whole[missing].tolist())])
            numbers[missing] = own
            for kept, bytes_ in ((self.first, first), (self.second, second)):
                kept.add(np.zeros(len(self.index) - kept.size, np.uint64))
                kept.rows[own[short[missing]]] = bytes_[missing[short[missing]]]
            self.place[places[missing[short[missing]]]] = own[short[missing]]
        return numbers, np.append(0, np.searchsorted(at, ends))

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts laid end to end, and how many each text has."""
        if len(self.index) > MOST_CACHED:
            self.forget()
        if self.plain is not None:
            numbers, cuts = self._found(texts)
        else:
            cut = [self.pieces(t) for t in texts]
            numbers, cuts = self._numbers([p for pieces in cut for p in pieces]), np.cumsum([0, *map(len, cut)])
        own = self.sizes.rows[numbers]
        each = np.diff(np.append(0, np.cumsum(own))[cuts])
        return self.ids.rows[_runs(own, self.begins.rows[numbers])], each

    def spans(self, text: str) -> np.ndarray:
        """(start, end) character offsets of a text's tokens; the pieces must be the text without gaps."""
        if len(self.index) > MOST_CACHED:
            self.forget()
        pieces = self.pieces(text)
        numbers = self._numbers(pieces)
        lengths = np.array([len(p) for p in pieces], np.int64)
        at = np.cumsum(lengths) - lengths
        own = self.sizes.rows[numbers]
        return self.offsets.rows[_runs(own, self.begins.rows[numbers])] + np.repeat(at, own)[:, None]


def encoder(path: str, split=None, spans: bool = False) -> Encoder:
    """The Python worker's encoder of a file, loaded once.

    It is kept on the tokenizers module, which outlives a task where Spark
    reuses its workers; this package is sent anew with each task.
    """
    import tokenizers

    held = tokenizers.__dict__.setdefault("_held_encoders", {})
    key = (path, getattr(split, "__name__", None), spans)
    if key not in held:
        held[key] = Encoder(path, split, spans)
    return held[key]
