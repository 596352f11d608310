"""BPE encoding by forced boundaries, and decoding.

Merges only ever make tokens of the vocabulary. So where two neighbouring byte
symbols stand side by side inside no token at all, no merge can join what is left
of them with what is right: the place between is a certain cut. A piece of text is
cut at all such places, each fragment goes through the merges alone, and the
fragments' tokens in a row are the piece's. A symbol that ends a word is a symbol
of its own where the file marks word ends, so the pairs keep that apart.

Fragments are few and short whatever the texts hold (a piece of a million letters
falls apart into fragments too), so each distinct one is merged once per worker.
Their merges use a heap, so that a fragment without a certain cut takes
O(n log n) however long it is.

Normalisation and the cutting of texts into pieces are the file's own steps. Texts of
common letters go a shorter way to the same pieces: for each character of a fixed
range the file's normaliser and pre-tokenizer are asked once what they make of it, and
only characters that stay one character of that range, of a known class, are taken.

Nulls and ties: a null text is empty and has no tokens; rows that repeat, or share
an id, get a result each. Strings of special tokens in a text become those tokens, as
the library has it. Truncation and padding of the file are not used. Columns besides
the id and text are ignored; an empty table gives an empty table.
"""

from __future__ import annotations

import heapq
import json
import os
import re
import sys
from itertools import chain
from types import ModuleType

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyline.llm.common import table
from tallyline.llm.vocabulary import Grown, _flat, _runs

# Characters whose class is asked for: Latin and common punctuation. All are stable under NFC.
PROBED = [*range(0x20), *range(0x20, 0x7F), *range(0xA0, 0x250), *range(0x2010, 0x2028), *range(0x2030, 0x205F), 0x20AC]
MOST_FRAGMENTS = 200_000
MOST_PIECES = 300_000
BATCH_CHARS = 1 << 20


def byte_letters() -> list[str]:
    """The printable character that stands for each byte: itself, or the next from 256 on."""
    own = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    return [chr(b) if b in own else chr(256 + b - sum(o < b for o in own)) for b in range(256)]


class Merger:
    """The merges of a vocabulary, run on fragments between certain cuts."""

    def __init__(self, vocabulary: dict[str, int], merges: list, suffix: str = ""):
        self.vocabulary, self.suffix = vocabulary, suffix
        pairs = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in merges]
        self.rank = {pair: n for n, pair in enumerate(pairs)}
        self.inside = {pair for token in vocabulary for pair in self._pairs(self.symbols(token))}
        self.known: dict[tuple[str, ...], list[int]] = {}

    @staticmethod
    def _pairs(symbols: list[str]):
        return zip(symbols, symbols[1:])

    def symbols(self, token: str) -> list[str]:
        """The byte symbols of a token; the last one with its word end, if it has one."""
        if self.suffix and token.endswith(self.suffix) and token != self.suffix:
            body = token[:-len(self.suffix)]
            return [*body[:-1], body[-1] + self.suffix]
        return list(token)

    def fragments(self, letters: str) -> list[tuple[str, ...]]:
        """A piece's symbols, cut at every pair that no token holds."""
        symbols = [*letters[:-1], letters[-1] + self.suffix]
        inside = self.inside
        cuts = [0, *(i for i, pair in enumerate(self._pairs(symbols), 1) if pair not in inside), len(symbols)]
        return [tuple(symbols[a:b]) for a, b in zip(cuts, cuts[1:])]

    def merged(self, fragment: tuple[str, ...]) -> list[int]:
        """Ids of one fragment: always the merge of least rank next, the leftmost of equals."""
        parts: list[str | None] = list(fragment)
        after, before = list(range(1, len(parts) + 1)), list(range(-1, len(parts) - 1))
        rank = self.rank
        heap = [(rank[pair], i) for i, pair in enumerate(self._pairs(parts)) if pair in rank]
        heapq.heapify(heap)
        while heap:
            r, i = heapq.heappop(heap)
            j = after[i]
            # A merge nearby may have taken either part since.
            if parts[i] is None or j >= len(parts) or rank.get((parts[i], parts[j])) != r:
                continue
            parts[i], parts[j] = parts[i] + parts[j], None
            after[i] = after[j]
            if after[i] < len(parts):
                before[after[i]] = i
                pair = (parts[i], parts[after[i]])
                if pair in rank:
                    heapq.heappush(heap, (rank[pair], i))
            if before[i] >= 0:
                pair = (parts[before[i]], parts[i])
                if pair in rank:
                    heapq.heappush(heap, (rank[pair], before[i]))
        return [self.vocabulary[p] for p in parts if p is not None]

    def encode(self, letters: str) -> list[int]:
        """Ids of one piece, written in byte letters."""
        out, fragments = [], self.fragments(letters)
        if len(fragments) == 1:
            return self.merged(fragments[0])
        for fragment in fragments:
            ids = self.known.get(fragment)
            if ids is None:
                if len(self.known) >= MOST_FRAGMENTS:
                    self.known.clear()
                ids = self.merged(fragment)
                if len(fragment) <= 64:
                    self.known[fragment] = ids
            out += ids
        return out


class Simple:
    """The pieces of texts whose characters the file is known to take one by one."""

    CONTRACTIONS = "'s|'t|'re|'ve|'m|'ll|'d"
    STEPS = ["NFC", "Replace", "Lowercase"]

    def __init__(self, tokenizer):
        normal, cut = tokenizer.normalizer.normalize_str, tokenizer.pre_tokenizer.pre_tokenize_str
        sort: dict[str, str] = {}
        for c in map(chr, PROBED):
            low = normal(c)
            if len(low) == 1 and (low == c.lower() or low == " "):
                sort[c] = {1: "letter", 2: "space", 3: "mark", 4: "number"}[len(cut(f"a{low}{low}a"))]
        # Lower-casing must not lead out of what is known.
        sort = {c: kind for c, kind in sort.items() if kind == "space" or sort.get(c.lower()) == kind}
        of = lambda *kinds: "".join(re.escape(c) for c, kind in sort.items() if kind in kinds)
        self.fits = re.compile(f"[{of('letter', 'number', 'mark', 'space')}]*").fullmatch
        self.cut = re.compile(f"{self.CONTRACTIONS}|[{of('letter')}]+|[{of('number')}]|[{of('mark')}]+").findall

    @classmethod
    def of(cls, said: dict, tokenizer) -> Simple | None:
        """None where the file works in another way."""
        normal, cut = said.get("normalizer") or {}, said.get("pre_tokenizer") or {}
        steps = [x["type"] for x in normal.get("normalizers", ())], [x["type"] for x in cut.get("pretokenizers", ())]
        if steps != (cls.STEPS, ["Split", "ByteLevel"]):
            return None
        split, byte_level = cut["pretokenizers"]
        pattern = rf"{cls.CONTRACTIONS}|[\p{{L}}]+|[\p{{N}}]|[^\s\p{{L}}\p{{N}}]+"
        if split["pattern"].get("Regex") != pattern or not split["invert"] or split["behavior"] != "Removed":
            return None
        return None if byte_level["add_prefix_space"] or byte_level["use_regex"] else cls(tokenizer)


class ForcedBoundaries:
    """Encoder and decoder of one tokenizer file (byte-level BPE)."""

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # Spark has a task on every core
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as file:
            said = json.load(file)
        model = said["model"]
        if model["type"] != "BPE" or model.get("byte_fallback") or model.get("ignore_merges") or model.get("dropout"):
            raise ValueError("not a plain byte-level BPE file")
        self.tokenizer = Tokenizer.from_file(path)  # for its normaliser, pre-tokenizer and decoder; the merges are run here
        self.merger = Merger(model["vocab"], model["merges"], model.get("end_of_word_suffix") or "")
        self.special = {t["content"]: t["id"] for t in said["added_tokens"]}
        if any(t["single_word"] or t["lstrip"] or t["rstrip"] or t["normalized"] for t in said["added_tokens"]):
            raise ValueError("special tokens that reach beyond their own string")
        longest = sorted(self.special, key=len, reverse=True)
        self.at_special = re.compile("(" + "|".join(map(re.escape, longest)) + ")") if longest else None
        tokens = dict(chain(model["vocab"].items(), self.special.items()))
        self.tokens = [""] * (max(tokens.values()) + 1)
        for token, n in tokens.items():
            self.tokens[n] = token
        self.written = pa.array(self.tokens, pa.string())
        self.joined = said.get("decoder") is None
        self.letters = dict(enumerate(byte_letters()))
        self.bytes = {letter: b for b, letter in self.letters.items()}
        self.simple = Simple.of(said, self.tokenizer)
        self.forget()

    def forget(self) -> None:
        self.index: dict[str, int] = {}
        self.ids, self.sizes, self.begins = Grown(np.uint32), Grown(np.int64), Grown(np.int64)

    def _own_pieces(self, text: str) -> list[str]:
        """By the file's own normaliser and pre-tokenizer. A piece is whole characters, so its bytes are text again."""
        if self.tokenizer.normalizer is not None:
            text = self.tokenizer.normalizer.normalize_str(text)
        byte = self.bytes.__getitem__
        return [bytes(map(byte, piece)).decode() for piece, _ in self.tokenizer.pre_tokenizer.pre_tokenize_str(text)]

    def _plain_pieces(self, text: str) -> list[str]:
        if self.simple is None:
            return self._own_pieces(text)
        if self.simple.fits(text):
            return self.simple.cut(text.lower())
        # No piece crosses a space, and no character is composed with one.
        out = []
        for part in text.split(" "):
            out += self.simple.cut(part.lower()) if self.simple.fits(part) else self._own_pieces(part)
        return out

    def pieces(self, text: str) -> list[str | int]:
        """What is merged alone, in order; a special token is its id."""
        if self.at_special is None or self.at_special.search(text) is None:
            return self._plain_pieces(text)
        out = []
        for n, part in enumerate(self.at_special.split(text)):
            out += [self.special[part]] if n % 2 else self._plain_pieces(part)
        return out

    def _learn(self, new: list[str | int]) -> None:
        coded = [[p] if isinstance(p, int) else self.merger.encode(p.encode().decode("latin-1").translate(self.letters)) for p in new]
        ids, sizes = _flat(coded)
        self.index.update(zip(new, range(len(self.index), len(self.index) + len(new))))
        self.begins.add(self.ids.size + np.cumsum(sizes) - sizes)
        self.sizes.add(sizes)
        self.ids.add(ids)

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts end to end, and how many each has."""
        if len(self.index) > MOST_PIECES:
            self.forget()
        cut = [self.pieces(t) for t in texts]
        flat = list(chain.from_iterable(cut))
        index = self.index
        new = [p for p in dict.fromkeys(flat) if p not in index]
        if new:
            self._learn(new)
        numbers = np.fromiter(map(index.__getitem__, flat), np.int64, len(flat))
        own = self.sizes.rows[numbers]
        ends = np.append(0, np.cumsum(own))[np.cumsum([0, *map(len, cut)])]
        return self.ids.rows[_runs(own, self.begins.rows[numbers])], np.diff(ends)

    def decode(self, ids: np.ndarray, sizes: np.ndarray) -> pa.Array:
        """The text of each run of ids. Without a decoder in the file, tokens as they are written, a space between."""
        ends = np.append(0, np.cumsum(sizes))
        if self.joined:
            return pc.binary_join(pa.ListArray.from_arrays(pa.array(ends, pa.int32()), self.written.take(pa.array(ids))), " ")
        return pa.array([self.tokenizer.decode(ids[a:b].tolist(), skip_special_tokens=False) for a, b in zip(ends, ends[1:])], pa.string())


def held(path: str) -> ForcedBoundaries:
    """The Python worker's encoder of a file, made once."""
    # This package is sent anew with each task, so its own modules do not outlive one; a module of this name does.
    kept = sys.modules.setdefault("_tallyline_encoders", ModuleType("_tallyline_encoders")).__dict__
    if path not in kept:
        kept[path] = ForcedBoundaries(path)
    return kept[path]


def _sliced(lengths: np.ndarray) -> list[tuple[int, int]]:
    """(begin, end) of runs of rows of a bounded number of characters, a row at least."""
    part = np.append(0, np.cumsum(lengths[:-1])) // BATCH_CHARS if len(lengths) else lengths
    begins = np.flatnonzero(np.append(True, np.diff(part) > 0)) if len(lengths) else np.zeros(0, int)
    return list(zip(begins.tolist(), [*begins[1:].tolist(), len(lengths)]))


def _lists(ids: np.ndarray, sizes: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(sizes)), pa.int32()), pa.array(ids.astype(np.int32)))


def encoded(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, ids`` for each row of ``docs``."""
    def run(batches):
        encoder = held(path)
        for batch in batches:
            texts = batch.column(1).fill_null("")
            for a, b in _sliced(pc.binary_length(texts).to_numpy(zero_copy_only=False).astype(np.int64)):
                ids, sizes = encoder.encode(texts.slice(a, b - a).to_pylist())
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a), _lists(ids, sizes)], ["doc_id", "ids"])

    return docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(
        run, f"doc_id {docs.schema[id_col].dataType.simpleString()}, ids array<int>")


def decoded(rows: DataFrame, path: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """``doc_id, ids, text`` for each row of ``rows``; null ids are none."""
    def run(batches):
        encoder = held(path)
        for batch in batches:
            lists = batch.column(1)
            sizes = pc.list_value_length(lists).fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
            flat, done = lists.flatten(), np.append(0, np.cumsum(sizes))
            for a, b in _sliced(4 * sizes):
                text = encoder.decode(flat.slice(done[a], done[b] - done[a]).to_numpy(), sizes[a:b])
                yield pa.RecordBatch.from_arrays([*(c.slice(a, b - a) for c in batch.columns), text], ["doc_id", "ids", "text"])

    return rows.select(F.col(id_col).alias("doc_id"), F.col(ids_col).alias("ids")).mapInArrow(
        run, f"doc_id {rows.schema[id_col].dataType.simpleString()}, ids array<int>, text string")


def round_trip(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, ids, text``: what ``decoded(encoded(docs))`` gives, in one pass with one set of workers."""
    def run(batches):
        encoder = held(path)
        for batch in batches:
            texts = batch.column(1).fill_null("")
            for a, b in _sliced(pc.binary_length(texts).to_numpy(zero_copy_only=False).astype(np.int64)):
                ids, sizes = encoder.encode(texts.slice(a, b - a).to_pylist())
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(a, b - a), _lists(ids, sizes), encoder.decode(ids, sizes)], ["doc_id", "ids", "text"])

    return docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(
        run, f"doc_id {docs.schema[id_col].dataType.simpleString()}, ids array<int>, text string")


def query(spark, sf_dir: str, path: str | None = None) -> DataFrame:
    import public_tokenizers

    path = path or public_tokenizers.path("word_bpe_49k.json")
    both = round_trip(table(spark, sf_dir, "documents"), path)
    digest = lambda c: F.sha2(c.cast("binary"), 256)
    return both.select("doc_id", F.size("ids").cast("long").alias("n_tokens"),
                       digest(F.array_join(F.col("ids").cast("array<string>"), " ")).alias("ids_sha256"),
                       digest(F.col("text")).alias("decoded_sha256"))
