"""Benchmark decontamination by template windows.

A text becomes a sequence of template tokens: numbers, names (capitalised words)
and units after a number give way to typed placeholders, and what was there is
kept as the slot's value. A question whose figures and names were changed keeps
its template. Windows of ``WINDOW`` template tokens are hashed; a document's
window is joined to the benchmark's by hash. A second view in which only
numbers and units are slots and letters are lower-cased catches a passage whose
capitals were changed.

A match counts if its slots are consistent: over a run of touching windows in
which a document follows an item at the same distance, each value of the item
stands for one value of the document; two values may become the same. A window
whose slots hold what the item's hold counts whatever its run. A window needs ``LITERALS`` words that are not
slots, unless its slots hold what the item's hold. Items shorter than a window
are one window of their length.

Documents are cut in one scan. Windows pass a Bloom filter of fixed size over
the benchmark's hashes before the join, so what is shuffled is what may match;
a benchmark that fills the filter costs time and loses nothing.

Nulls and ties: null and empty texts match nothing; an item without words
matches nothing. A document is a doc_id, null or not, and a text: rows that share
an id are matched apart, and each row gets the result of its own text. Items that
share an id are one item of several texts. Columns other than the id and text are
ignored; an empty table gives an empty table.
"""

from __future__ import annotations

import re
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyline.llm import octets
from tallyline.llm.common import stored, table
from tallyline.llm.vocabulary import Grown

WINDOW = 12
LITERALS = 6
BLOOM_BITS = 1 << 23
MOST_CACHED = 500_000
TEXTS = 128
# Spelled-out numbers and unit names that templates treat as slots.
NUMBER_WORDS = frozenset("zero one two three four five six seven eight nine ten eleven twelve twenty thirty forty fifty "
                         "sixty seventy eighty ninety hundred thousand million billion".split())
UNITS = frozenset("mm cm m km in ft yd mi mg g kg t lb oz ml l s sec min h hr hrs ms hz khz mhz ghz w kw v a j kj cal kcal "
                  "b kb mb gb tb percent % usd eur dollars euros cents seconds minutes hours days weeks months years "
                  "meters metres kilometers kilometres grams kilograms liters litres miles feet inches pounds".split())
_NUMBER = re.compile(r"[+-]?[$€£]?\d[\d.,:/]*%?$")
_EDGE = ".,;:!?\"'()[]{}«»“”‘’…|*#&$%_-"
_NAME, _NUM, _UNIT = (xxhash.xxh64_intdigest(kind, 7) for kind in (b"<name>", b"<number>", b"<unit>"))
_FACTOR = 0x9E3779B97F4A7C15 | 1
# What a byte is: ASCII letters and signs, marks that a token may lose at its ends, digits and bytes beyond ASCII, white space.
_WORD, _MARK, _OTHER, _GAP = 0, 1, 2, 3
_KIND = np.array([_GAP if chr(b).isspace() and b < 128 else _MARK if chr(b) in _EDGE and b < 128
                  else _OTHER if b > 127 or chr(b).isdigit() else _WORD for b in range(256)], np.uint8)


def classify(token: str) -> tuple[str, bool, bool, bool] | None:
    """(lower-cased, is number, is unit word, is name) of a token; None if only punctuation."""
    bare = token.strip(_EDGE)
    if not bare:
        return None
    low = bare.lower()
    if _NUMBER.match(bare) or low in NUMBER_WORDS:
        return low, True, False, False
    return low, False, low in UNITS, bare[0].isupper()


class Among:
    """Whether hashes are those of certain words; most of the others are told by their low bits."""

    def __init__(self, words: frozenset[str]):
        self.hashes = octets.hashes_of([w.encode() for w in words])
        self.low = np.zeros(1 << 16, bool)
        self.low[self.hashes & np.uint64(0xFFFF)] = True

    def __call__(self, hashes: np.ndarray) -> np.ndarray:
        out = self.low[hashes & np.uint64(0xFFFF)]
        at = np.flatnonzero(out)
        out[at] = np.isin(hashes[at], self.hashes)
        return out


class Templates:
    """Template tokens of texts: words of common Latin letters all at once, with a table of the others seen."""

    def __init__(self):
        self.number_words, self.units = Among(NUMBER_WORDS), Among(UNITS)
        self.forget()

    def forget(self) -> None:
        self.known: dict[bytes, int] = {}
        self.own, self.marks = Grown(np.uint64), Grown(np.uint8)

    def _learn(self, tokens: list[bytes]) -> None:
        rows = [classify(t.decode()) or ("", False, False, False) for t in tokens]
        self.known.update(zip(tokens, range(len(self.known), len(self.known) + len(tokens))))
        self.own.add(octets.hashes_of([r[0].encode() for r in rows]))
        self.marks.add(np.array([bool(r[0]) + 2 * r[1] + 4 * r[2] + 8 * r[3] for r in rows], np.uint8))

    def _looked_up(self, tokens: list[bytes]) -> np.ndarray:
        if len(self.known) > MOST_CACHED:
            self.forget()
        numbers = list(map(self.known.get, tokens))
        if None in numbers:
            self._learn(list(dict.fromkeys(t for t, n in zip(tokens, numbers) if n is None)))
            numbers = list(map(self.known.get, tokens))
        return np.array(numbers, np.int64)

    def tokens(self, texts: list[str]):
        """Gives a token's value as a slot, the end of each text among the tokens, and per view the hashes and slot marks."""
        raw, text_ends = octets.joined(texts)
        octets.blank_spaces(raw)
        low, latin = octets.lowered(raw)
        kind = _KIND[raw]
        kind[latin] = kind[latin + 1] = _WORD
        begins, ends = octets.words(kind == _GAP)
        odd = np.zeros(len(begins), bool)
        odd[np.searchsorted(begins, np.flatnonzero(kind == _OTHER), "right") - 1] = True
        # A token without its edges: from its first to its last byte that is none.
        inner = (kind & 1) == 0
        inner_at, n_inner = np.flatnonzero(inner), np.add.reduceat(inner, begins, dtype=np.int64)
        last = np.cumsum(n_inner)
        full = n_inner > 0  # the others are punctuation
        begins, ends, odd, last, n_inner = begins[full], ends[full], odd[full], last[full], n_inner[full]
        at = inner_at[last - n_inner]
        sizes = inner_at[last - 1] + 1 - at
        odd |= sizes > octets.LONGEST
        own = octets.hashes(low, at, np.minimum(sizes, octets.LONGEST))
        number = self.number_words(own)
        name = (raw[at] != low[at]) | ((raw[at] == 0xC3) & (raw[at + 1] != low[at + 1]))
        marks = 1 + 2 * number.astype(np.uint8) + 8 * (name & ~number).astype(np.uint8)
        data = raw.tobytes()
        others = np.flatnonzero(odd)
        if len(others):
            rows = self._looked_up([data[a:b] for a, b in zip(begins[others].tolist(), ends[others].tolist())])
            own[others], marks[others] = self.own.rows[rows], self.marks.rows[rows]
            kept = (marks & 1) > 0
            begins, ends, own, marks = begins[kept], ends[kept], own[kept], marks[kept]
        text_ends = np.searchsorted(begins, text_ends)
        number, name = (marks & 2) > 0, (marks & 8) > 0
        after = np.flatnonzero(number[:-1]) + 1
        unit = np.zeros(len(own), bool)
        unit[after] = ~number[after] & self.units(own[after])
        firsts = np.append(0, text_ends[:-1])
        unit[firsts[firsts < len(unit)]] = False
        own[number], own[unit] = _NUM, _UNIT
        named = own.copy()
        named[name & ~unit] = _NAME
        slot = number | unit

        def value(i: int) -> str:
            return data[begins[i]:ends[i]].decode().strip(_EDGE).lower()

        return value, text_ends, [(own, slot), (named, slot | (name & ~unit))]


def window_hashes(tokens: np.ndarray, width: int) -> np.ndarray:
    """A hash of every run of ``width`` tokens."""
    out = np.zeros(max(len(tokens) - width + 1, 0), np.uint64)
    for i in range(width):
        out = out * np.uint64(_FACTOR) + tokens[i:len(tokens) - width + 1 + i]
    out ^= out >> np.uint64(29)
    return out * np.uint64(0xBF58476D1CE4E5B9) ^ np.uint64(width)


WINDOWS = "id long, row long, view int, pos int, hash long, slots array<string>, width int"


def windows(texts: DataFrame, widths: tuple[int, ...], bloom=None, whole_short: bool = False) -> DataFrame:
    """Template windows of ``texts(id, row, text)``; with ``bloom`` only those that may be the benchmark's.

    ``whole_short``: a text shorter than the one width given is one window of its length.
    """
    def run(batches):
        cut, bits = Templates(), None if bloom is None else bloom.value
        for batch in batches:
            for at in range(0, batch.num_rows, TEXTS):
                yield found_in(cut, bits, batch.slice(at, TEXTS))

    def found_in(cut, bits, part):
        value, ends, views = cut.tokens([t or "" for t in part.column(2).to_pylist()])
        sizes = np.diff(np.append(0, ends))
        out = []
        for view, (tokens, slot) in enumerate(views):
            for width in sorted(set(np.minimum(widths[0], sizes).tolist()) - {0}) if whole_short else widths:
                hashes = window_hashes(tokens, width)
                take = np.arange(len(hashes)) if bits is None else np.flatnonzero(_may(bits, hashes))
                doc = np.searchsorted(ends, take, "right")
                inside = take + width <= ends[doc]
                if whole_short:
                    inside &= np.minimum(widths[0], sizes)[doc] == width
                for i, d in zip(take[inside].tolist(), doc[inside].tolist()):
                    slots = [value(i + j) for j in np.flatnonzero(slot[i:i + width])]
                    out.append((d, view, i - int(ends[d] - sizes[d]), int(hashes[i:i + 1].view(np.int64)[0]), slots, width))
        d, view, pos, hashes, slots, width = zip(*out) if out else ((),) * 6
        rows = pa.array(d, pa.int64())
        return pa.RecordBatch.from_arrays(
            [part.column(0).take(rows), part.column(1).take(rows), pa.array(view, pa.int32()), pa.array(pos, pa.int32()),
             pa.array(hashes, pa.int64()), pa.array(slots, pa.list_(pa.string())), pa.array(width, pa.int32())],
            ["id", "row", "view", "pos", "hash", "slots", "width"])

    return texts.mapInArrow(run, WINDOWS)


def _probes(hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    mask = np.uint64(BLOOM_BITS - 1)
    return hashes & mask, (hashes >> np.uint64(32)) & mask


def _may(bits: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    a, b = _probes(hashes)
    out = bits[a.astype(np.int64)]
    at = np.flatnonzero(out)
    out[at] = bits[b[at].astype(np.int64)]
    return out


def bloom_of(items: DataFrame) -> np.ndarray:
    """The filter over the hashes of ``items``; at most ``BLOOM_BITS`` numbers come to the driver."""
    mask = F.lit(BLOOM_BITS - 1)
    places = items.select(F.explode(F.array(F.col("hash").bitwiseAND(mask), F.shiftrightunsigned("hash", 32).bitwiseAND(mask)))
                          .alias("place")).distinct().toPandas()
    bits = np.zeros(BLOOM_BITS, bool)
    bits[places["place"].to_numpy(np.int64)] = True
    return bits


def matches(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, literals: int = LITERALS) -> DataFrame:
    """``doc_id, row, item_id, n_windows, first_pos, last_pos`` per document of ``keyed`` rows and item found in it."""
    spark = docs.sparkSession
    texts = benchmark.select(F.col("item_id").cast("long").alias("id"), F.lit(0).cast("long").alias("row"), "text")
    items = stored(windows(texts, (window,), whole_short=True), "template-items")
    widths = tuple(sorted(r[0] for r in items.select("width").distinct().collect()))  # 1 to window
    bloom = spark.sparkContext.broadcast(bloom_of(items))  # BLOOM_BITS bytes
    own = windows(docs.select(F.col("doc_id").alias("id"), "row", "text"), widths, bloom)
    i, d = items.alias("i"), own.alias("d")
    met = d.join(i, (F.col("d.hash") == F.col("i.hash")) & (F.col("d.view") == F.col("i.view"))
                 & (F.col("d.width") == F.col("i.width")) & (F.size("d.slots") == F.size("i.slots")))
    same = F.col("d.slots") == F.col("i.slots")
    met = met.filter(same | (F.col("d.width") - F.size("d.slots") >= literals)).select(
        F.col("d.id").alias("doc_id"), "d.row", F.col("i.id").alias("item_id"), "d.view", "d.pos", "d.width", same.alias("same"), (F.col("d.pos") - F.col("i.pos")).alias("shift"),
        F.arrays_zip(F.col("i.slots").alias("item"), F.col("d.slots").alias("doc")).alias("pairs"))
    # An alignment has a window per position of the item, so its sort is small.
    along = Window.partitionBy("doc_id", "row", "item_id", "view", "shift").orderBy("pos")
    begins = F.when(F.col("pos") - F.lag("pos").over(along) <= F.col("width"), 0).otherwise(1)
    met = stored(met.withColumn("begins", begins).withColumn("run", F.sum("begins").over(along)), "template-matches")
    key = ["doc_id", "row", "item_id", "view", "shift", "run"]
    pairs = met.select(*key, F.explode("pairs").alias("pair")).distinct()
    # An item's value that stands for two others breaks the run.
    broken = (pairs.groupBy(*key).agg(F.count("*").alias("n"), F.countDistinct("pair.item").alias("a"))
              .filter("n > a").select(*[F.col(c).alias(f"b_{c}") for c in key], F.lit(True).alias("broken")))
    alike = reduce(Column.__and__, [F.col(c).eqNullSafe(F.col(f"b_{c}")) for c in key])
    sound = met.join(broken, alike, "left").filter("same or broken is null")
    return sound.groupBy("doc_id", "row", "item_id").agg(F.countDistinct("pos").cast("long").alias("n_windows"),
                                               F.min("pos").alias("first_pos"), F.max("pos").alias("last_pos"))


def keyed(docs: DataFrame) -> DataFrame:
    """``doc_id, row, text``: ``row`` is a hash of the text, which tells rows of one id apart."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("row"), "text")


def _with(rows: DataFrame, found: DataFrame, how: str) -> DataFrame:
    """``rows`` joined with what was found in their documents; ``found`` brings its key as ``of_id, of_row``."""
    return rows.join(found, F.col("doc_id").cast("long").eqNullSafe(F.col("of_id")) & (F.xxhash64("text") == F.col("of_row")), how)


def clean(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs`` in which no item is found, with their columns."""
    # Stored, so that its size is known: Spark broadcasts a small list and shuffles both sides of a large one.
    bad = stored(matches(keyed(docs), benchmark).select(F.col("doc_id").alias("of_id"), F.col("row").alias("of_row")).distinct(),
                 "template-rows")
    rows = docs.select("doc_id", "text", F.struct(*docs.columns).alias("all_"))
    return _with(rows, bad, "left_anti").select("all_.*")


def query(spark, sf_dir: str) -> DataFrame:
    """A row per row of documents and benchmark item found in it."""
    docs = table(spark, sf_dir, "documents")
    found = matches(keyed(docs), table(spark, sf_dir, "benchmark"))
    found = stored(found.withColumnsRenamed({"doc_id": "of_id", "row": "of_row"}), "template-found")
    return _with(docs.select("doc_id", "text"), found, "inner").select(
        F.col("doc_id").cast("long").alias("doc_id"), "item_id", "n_windows", "first_pos", "last_pos")
