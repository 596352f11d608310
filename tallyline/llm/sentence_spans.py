"""Substring dedup by sliding sentence spans.

From every sentence of a document starts one span, and one ends with it: the
shortest runs of consecutive sentences with at least ``LEAST_SENTENCES``
sentences and ``LEAST_WORDS`` words. Any longer run is covered by these: a
sentence of it with too few words after it ends a run or lies within one. Each
span is hashed and met globally; its first occurrence is the one of least
(doc_id, position). Sentences that any other occurrence covers are removed.
Spans end with their document; one of fewer words is a span as a whole, and
meets only others.

Documents are cut twice. The first time only hashes move, counted in each task
before they do; what occurs again sets two bits each in a bitmap of fixed size.
The second time only spans whose bits are set are kept and met. A corpus that
fills the bitmap costs time and disk, and loses nothing.

Sentences of more than ``LONG_WORDS`` words are cut at commas and the like, and
what is still longer after words whose hash is the least of ``NEAR`` in a row,
so that neither a long sentence nor a passage's ends inside sentences hide it:
all copies of ``NEAR`` words in a row are cut there. A repeated passage can lose
12 words at each end; of 50 words in a row at least 26 are so whole sentences.

Spans are compared without case and with single spaces, by 64-bit hash.

Nulls and ties: null and empty texts hold no span. A document is a doc_id and a
text: rows that share an id are told apart by a hash of their text, and come in
its order; rows alike in both are one document, and all keep what it keeps. A
null doc_id comes after all others. Columns other than the id and text are
ignored; an empty table gives an empty table.
"""

from __future__ import annotations

import re
from zlib import crc32

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyline.llm.common import stored, table

LEAST_SENTENCES = 2
LEAST_WORDS = 20
LONG_WORDS = 12
NEAR = 6
BITS = 1 << 27
TEXTS = 256
LAST = (1 << 63) - 1
# A sentence ends after its closing mark, or with its line; the white space that follows belongs to it.
_SENTENCE = re.compile(r"[^.!?\n]*(?:[.!?]+(?=\s|$)|\n|$|[.!?]+)\s*")
_CLAUSE = re.compile(r"[^,;:|]*(?:[,;:|]+|$)\s*")
_WORD = re.compile(r"\s*\S+\s*")


def sentences(text: str) -> list[str]:
    """The text in pieces, without gaps."""
    out = []
    for part in _SENTENCE.findall(text):
        if not part:
            continue
        if len(part.split()) <= LONG_WORDS:
            out.append(part)
            continue
        for clause in _CLAUSE.findall(part):
            if len(clause.split()) > LONG_WORDS:
                out.extend(cut_by_content(clause))
            elif clause:
                out.append(clause)
    return out


def cut_by_content(part: str) -> list[str]:
    """``part`` cut after each word whose hash is the least, and the last such, of some ``NEAR`` words in a row."""
    words = _WORD.findall(part)
    return ["".join(words[at:end]) for at, end in _cuts([w.strip().lower() for w in words])]


def _cuts(words: list[str]) -> list[tuple[int, int]]:
    """The runs of words, by first and end, that ``cut_by_content`` makes of lower-case words."""
    values = [crc32(w.encode()) for w in words]
    out, at, least = [], 0, -1
    for i in range(len(words) - NEAR + 1):
        if least < i:
            window = values[i:i + NEAR][::-1]
            least = i + NEAR - 1 - window.index(min(window))
        elif values[i + NEAR - 1] <= values[least]:
            least = i + NEAR - 1
        if least >= at:
            out.append((at, least + 1))
            at = least + 1
    return out + [(at, len(words))] if at < len(words) else out


def _signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


def _joined(text: str) -> tuple[list[str], np.ndarray]:
    """The sentences without case and with single spaces, and the number of words before each and in all."""
    if "\u03a3" in text:  # its lower case depends on what follows, also behind a sentence's end
        words = [s.lower().split() for s in sentences(text)]
    else:
        words = _sentence_words(text.lower())
    return [" ".join(w) for w in words], np.cumsum([0, *map(len, words)])


def _sentence_words(text: str) -> list[list[str]]:
    """The words of each of ``sentences``, each word split off once; the text is in lower case."""
    out = []
    for part in _SENTENCE.findall(text):
        words = part.split()
        if len(words) > LONG_WORDS:
            for clause in _CLAUSE.findall(part):
                words = clause.split()
                if len(words) > LONG_WORDS:
                    out.extend([words[at:end] for at, end in _cuts(words)])
                elif clause:
                    out.append(words)
        elif part:
            out.append(words)
    return out


def span_hashes(text: str) -> tuple[np.ndarray, np.ndarray]:
    """For each sentence that starts a span: the span's hash and its number of sentences, 0 where none starts."""
    return _starting(*_joined(text))


# Sentences' hashes are digits of a number to this odd base, modulo 2^64: a span's hash comes from two prefix sums.
_BASE = 0x9E3779B97F4A7C15
_BASE_BACK = pow(_BASE, -1, 1 << 64)


def _power_sums(joined: list[str]) -> tuple[np.ndarray, np.ndarray]:
    digest = xxhash.xxh64_intdigest
    own = np.fromiter((digest(j.encode(), 11) for j in joined), np.uint64, len(joined))
    up, back = (np.cumprod(np.append(np.uint64(1), np.full(len(own), base, np.uint64))) for base in (_BASE, _BASE_BACK))
    return np.append(np.uint64(0), np.cumsum(own * up[:-1])), back


def _of_spans(sums: np.ndarray, back: np.ndarray, begins: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """The hash of each run of sentences from ``begins`` to before ``ends``."""
    value = (sums[ends] - sums[begins]) * back[begins]
    value = (value ^ (value >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return (value ^ (value >> np.uint64(29))).view(np.int64)


def _starting(joined: list[str], counts: np.ndarray, sums=None) -> tuple[np.ndarray, np.ndarray]:
    n = len(joined)
    hashes, lengths = np.zeros(n, np.int64), np.zeros(n, np.int32)
    if 0 < counts[-1] < LEAST_WORDS:
        # The whole text, however it is cut.
        hashes[0], lengths[0] = _signed(xxhash.xxh64_intdigest(" ".join(j for j in joined if j).encode(), 12)), n
        return hashes, lengths
    ends = np.maximum(np.searchsorted(counts, counts[:-1] + LEAST_WORDS), np.arange(n) + LEAST_SENTENCES)
    at = np.flatnonzero(ends <= n)
    hashes[at] = _of_spans(*(sums or _power_sums(joined)), at, ends[at])
    lengths[at] = ends[at] - at
    return hashes, lengths


def all_spans(text: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The first sentence, the number of sentences and the hash of each span that starts or ends with a sentence."""
    joined, counts = _joined(text)
    sums = _power_sums(joined)
    hashes, lengths = _starting(joined, counts, sums)
    starts = np.flatnonzero(lengths)
    if counts[-1] < LEAST_WORDS:
        return starts, lengths[starts], hashes[starts]
    ends = np.arange(LEAST_SENTENCES, len(joined) + 1)
    begins = np.minimum(np.searchsorted(counts, counts[ends] - LEAST_WORDS, "right") - 1, ends - LEAST_SENTENCES)
    new = (begins >= 0) & (lengths[np.maximum(begins, 0)] != ends - begins)
    begins, ends = begins[new], ends[new]
    return np.append(starts, begins), np.append(lengths[starts], ends - begins), np.append(hashes[starts], _of_spans(*sums, begins, ends))


def _found(text: str | None, ending: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    if ending:
        return all_spans(text or "")
    hashes, lengths = span_hashes(text or "")
    starts = np.flatnonzero(lengths)
    return starts, lengths[starts], hashes[starts]


def _documents(docs: DataFrame) -> DataFrame:
    return docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST)).alias("id"), F.xxhash64("text").alias("row"), "text")


def spans(docs: DataFrame, ending: bool = False, bits=None) -> DataFrame:
    """``id, row, pos, n, hash`` of every span; a null doc_id is ``LAST``, and ``row`` a hash of the text.

    ``ending``: also those found by their last sentence. ``bits``: only those whose hash may be in this broadcast bitmap.
    """
    def run(batches):
        for batch in batches:
            parts = [[] for _ in range(5)]
            for doc_id, row, text in zip(*(batch.column(i).to_pylist() for i in range(2)), batch.column(2)):
                starts, lengths, hashes = _found(text.as_py(), ending)
                if bits is not None:
                    may = _may(bits.value, hashes)
                    starts, lengths, hashes = starts[may], lengths[may], hashes[may]
                for held, new in zip(parts, (np.full(len(starts), doc_id), np.full(len(starts), row), starts, lengths, hashes)):
                    held.append(new)
            if parts[0]:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(x).astype(kind)) for x, kind in zip(parts, (np.int64, np.int64, np.int32, np.int32, np.int64))],
                    ["id", "row", "pos", "n", "hash"])

    return _documents(docs).mapInArrow(run, "id long, row long, pos int, n int, hash long")


def _hashes(docs: DataFrame, ending: bool) -> DataFrame:
    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, TEXTS):
                found = [_found(t.as_py(), ending)[2] for t in batch.column(0).slice(at, TEXTS)]
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(found).astype(np.int64))], ["hash"])

    return docs.select("text").mapInArrow(run, "hash long")


def _places(bits: int = BITS):
    """The two bits of a hash, as columns."""
    mask = F.lit(bits - 1)
    return F.col("hash").bitwiseAND(mask), F.shiftrightunsigned("hash", 32).bitwiseAND(mask)


def _may(bitmap: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    mask = np.uint64(BITS - 1)
    whole = hashes.astype(np.int64).view(np.uint64)
    one, two = whole & mask, (whole >> np.uint64(32)) & mask
    is_set = lambda at: (bitmap[(at >> np.uint64(3)).astype(np.int64)] >> (at & np.uint64(7)).astype(np.uint8)) & 1
    return (is_set(one) & is_set(two)).astype(bool)


def repeated_bits(docs: DataFrame, ending: bool = False) -> np.ndarray:
    """A bitmap of ``BITS`` bits with those of every hash that occurs more than once; it alone comes to the driver."""
    again = _hashes(docs, ending).groupBy("hash").agg(F.count("*").alias("n")).filter("n > 1")
    at = again.select(F.explode(F.array(*_places())).alias("at"))
    # Spark numbers buckets from 1 and, in them, bits from 0; a bucket is a row of 4 KiB.
    rows = at.groupBy(F.bitmap_bucket_number(F.col("at") + 1).alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(F.col("at") + 1)).alias("bits")).collect()
    out = np.zeros(BITS // 8, np.uint8)
    for bucket, bits in rows:
        out[(bucket - 1) * len(bits):bucket * len(bits)] = np.frombuffer(bits, np.uint8)
    return out


def repeats(docs: DataFrame, ending: bool = False) -> DataFrame:
    """``id, row, pos, n`` of every span that is not the first of its kind."""
    bits = docs.sparkSession.sparkContext.broadcast(repeated_bits(docs, ending))  # BITS / 8 bytes
    found = stored(spans(docs, ending, bits), "sentence-spans", "zstd")
    place = F.struct("id", "row", "pos")
    # Stored, so that both sides of the join are plain shuffles: adaptive execution splits the spans of a hot hash.
    firsts = stored(found.groupBy("hash").agg(F.min(place).alias("first"), F.max(place).alias("last"))
                    .filter("first <> last").select("hash", "first"), "sentence-firsts", "zstd")
    return found.join(firsts, "hash").filter(place != F.col("first")).select("id", "row", "pos", "n").distinct()


def _removals(docs: DataFrame, ending: bool) -> DataFrame:
    covered = F.array_sort(F.array_distinct(F.flatten(F.collect_list(F.sequence("pos", F.col("pos") + F.col("n") - 1)))))
    return repeats(docs, ending).groupBy("id", "row").agg(F.count("*").alias("n_spans"), covered.alias("removed"))


def removals(docs: DataFrame, ending: bool = False) -> DataFrame:
    """``doc_id, n_spans, removed`` per document that loses sentences; ``removed`` are their numbers, from 0.

    ``ending``: by all spans, as the query and ``deduplicated`` do; else by those of ``span_hashes``.
    """
    return _removals(docs, ending).select(F.when(F.col("id") != LAST, F.col("id")).alias("doc_id"), "n_spans", "removed")


def deduplicated(docs: DataFrame) -> DataFrame:
    """``docs`` with the repeated sentences taken out of ``text``; other columns as they are."""
    gone = _removals(docs, ending=True).select(F.col("id").alias("of"), F.col("row").alias("of_row"), "removed")
    rows = docs.select(F.struct(*docs.columns).alias("all"), F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST)).alias("id"),
                       F.xxhash64("text").alias("row"), "text")
    joined = rows.join(gone, (F.col("id") == F.col("of")) & (F.col("row") == F.col("of_row")), "left").select(
        F.col("all").alias("row"), "text", "removed")

    def run(batches):
        for batch in batches:
            kept = []
            for text, removed in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                if removed:
                    gone_here = set(removed)
                    text = "".join(s for i, s in enumerate(sentences(text)) if i not in gone_here)
                kept.append(text)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(kept, pa.string())], ["row", "kept"])

    out = joined.mapInArrow(run, joined.select("row", F.col("text").alias("kept")).schema)
    return out.select(*[F.col("kept").alias(c) if c == "text" else F.col("row")[c].alias(c) for c in docs.columns])


def query(spark, sf_dir: str) -> DataFrame:
    """Documents that lose sentences, and which."""
    return removals(table(spark, sf_dir, "documents"), ending=True).withColumn("n_removed", F.size("removed"))
