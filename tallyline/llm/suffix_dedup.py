"""Suffix-array dedup: bytes of repeated strings go from all but the smallest document.

A byte is removed if a string of ``LENGTH`` bytes that covers it also starts in
a document of smaller doc_id. Overlaps count, strings never cross documents,
and what is repeated is judged on the texts as given.

A suffix array of everything would sort every byte position. Here, only
suffixes that may repeat are sorted:

1. Each string of ``LENGTH`` bytes is governed by an anchor, the least hashed
   ``GRAM`` bytes within it, so equal strings have equal anchors. Anchors
   (about one in 17 bytes) are met by hash, and those of one document alone drop out.
2. The stretches of text governed by the shared anchors are dealt out by anchor,
   and each task builds the suffix array of its stretches by deep-shallow
   sorting: a multikey sort over characters of eight bytes down to ``SHALLOW``
   bytes, then a blind trie for each group that is still equal. A trie node
   looks only at the byte where its suffixes part; all tries of a task grow
   level by level together. Suffixes of one leaf share ``LENGTH`` bytes, and the
   least doc_id among them decides.
3. The covered bytes meet their documents.

Copies of a stretch within a task's batch are sent once: those of larger
documents are covered whatever the others hold. A batch, a bucket of
stretches and a document are each of bounded size.

Nulls and ties: a null text counts as empty; a null doc_id is larger than any
other; rows of one doc_id never remove from each other; repeated rows each get
their result; columns other than the id and text are ignored; an empty table
gives an empty table. Texts are UTF-8 bytes, and what is kept may not be valid UTF-8.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyline.llm.common import stored, table

LENGTH = 50
GRAM = 16
SHALLOW = 16
BATCH_BYTES = 2 << 20
BUCKET_BYTES = 2 << 20
PART = 1 << 15
LAST = (1 << 63) - 1
_BASE = 0x9E3779B97F4A7C15
_VALUES = np.random.default_rng(17).integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_POSITION = np.uint64((1 << 24) - 1)


def _power(n: int) -> np.uint64:
    return np.uint64(pow(_BASE, n, 1 << 64))


def gram_hashes(values: np.ndarray, size: int) -> np.ndarray:
    """Polynomial hash of every run of ``size`` (a power of two) values, by doubling."""
    out, width = values, 1
    while width < size:
        n = max(len(out) - width, 0)
        out = out[:n] * _power(width) + out[width:width + n]
        width *= 2
    out = (out ^ (out >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    return out ^ (out >> np.uint64(29))


def least_of_windows(keys: np.ndarray, size: int) -> np.ndarray:
    """The least key of every ``size`` consecutive ones."""
    out, width = keys, 1
    while 2 * width <= size:
        out = np.minimum(out[:max(len(out) - width, 0)], out[width:])
        width *= 2
    rest = size - width
    return np.minimum(out[:max(len(out) - rest, 0)], out[rest:]) if rest else out


class Batch:
    """The anchors of a few documents laid end to end."""

    def __init__(self, texts: list[bytes], length: int = LENGTH, hashed: bool = False):
        sizes = np.array([len(t) for t in texts], np.int64)
        self.ends = np.cumsum(sizes)
        self.begins = self.ends - sizes
        self.bytes = np.frombuffer(b"".join(texts), np.uint8)
        n = len(self.bytes)
        count = max(n - length + 1, 0)
        grams, anchors = np.zeros(count, np.uint64), np.zeros(count, np.int64)
        # In parts that stay in the processor's cache; they overlap, so every string is seen whole.
        for at in range(0, count, PART):
            values = _VALUES[self.bytes[at:at + PART + length - 1]]
            hashes = gram_hashes(values, GRAM)
            hashes &= ~_POSITION
            hashes |= np.arange(len(hashes), dtype=np.uint64)
            least = least_of_windows(hashes, length - GRAM + 1)
            grams[at:at + PART] = least >> np.uint64(24)
            least &= _POSITION
            anchors[at:at + PART] = least.astype(np.int64) + at
        whole = np.ones(count, bool)
        tails = (self.ends[:, None] - np.arange(1, length)).reshape(-1)
        whole[tails[(tails >= 0) & (tails < count)]] = False
        start = np.flatnonzero(whole)
        own = anchors[start]
        new = np.flatnonzero(np.append(True, (own[1:] != own[:-1]) | (start[1:] != start[:-1] + 1)))[:len(start)]
        #: Of each anchor: its hash, the first string it governs, how many, and its document.
        self.start = start[new]
        self.gram = grams[self.start]
        self.count = np.diff(np.append(new, len(start)))
        self.doc = np.searchsorted(self.ends, self.start, "right")
        self.first = np.searchsorted(self.doc, np.arange(len(texts)))  # a document's first anchor
        self.ends_at = self.start + self.count - 1 + length
        if hashed:
            powers = _powers(n + 1)
            sums = np.zeros(n + 1, np.uint64)
            np.cumsum(_VALUES[self.bytes] * powers[:n], out=sums[1:])
            self.stretch = (sums[self.ends_at] - sums[self.start]) * powers[n - self.start] + self.count.astype(np.uint64)


_HELD: dict[str, np.ndarray] = {}


def _powers(n: int) -> np.ndarray:
    if len(_HELD.get("powers", ())) < n:
        _HELD["powers"] = np.append(np.uint64(1), np.cumprod(np.full(n + (n >> 2), _BASE, np.uint64)))
    return _HELD["powers"]


def _batches(batches, ids: int, texts: int):
    """Lists of (row key, doc id, text bytes) of about ``BATCH_BYTES``."""
    held, size = [], 0
    for batch in batches:
        for key, doc, text in zip(batch.column(0).to_pylist(), batch.column(ids).to_pylist(), batch.column(texts)):
            raw = bytes(text.as_buffer()) if text.is_valid else b""
            if held and size + len(raw) > BATCH_BYTES:
                yield held
                held, size = [], 0
            held.append((key, doc, raw))
            size += len(raw)
    if held:
        yield held


PARTS = "bucket int, kind int, batch long, a binary, b binary"
ANCHORS, TABLE, ASKED = 0, 1, 2


def _rows(rows) -> pa.RecordBatch:
    columns = list(zip(*rows)) if rows else [()] * 5
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.int32(), pa.int32(), pa.int64(), pa.binary(), pa.binary()))],
                                      ["bucket", "kind", "batch", "a", "b"])


def _split(buckets: np.ndarray):
    """(bucket, indexes) of each bucket that occurs."""
    order = np.argsort(buckets, kind="stable")
    for part in np.split(order, np.flatnonzero(np.diff(buckets[order])) + 1):
        if len(part):
            yield int(buckets[part[0]]), part


def _five(values: np.ndarray) -> bytes:
    return values.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :5].tobytes()


def _from_five(raw) -> np.ndarray:
    five = np.frombuffer(raw, np.uint8).reshape(-1, 5)
    return np.pad(five, ((0, 0), (0, 3))).view("<u8").reshape(-1)


def shared_anchors(texts: DataFrame, buckets: int) -> DataFrame:
    """``key, anchors`` per document: numbers of those of its anchors that occur in another document too."""
    def cut(batches):
        for held in _batches(batches, 1, 2):
            batch = Batch([t for _, _, t in held])
            name = (held[0][0] * 31 + held[-1][0] * 17 + len(held)) & LAST
            order = np.lexsort((batch.doc, batch.gram))
            gram, doc = batch.gram[order], batch.doc[order]
            new = np.flatnonzero(np.append(True, gram[1:] != gram[:-1])) if len(gram) else np.zeros(0, np.int64)
            ends = np.append(new[1:], len(gram))
            several = doc[new] != doc[ends - 1] if len(new) else np.zeros(0, bool)
            rows = []
            for bucket, part in _split((gram[new] % np.uint64(buckets)).astype(np.int64)):
                # The top bit of a number marks an anchor that this batch holds in several documents.
                numbers = order[new[part]].astype(np.uint32) | (several[part].astype(np.uint32) << np.uint32(31))
                rows.append((bucket, ANCHORS, name, _five(gram[new[part]]), numbers.tobytes()))
            known = order[np.repeat(several, ends - new)] if len(new) else order
            at = name % buckets
            rows.append((at, ASKED, name, known.astype(np.uint32).tobytes(), b""))
            rows.append((at, TABLE, name, np.array([k for k, _, _ in held], np.int64).tobytes(), batch.first.astype(np.uint32).tobytes()))
            yield _rows(rows)

    def meet(group: pa.Table) -> pa.Table:
        kind = group.column("kind").to_numpy()
        passed = group.filter(pa.array(kind != ANCHORS))
        own = group.filter(pa.array(kind == ANCHORS)).to_pydict()
        if not own["batch"]:
            return passed
        grams = np.concatenate([_from_five(a) for a in own["a"]])
        numbers = [np.frombuffer(b, np.uint32) for b in own["b"]]
        row = np.repeat(np.arange(len(numbers)), [len(n) for n in numbers])
        numbers = np.concatenate(numbers)
        order = np.argsort(grams, kind="stable")
        same = grams[order][1:] == grams[order][:-1]
        take = np.append(same, False) | np.append(False, same)
        order = order[take]
        order = order[numbers[order] < (1 << 31)]  # the others are known where they come from
        bucket = group.column("bucket")[0].as_py()
        out = [(bucket, ASKED, own["batch"][i], numbers[part].tobytes(), b"")
               for i, part in ((i, order[p]) for i, p in _split(row[order]))]
        return pa.concat_tables([passed, pa.Table.from_batches([_rows(out)])]).cast(passed.schema)

    def back(group: pa.Table) -> pa.Table:
        rows = group.to_pydict()
        keys = np.concatenate([np.frombuffer(a, np.int64) for a, k in zip(rows["a"], rows["kind"]) if k == TABLE])
        first = np.concatenate([np.frombuffer(b, np.uint32) for b, k in zip(rows["b"], rows["kind"]) if k == TABLE]).astype(np.int64)
        asked = np.unique(np.concatenate([np.frombuffer(a, np.uint32) for a, k in zip(rows["a"], rows["kind"]) if k == ASKED])).astype(np.int64)
        doc = np.searchsorted(first, asked, "right") - 1
        parts = [(int(keys[i]), (asked[p] - first[i]).astype(np.uint32).tobytes()) for i, p in _split(doc)]
        k, a = zip(*parts) if parts else ((), ())
        return pa.table([pa.array(k, pa.int64()), pa.array(a, pa.binary())], ["key", "anchors"])

    met = texts.mapInArrow(cut, PARTS).groupBy("bucket").applyInArrow(meet, PARTS)
    found = stored(met, "suffix-shared").groupBy("batch").applyInArrow(back, "key long, anchors binary")
    # A repeated row is in two batches; both ask alike or for more.
    return found.groupBy("key").agg(F.collect_list("anchors").alias("anchors"))


STRETCHES = "bucket int, key long, first int, last int, blob binary"


def suffix_classes(text: np.ndarray, at: np.ndarray, length: int = LENGTH, shallow: int = SHALLOW) -> tuple[np.ndarray, np.ndarray]:
    """The suffixes ``at`` in order, compared over ``length`` bytes, and where each run of equal ones begins.

    ``text`` must go on for ``length`` bytes from every suffix.
    """
    padded = np.append(text, np.zeros(8, np.uint8)).astype(np.uint64)
    wide = np.zeros(len(text) + 1, np.uint64)  # the eight bytes from each position on, as one character
    for i in range(8):
        wide = (wide << np.uint64(8)) | padded[i:i + len(wide)]
    key = wide[at]
    order = np.argsort(key)
    key = key[order]
    new = np.append(True, key[1:] != key[:-1])[:len(at)]
    # Live: places whose suffix equals a neighbour so far. Groups of them stay in place, only their order changes.
    live, group = _still_equal(np.arange(len(at)), np.cumsum(new))
    for depth in range(8, shallow, 4):
        live, group = _part(order, new, live, group, wide[at[order[live]] + depth] >> np.uint64(32), 32)
    while len(live):
        begin = np.flatnonzero(np.append(True, group[1:] != group[:-1]))
        sizes = np.diff(np.append(begin, len(live)))
        own = at[order[live]]
        node = np.full(len(begin), length, np.int64)  # where the suffixes of each node part
        left, where, heads = np.arange(len(begin)), own, begin  # nodes not settled, their suffixes, where each begins
        for depth in (*range(shallow, length - 8, 8), length - 8):
            here = wide[where + depth]
            differ = np.zeros(len(here), np.uint64)
            differ[1:] = here[1:] ^ here[:-1]
            differ[heads] = 0
            found = np.bitwise_or.reduceat(differ, heads)
            parted = found != 0
            top = found[parted]
            skip = np.zeros(len(top), np.int64)
            for i in range(1, 8):
                skip += top < (np.uint64(1) << np.uint64(64 - 8 * i))
            node[left[parted]] = depth + skip
            if not len(rest := left[~parted]):
                break
            if len(top):
                where = where[np.repeat(~parted, sizes[left])]
                left = rest
                heads = np.cumsum(sizes[left]) - sizes[left]
        inner = np.repeat(node < length, sizes)  # leaves are done
        live, group, own = live[inner], group[inner], own[inner]
        if len(live):
            live, group = _part(order, new, live, group, text[own + np.repeat(node, sizes)[inner]].astype(np.uint64), 8)
    return order, np.flatnonzero(new)


def _part(order, new, live, group, key, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Sort each group by ``key`` of ``bits`` bits and cut it where keys differ; what is still equal."""
    # Groups are renumbered from 0, so that a group and its key fit in one number.
    number = np.cumsum(np.append(False, group[1:] != group[:-1]))[:len(group)].astype(np.uint64)
    both = (number << np.uint64(bits)) | key
    inner = np.argsort(both)
    order[live] = order[live][inner]
    both = both[inner]
    cut = np.append(True, both[1:] != both[:-1])[:len(both)]
    new[live] |= cut
    return _still_equal(live, np.cumsum(cut))


def _still_equal(live: np.ndarray, group: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    same = group[1:] == group[:-1]
    take = np.append(same, False)[:len(group)] | np.append(False, same)[:len(group)]
    return live[take], group[take]


def covered_spans(texts: DataFrame, shared: DataFrame, buckets: int, length: int = LENGTH) -> DataFrame:
    """``key, first, last`` of byte runs covered by strings of smaller documents."""
    import zstandard

    def cut(batches):
        packer = zstandard.ZstdCompressor(level=1)

        def held_batches():
            # The anchors asked for ride along with the row key.
            for batch in batches:
                yield pa.RecordBatch.from_arrays(
                    [pa.StructArray.from_arrays([batch.column(0), batch.column(3)], ["key", "anchors"]), batch.column(1), batch.column(2)],
                    ["key", "id", "text"])

        for held in _batches(held_batches(), 1, 2):
            batch = Batch([t for _, _, t in held], length, hashed=True)
            keys = np.array([k["key"] for k, _, _ in held], np.int64)
            ids = np.array([d for _, d, _ in held], np.int64)
            asked = [np.unique(np.concatenate([np.frombuffer(a, np.uint32) for a in k["anchors"]])).astype(np.int64) + f
                     for (k, _, _), f in zip(held, batch.first)]
            wanted = np.zeros(len(batch.gram), bool)
            wanted[np.concatenate(asked)] = True
            # An anchor that repeats within its document was named once: take its others too.
            mark = (batch.gram << np.uint64(24)) ^ batch.doc.astype(np.uint64)
            at = np.flatnonzero(wanted | np.isin(mark, mark[wanted]))
            # Of equal stretches, those of the least document stay; all of the others are covered.
            order = at[np.lexsort((ids[batch.doc[at]], batch.stretch[at], batch.gram[at]))]
            new = np.append(True, (batch.stretch[order][1:] != batch.stretch[order][:-1]) | (batch.gram[order][1:] != batch.gram[order][:-1]))[:len(order)]
            least = ids[batch.doc[order]][np.flatnonzero(new)][np.cumsum(new) - 1] if len(order) else np.zeros(0, np.int64)
            larger = ids[batch.doc[order]] > least
            whole, order = order[larger], order[~larger]
            begin = batch.begins[batch.doc]
            yield _stretch_rows(np.full(len(whole), -1), keys[batch.doc[whole]], (batch.start - begin)[whole], (batch.ends_at - begin)[whole],
                                [None] * len(whole))
            rows = []
            for bucket, part in _split((batch.gram[order] % np.uint64(buckets)).astype(np.int64)):
                some = order[part]
                sizes = batch.ends_at[some] - batch.start[some]
                ends = np.cumsum(sizes)
                text = batch.bytes[np.arange(ends[-1]) + np.repeat(batch.start[some] - (ends - sizes), sizes)]
                head = [np.array([len(some)], np.int64), keys[batch.doc[some]], ids[batch.doc[some]],
                        (batch.start - begin)[some].astype(np.int64), sizes.astype(np.int64)]
                rows.append((bucket, packer.compress(b"".join([*(h.tobytes() for h in head), text.tobytes()]))))
            b, blobs = zip(*rows) if rows else ((), ())
            yield _stretch_rows(np.array(b, np.int64), np.zeros(len(b), np.int64), np.zeros(len(b), np.int64), np.zeros(len(b), np.int64), blobs)

    def sort(group: pa.Table) -> pa.Table:
        unpack = zstandard.ZstdDecompressor().decompress
        heads, texts_ = [], []
        for raw in map(unpack, group.column("blob").to_pylist()):
            n = int(np.frombuffer(raw, np.int64, 1)[0])
            heads.append(np.frombuffer(raw, np.int64, 4 * n, 8).reshape(4, n))
            texts_.append(np.frombuffer(raw, np.uint8, offset=8 + 32 * n))
        keys, ids, starts, sizes = np.concatenate(heads, axis=1)
        text = np.concatenate(texts_)
        ends = np.cumsum(sizes)
        counts = sizes - length + 1
        owner = np.repeat(np.arange(len(sizes)), counts)
        within = np.arange(len(owner)) - np.repeat(np.cumsum(counts) - counts, counts)
        at = (ends - sizes)[owner] + within
        order, begin = suffix_classes(text, at, length)
        own = ids[owner[order]]
        least = np.repeat(np.minimum.reduceat(own, begin), np.diff(np.append(begin, len(order))))
        covered = np.zeros(len(at), bool)
        covered[order] = least < own
        hit = np.flatnonzero(covered)
        first = hit[(np.diff(hit, prepend=-2) != 1) | (np.diff(owner[hit], prepend=-1) != 0)]
        last = hit[np.append((np.diff(hit) != 1) | (np.diff(owner[hit]) != 0), True)[:len(hit)]]
        return pa.table([pa.array(x, t) for x, t in ((keys[owner[first]], pa.int64()), (starts[owner[first]] + within[first], pa.int32()),
                                                     (starts[owner[last]] + within[last] + length, pa.int32()))], ["key", "first", "last"])

    rows = stored(texts.join(shared, "key").select("key", "id", "text", "anchors").mapInArrow(cut, STRETCHES), "suffix-stretches")
    sorted_ = rows.filter("bucket >= 0").groupBy("bucket").applyInArrow(sort, "key long, first int, last int")
    return rows.filter("bucket < 0").select("key", "first", "last").unionByName(sorted_)


def _stretch_rows(bucket, key, first, last, blob) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(bucket, pa.int32()), pa.array(key, pa.int64()), pa.array(first, pa.int32()), pa.array(last, pa.int32()), pa.array(blob, pa.binary())],
        ["bucket", "key", "first", "last", "blob"])


def keyed(docs: DataFrame) -> DataFrame:
    """``key, id, text`` of each row; rows with one key are the same document and text."""
    text = F.coalesce("text", F.lit(""))
    return docs.select(F.xxhash64("doc_id", text).alias("key"), F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST)).alias("id"),
                       text.cast("binary").alias("text"))


def runs(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """``key, spans`` of each document that loses bytes; spans are byte runs, perhaps overlapping."""
    texts = keyed(docs)
    total = texts.agg(F.sum(F.length("text"))).first()[0] or 0
    buckets = max(8, -(-total // BUCKET_BYTES))
    shared = shared_anchors(texts, buckets)
    covered = stored(covered_spans(texts, shared, buckets, length), "suffix-covered")
    return covered.groupBy("key").agg(F.collect_list(F.struct("first", "last")).alias("spans"))  # of one document


def merged(spans) -> list[tuple[int, int]]:
    out: list[list[int]] = []
    for first, last in sorted(spans):
        if out and first <= out[-1][1]:
            out[-1][1] = max(out[-1][1], last)
        else:
            out.append([first, last])
    return [tuple(x) for x in out]


def deduplicated(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """``doc_id, n_bytes, spans, kept`` per row: the merged byte runs removed and the bytes that stay."""
    def run(batches):
        for batch in batches:
            sizes, spans, kept = [], [], []
            for text, found in zip(batch.column(1), batch.column(2).to_pylist()):
                raw = text.as_py()
                own = merged((s["first"], s["last"]) for s in found or ())
                at, parts = 0, []
                for first, last in own:
                    parts.append(raw[at:first])
                    at = last
                parts.append(raw[at:])
                sizes.append(len(raw))
                spans.append([{"first": a, "last": b} for a, b in own])
                kept.append(b"".join(parts))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(sizes, pa.int64()), pa.array(spans, batch.schema.field(2).type), pa.array(kept, pa.binary())],
                ["doc_id", "n_bytes", "spans", "kept"])

    rows = keyed(docs).join(runs(docs, length), "key", "left").select(
        F.when(F.col("id") != LAST, F.col("id")).alias("doc_id"), "text", "spans")
    return rows.mapInArrow(run, "doc_id long, n_bytes long, spans array<struct<first:int,last:int>>, kept binary")


def query(spark, sf_dir: str) -> DataFrame:
    return deduplicated(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_bytes", (F.col("n_bytes") - F.length("kept")).cast("long").alias("n_removed"),
        F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))
