"""Token ids in binary files, coded with a canonical length-limited Huffman code.

Layout of a file set, written by Spark under one folder:

* ``code``: a row ``(token, length)`` per id that occurs. The code is canonical:
  words are dealt in order of (length, token), so lengths are all a reader needs.
* ``blocks``: rows ``(file, block, docs, doc_ids, sizes, payload, checkpoints)``.
  A file is one range of doc_id, its blocks are independent, and files, blocks
  and documents ascend by doc_id. ``payload`` is the bit string, padded to a
  byte. ``checkpoints`` holds the bit offset of every ``STRIDE``-th token, so
  a reader can start there, and decodes all stretches of a block side by side.

Code lengths are at most ``LONGEST`` bits, or what the ids need (package-merge), which bounds the
decoding table. The counts come from all documents; only a count per id of the
vocabulary reaches the driver.

Nulls and ties: a null or empty text holds the end id alone; null doc_ids come
first; rows that repeat a doc_id are ordered by a digest of their ids. An empty table
gives an empty file set.
"""

from __future__ import annotations

import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyline.llm.common import stored, table
from tallyline.llm.vocabulary import encoder
from tallyline.session import scratch

LONGEST = 16
STRIDE = 128
BLOCK_TOKENS = 1 << 18
END_ID = 1
TEXTS = 256


def token_rows(docs: DataFrame, path: str, end_id: int = END_ID) -> DataFrame:
    """``doc_id, n, width, ids``: the ids of each text with the end id, as little-endian integers of ``width`` bytes."""
    def run(batches):
        coder = encoder(path)
        width = 2 if max(coder.tokenizer.get_vocab_size(), end_id + 1) <= 1 << 16 else 4
        for batch in batches:
            for at in range(0, batch.num_rows, TEXTS):
                part = batch.slice(at, TEXTS)
                ids, sizes = coder.encode([t or "" for t in part.column(1).to_pylist()])
                ends = np.cumsum(sizes)
                ids = np.insert(ids, ends, end_id).astype(f"<u{width}")
                sizes = sizes + 1
                offsets = np.append(0, np.cumsum(sizes)) * width
                blobs = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(sizes),
                                                         [None, pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(ids)])
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(sizes, pa.int64()), pa.array(np.full(len(sizes), width), pa.int32()),
                                                  blobs.cast(pa.binary())], ["doc_id", "n", "width", "ids"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id long, n long, width int, ids binary")


def counts(rows: DataFrame) -> DataFrame:
    """``token, count`` over all rows, summed in each task first."""
    def run(batches):
        seen = np.zeros(0, np.int64)
        for batch in batches:
            for width in set(batch.column(0).to_pylist()):
                blobs = batch.filter(pc.equal(batch.column(0), width)).column(1)
                own = np.bincount(np.frombuffer(b"".join(blobs.to_pylist()), f"<u{width}"))
                if len(own) > len(seen):
                    seen, own = own, seen
                seen[:len(own)] += own
        tokens = np.flatnonzero(seen)
        yield pa.RecordBatch.from_arrays([pa.array(tokens, pa.int64()), pa.array(seen[tokens], pa.int64())], ["token", "count"])

    parts = rows.select("width", "ids").mapInArrow(run, "token long, count long")
    return parts.groupBy("token").agg(F.sum("count").alias("count"))


def code_lengths(weights: np.ndarray, longest: int = LONGEST) -> np.ndarray:
    """Best code lengths of at most ``longest`` bits for the weights, by package-merge."""
    n = len(weights)
    if n <= 1:
        return np.ones(n, np.int64)
    if n > 1 << longest:
        raise ValueError(f"{n} ids do not fit into {longest} bits")
    order = np.argsort(weights, kind="stable")
    leaves = weights[order].astype(np.float64)
    # Per level, which of its items in order of weight are leaves; the rest are packages of the level below.
    levels, packages = [], np.zeros(0)
    for _ in range(longest):
        items = np.concatenate([leaves, packages])
        rank = np.argsort(items, kind="stable")
        levels.append(rank < n)
        items = items[rank]
        packages = items[:len(items) // 2 * 2].reshape(-1, 2).sum(1)
    lengths = np.zeros(n, np.int64)
    take = 2 * n - 2
    for is_leaf in reversed(levels):
        taken = int(is_leaf[:take].sum())
        lengths[:taken] += 1
        take = 2 * (min(take, len(is_leaf)) - taken)
    out = np.empty(n, np.int64)
    out[order] = lengths
    return out


class Code:
    """A canonical code from the lengths of its tokens."""

    def __init__(self, tokens: np.ndarray, lengths: np.ndarray):
        order = np.lexsort((tokens, lengths))
        tokens, lengths = tokens[order].astype(np.int64), lengths[order].astype(np.int64)
        self.width = int(lengths.max(initial=1))
        # Left-aligned words: each starts where the one before ends.
        spans = 1 << (self.width - lengths)
        starts = np.cumsum(spans) - spans
        size = int(tokens.max(initial=0)) + 1
        self.word, self.length = np.zeros(size, np.uint64), np.zeros(size, np.int64)
        self.word[tokens], self.length[tokens] = (starts >> (self.width - lengths)).astype(np.uint64), lengths
        self.token_at = np.zeros(1 << self.width, np.uint32)
        self.length_at = np.ones(1 << self.width, np.int64)
        used = int(spans.sum())
        self.token_at[:used] = np.repeat(tokens, spans)
        self.length_at[:used] = np.repeat(lengths, spans)

    def encode(self, ids: np.ndarray, stride: int = STRIDE) -> tuple[bytes, np.ndarray]:
        """The bit string of ids, and the bit offset of every ``stride``-th id."""
        lengths = self.length[ids]
        ends = np.cumsum(lengths)
        starts = ends - lengths
        slot = starts >> 5
        # Each word within the 64 bits from its 32-bit slot on: a high part for the slot, a low part for the next.
        placed = self.word[ids] << (64 - (starts & 31) - lengths).astype(np.uint64)
        total = int(ends[-1]) if len(ends) else 0
        words = np.zeros((total >> 5) + 2, np.uint64)
        if total:
            first = np.flatnonzero(np.append(True, slot[1:] != slot[:-1]))
            at = slot[first]
            words[at] += np.add.reduceat(placed >> np.uint64(32), first)
            words[at + 1] += np.add.reduceat(placed & np.uint64(0xFFFFFFFF), first)
        return words.astype(">u4").tobytes()[:(total + 7) // 8], starts[::stride].copy()

    def decode(self, payload: bytes, checkpoints: np.ndarray, count: int, stride: int = STRIDE) -> np.ndarray:
        """The ``count`` ids of a bit string; all stretches between checkpoints advance together."""
        bits = np.frombuffer(payload + bytes(8), np.uint8).astype(np.uint64)
        # The 40 bits from every byte on cover a word at any of the 8 bit offsets in it.
        seen = np.zeros(len(bits) - 4, np.uint64)
        for i in range(5):
            seen = (seen << np.uint64(8)) | bits[i:len(bits) - 4 + i]
        out = np.zeros((len(checkpoints), stride), np.uint32)
        at, mask = checkpoints.astype(np.int64), np.uint64((1 << self.width) - 1)
        last = len(seen) - 1
        for step in range(stride):
            window = (seen[np.minimum(at >> 3, last)] >> (40 - (at & 7) - self.width).astype(np.uint64)) & mask
            out[:, step] = self.token_at[window]
            at = at + self.length_at[window]
        return out.reshape(-1)[:count]


BLOCKS = ("file int, block int, docs int, n_tokens long, doc_ids array<long>, sizes array<long>, "
          "payload binary, checkpoints array<long>")


def write(docs: DataFrame, folder: str, path: str, end_id: int = END_ID, longest: int = LONGEST) -> None:
    """Encode ``docs(doc_id, text)`` and write the file set."""
    spark = docs.sparkSession
    rows = stored(token_rows(docs, path, end_id), "token-ids", compression="zstd")
    found = counts(rows).toPandas().sort_values("token")  # an entry per id of the vocabulary at most
    tokens, weights = found["token"].to_numpy(np.int64), found["count"].to_numpy(np.int64)
    lengths = code_lengths(weights, max(longest, len(tokens).bit_length()))
    spark.createDataFrame([(int(t), int(n)) for t, n in zip(tokens, lengths)], "token long, length int").coalesce(1).write.parquet(f"{folder}/code")
    shared = spark.sparkContext.broadcast((tokens, lengths))  # bounded by the vocabulary

    def run(batches):
        code, block, number = Code(*shared.value), [], 0

        def packed():
            ids = np.concatenate([b for _, _, b in block])
            payload, checkpoints = code.encode(ids)
            return pa.RecordBatch.from_arrays(
                [pa.array([block[0][0]], pa.int32()), pa.array([number], pa.int32()), pa.array([len(block)], pa.int32()),
                 pa.array([len(ids)], pa.int64()), pa.array([[d for _, d, _ in block]], pa.list_(pa.int64())),
                 pa.array([[len(b) for _, _, b in block]], pa.list_(pa.int64())), pa.array([payload], pa.binary()),
                 pa.array([checkpoints.tolist()], pa.list_(pa.int64()))],
                ["file", "block", "docs", "n_tokens", "doc_ids", "sizes", "payload", "checkpoints"])

        held = 0
        for batch in batches:
            for file, doc, width, blob in zip(*(batch.column(i).to_pylist() for i in range(3)), batch.column(3)):
                ids = np.frombuffer(blob.as_buffer(), f"<u{width}").astype(np.int64)
                block.append((file, doc, ids))
                held += len(ids)
                if held >= BLOCK_TOKENS:
                    yield packed()
                    block, held, number = [], 0, number + 1
        if block:
            yield packed()

    ranged = (rows.withColumn("digest", F.xxhash64("ids")).repartitionByRange("doc_id", "digest")
              .sortWithinPartitions(F.col("doc_id").asc_nulls_first(), "digest")
              .select(F.spark_partition_id().alias("file"), "doc_id", "width", "ids"))
    ranged.mapInArrow(run, BLOCKS).write.parquet(f"{folder}/blocks")


def read(spark: SparkSession, folder: str) -> DataFrame:
    """``doc_id, start, n_tokens, ids`` of a file set; ids as little-endian 32-bit integers."""
    code = spark.read.schema("token long, length int").parquet(f"{folder}/code").toPandas()
    shared = spark.sparkContext.broadcast((code["token"].to_numpy(np.int64), code["length"].to_numpy(np.int64)))
    blocks = spark.read.schema(BLOCKS).parquet(f"{folder}/blocks")
    before, starts = 0, []
    for file, n in sorted(blocks.groupBy("file").agg(F.sum("n_tokens")).collect()):  # a row per file
        starts.append((file, before))
        before += n
    offsets = spark.createDataFrame(starts, "file int, before long")
    from pyspark.sql import Window

    order = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    within = blocks.select("file", "block", "n_tokens").withColumn("within", F.coalesce(F.sum("n_tokens").over(order), F.lit(0)))
    placed = within.join(offsets, "file").select(F.col("file").alias("f"), F.col("block").alias("b"),
                                                 (F.col("within") + F.col("before")).alias("before"))
    joined = blocks.join(placed, (F.col("file") == F.col("f")) & (F.col("block") == F.col("b")))

    def run(batches):
        reader = Code(*shared.value)
        for batch in batches:
            for doc_ids, sizes, payload, checkpoints, begin in zip(*(batch.column(i) for i in range(5))):
                sizes = np.array(sizes.as_py(), np.int64)
                ids = reader.decode(payload.as_py(), np.array(checkpoints.as_py(), np.int64), int(sizes.sum()))
                ends = np.cumsum(sizes)
                raw = ids.astype("<u4").tobytes()
                yield pa.RecordBatch.from_arrays(
                    [doc_ids.values, pa.array(begin.as_py() + ends - sizes, pa.int64()), pa.array(sizes, pa.int64()),
                     pa.array([raw[4 * (e - s):4 * e] for s, e in zip(sizes, ends)], pa.binary())],
                    ["doc_id", "start", "n_tokens", "ids"])

    return joined.select("doc_ids", "sizes", "payload", "checkpoints", "before").mapInArrow(
        run, "doc_id long, start long, n_tokens long, ids binary")


def digests(rows: DataFrame) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32`` of what ``read`` gives."""
    return rows.select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def encoded(docs: DataFrame, path: str | None = None) -> DataFrame:
    """Write ``docs`` as a new file set in the shared folder and give the digests read back from it."""
    folder = scratch(docs.sparkSession, "token-files")
    write(docs, folder, path or public_tokenizers.path("word_bpe_49k.json"))
    return digests(read(docs.sparkSession, folder))


def query(spark, sf_dir: str) -> DataFrame:
    return encoded(table(spark, sf_dir, "documents"))
