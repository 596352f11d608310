"""Near-duplicate documents by SimHash, found with pivot distance tables.

A fingerprint's row of the pivot table holds its Hamming distances to
reference fingerprints. By the triangle inequality the distances of two
fingerprints to any reference differ by no more than the two do from each
other, so a pair whose largest coordinate difference exceeds the radius is
discarded without being compared, and the survivors are verified.

Which pairs are looked at comes from references too. Take the staircase of
references 0, 1, 11, 111, ... in binary: from one to the next, the distance
goes up or down by one, as that bit of the fingerprint says. Two fingerprints
within the radius have profiles over the staircase that move in step but for
``radius`` steps. Cut the staircase into ``PARTS`` runs: in at least
``PARTS - radius`` runs the moves are the same. The moves over a set of runs are
the fingerprint's bits there, which is how the join key is computed. (A
window on the distance to a reference far from the data cannot be a key: half
of all unrelated pairs fall into it, and each such key doubles the rows.)

Nulls and ties: a null or blank text has fingerprint zero and links like any
other; rows that repeat a text share a fingerprint and so a component. A null
doc_id takes part but names no component unless nothing else is reachable
(then component_id is null). Columns besides the id and text are ignored.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyline.llm.common import components, stored, table

SHINGLE = 3
SEED = 42
RADIUS = 3
PARTS = 6
PIVOTS = 16
CHUNK = 1 << 18


def _signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


def fingerprint(text: str | None) -> int:
    """The 64-bit SimHash of a text's word shingles, as a signed integer."""
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    if len(words) < SHINGLE:
        words = [b" ".join(words)]
        shingles = zip(words)
        count = 1
    else:
        shingles = zip(*(words[i:] for i in range(SHINGLE)))
        count = len(words) - SHINGLE + 1
    ones = np.zeros(64, np.int64)
    digest, left = xxhash.xxh64_intdigest, count
    while left > 0:
        take = min(left, CHUNK)
        part = np.fromiter((digest(b" ".join(s), SEED) for s, _ in zip(shingles, range(take))), np.uint64, take)
        ones += np.unpackbits(part.astype(">u8").view(np.uint8).reshape(-1, 8), axis=1).sum(0, dtype=np.int64)
        left -= take
    return int(np.packbits(2 * ones > count).view(">i8")[0])


def _printed(rows: DataFrame) -> DataFrame:
    """The columns of ``rows`` but the last, which is the text, and ``fp``."""
    names = rows.columns[:-1]

    def run(batches):
        for batch in batches:
            prints = [fingerprint(t.as_py()) for t in batch.column(len(names))]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(prints, pa.int64())], [*names, "fp"])

    return rows.mapInArrow(run, ", ".join(f"{n} long" for n in [*names, "fp"]))


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, fp``: one row per row of ``docs``."""
    return _printed(docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")))


def references(count: int = PIVOTS) -> list[int]:
    """Reference fingerprints: a fixed sequence of well mixed integers."""
    return [_signed(xxhash.xxh64_intdigest(i.to_bytes(8, "little"), SEED)) for i in range(count)]


def pivot_table(prints: DataFrame, pivots: list[int]) -> DataFrame:
    """``prints`` with the distances to all pivots, a byte each, eight to a ``p<i>`` column."""
    def packed(eight: list[int]) -> Column:
        parts = [F.shiftleft(F.bit_count(F.col("fp").bitwiseXOR(F.lit(p))).cast("long"), 8 * i)
                 for i, p in enumerate(eight)]
        out = parts[0]
        for part in parts[1:]:
            out = out.bitwiseOR(part)
        return out

    return prints.withColumns({f"p{i // 8}": packed(pivots[i:i + 8]) for i in range(0, len(pivots), 8)})


def _far(pivots: int, radius: int) -> Column:
    """Whether some coordinate of rows x and y differs by more than the radius."""
    def coordinate(side: str, i: int) -> Column:
        return F.shiftright(F.col(f"{side}.p{i // 8}"), 8 * (i % 8)).bitwiseAND(F.lit(255))

    return F.greatest(*[F.abs(coordinate("x", i) - coordinate("y", i)) for i in range(pivots)]) > radius


def run_masks(parts: int = PARTS, radius: int = RADIUS) -> list[int]:
    """Bit masks of every choice of ``parts - radius`` runs of the staircase."""
    ends = [64 * i // parts for i in range(parts + 1)]
    runs = [(1 << ends[i + 1]) - (1 << ends[i]) for i in range(parts)]
    return [_signed(sum(chosen)) for chosen in combinations(runs, parts - radius)]


def link_pairs(prints: DataFrame, radius: int = RADIUS, parts: int = PARTS, pivots: int = PIVOTS) -> DataFrame:
    """``a, b`` with a < b: every pair of different fingerprints of ``prints(fp)`` within ``radius`` bits, once.

    ``prints`` must hold each fingerprint once; equal ones need no link.
    """
    masks = run_masks(parts, radius)
    rows = pivot_table(prints.select("fp"), references(pivots))
    keyed = rows.select("*", F.posexplode(F.array(*[F.col("fp").bitwiseAND(F.lit(m)) for m in masks]))
                        .alias("run", "key"))
    differ = F.col("x.fp").bitwiseXOR(F.col("y.fp"))
    # A pair that agrees on several choices of runs is taken from the first.
    first = F.coalesce(*[F.when(differ.bitwiseAND(F.lit(m)) == 0, F.lit(i)) for i, m in enumerate(masks)])
    return (keyed.alias("x").join(keyed.alias("y"), (F.col("x.run") == F.col("y.run")) & (F.col("x.key") == F.col("y.key"))
                                  & (F.col("x.fp") < F.col("y.fp")))
            .filter(~_far(pivots, radius))
            .filter((F.bit_count(differ) <= radius) & (first == F.col("x.run")))
            .select(F.col("x.fp").alias("a"), F.col("y.fp").alias("b")))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", radius: int = RADIUS) -> DataFrame:
    """``doc_id, fp, component_id`` for each row of ``docs``; copies are never expanded into pairs."""
    prints = stored(fingerprints(docs, id_col, text_col), "simhash-prints")
    classes = stored(prints.groupBy("fp").agg(F.min("doc_id").alias("least")), "simhash-classes")
    joined = components(link_pairs(classes, radius), "simhash-components")
    rooted = classes.join(joined, classes["fp"] == joined["node"], "left").select(
        classes["fp"], "least", F.coalesce("root", classes["fp"]).alias("root"))
    named = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    by_print = rooted.join(named, "root").select("fp", "component_id")
    # A left join, so that adaptive execution may split the rows of one hot fingerprint.
    return prints.join(by_print, "fp", "left").select("doc_id", "fp", "component_id")


def row_hash(docs: DataFrame) -> Column:
    """A hash of all columns. Hashes leave nulls out, so where they are is hashed too; maps have none and go as JSON."""
    values = [F.to_json(F.struct(c)) if "map<" in t else F.col(f"`{c}`") for c, t in docs.dtypes]
    return F.xxhash64(*values, *[F.col(f"`{c}`").isNull() for c in docs.columns])


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", radius: int = RADIUS) -> DataFrame:
    """The rows of ``docs`` with one of each component of near duplicates.

    A component keeps its row of least id, null last, then of least row hash,
    whichever texts share an id; identical rows are one.
    """
    found = stored(_printed(docs.select(F.col(id_col).cast("long").alias("doc_id"), row_hash(docs).alias("h"), F.col(text_col).alias("text"))),
                   "simhash-prints")
    row = F.struct(F.col("doc_id").isNull().alias("missing"), "doc_id", "h")
    classes = stored(found.groupBy("fp").agg(F.min(row).alias("least")), "simhash-classes")
    joined = components(link_pairs(classes, radius), "simhash-components")
    keep = stored(classes.join(joined, classes["fp"] == joined["node"], "left").groupBy(F.coalesce("root", "fp").alias("root"))
                  .agg(F.min("least").alias("least")).select(F.col("least.h").alias("h")), "simhash-kept")
    rows = docs.select(row_hash(docs).alias("h"), F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")).join(keep, "h", "left_semi")
    # Dealt by the hash for the join already; all rows of one hash are the same row.
    return rows.groupBy("h").agg(F.first("row").alias("row")).select("row.*")


def query(spark, sf_dir: str) -> DataFrame:
    found = near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
