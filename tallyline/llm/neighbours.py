"""Nearest neighbours by cosine, exact, by a block matrix join of int8 tiles.

Queries and candidates are cut into blocks, and each pair of blocks is a tile:
queries are repeated once per candidate block, candidates once per query
block, and the two meet by tile. A tile multiplies the vectors rounded to int8
and bounds the rounding error of each product, so all candidates that cannot
be among the query's best are left; the rest are computed again in double
precision from the vectors as given, and the tile keeps the best of each query.
What the tiles keep is merged by rank.

Blocks are of bounded size, so a tile fits in memory whatever the tables hold.

Nulls and ties: vectors that are null, empty, zero, or hold null or non-finite
components take no part, as queries or candidates, nor do rows without an id;
so do vectors of another length than the query's. Equal scores go to the
smaller id. A vec_id names one vector: where it repeats, as query or candidate,
its rows are taken together and a pair of ids has its best score, once; rows
that repeat a query's id are the query's own. An empty table gives an empty table.
"""

from __future__ import annotations

import heapq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyline.llm.common import stored, table

NEAREST = 5
EVERY = 50
QUERY_BLOCK = 1024
CANDIDATE_BLOCK = 8192
PAIRS = 1 << 18


def usable(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """``id, v, dim`` of the rows that take part."""
    v = F.col("v")
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).cast("array<double>").alias("v"))
    bad = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return rows.filter(F.col("id").isNotNull() & v.isNotNull() & ~bad & F.exists(v, lambda x: x != 0)).withColumn("dim", F.size(v))


def quantised(matrix: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """int8 rows (as float32, in which their products are exact), their scales, and the norms of what rounding left."""
    unit = matrix / np.abs(matrix).max(1, keepdims=True)
    unit /= np.sqrt((unit * unit).sum(1, keepdims=True))
    scale = 127 / np.abs(unit).max(1)
    whole = np.rint(unit * scale[:, None])
    left = unit - whole / scale[:, None]
    # Double rounding is far below 1e-12 for a unit vector.
    return whole.astype(np.float32), scale, np.sqrt((left * left).sum(1)) + 1e-12


def cosines(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Of rows in pairs; each row is summed the same way wherever it stands, so equal vectors score alike."""
    def norm(m):
        top = np.abs(m).max(1, keepdims=True)  # so that squares neither overflow nor vanish
        m = m / top
        return m / np.sqrt((m * m).sum(1, keepdims=True))

    plain = (a * b).sum(1) / (np.sqrt((a * a).sum(1)) * np.sqrt((b * b).sum(1)))
    odd = ~np.isfinite(plain) | (np.abs(plain) > 1.5)
    if odd.any():
        plain[odd] = (norm(a[odd]) * norm(b[odd])).sum(1)
    return plain


def tile(query_ids, queries, ids, vectors, k: int):
    """The best ``k`` candidates of each query of a tile, as (query, candidate, score) arrays."""
    qa, qs, qe = quantised(queries)
    ca, cs, ce = quantised(vectors)
    if qa.shape[1] > 1000:  # beyond it, sums of products of int8 outgrow float32
        qa, ca = qa.astype(np.float64), ca.astype(np.float64)
    out = []
    different, begins = np.unique(ids, return_index=True)
    if repeated := len(different) < len(ids):
        by_id = np.argsort(ids, kind="stable")
        begins = np.searchsorted(ids[by_id], different)
    step = max(1, PAIRS // len(ids))
    for at in range(0, len(query_ids), step):
        rows = slice(at, at + step)
        near = (qa[rows] @ ca.T) / (qs[rows, None] * cs[None, :])
        # |q.c - q'.c'| <= |dq||c| + |q||dc| + |dq||dc| for unit vectors q and c.
        slack = qe[rows, None] + ce[None, :] + qe[rows, None] * ce[None, :] + 1e-6
        own = query_ids[rows, None] == ids[None, :]
        low, high = np.where(own, -np.inf, near - slack), np.where(own, -np.inf, near + slack)
        # The k-th best of different ids.
        each = np.maximum.reduceat(low[:, by_id], begins, axis=1) if repeated else low
        cut = np.partition(each, -k, axis=1)[:, -k] if len(different) > k else np.full(len(low), -np.inf)
        i, j = np.nonzero((high >= cut[:, None]) & ~own)
        score = np.concatenate([cosines(queries[rows][i[p:p + PAIRS // 8]], vectors[j[p:p + PAIRS // 8]])
                                for p in range(0, max(len(i), 1), PAIRS // 8)])
        for r, begin, end in zip(range(len(low)), np.searchsorted(i, np.arange(len(low))),
                                 np.searchsorted(i, np.arange(len(low)), "right")):
            own_ids, own_scores = ids[j[begin:end]].tolist(), score[begin:end].tolist()
            highest = {}
            for c, s in zip(own_ids, own_scores):
                highest[c] = max(s, highest.get(c, s))
            found = heapq.nsmallest(k, ((-s, c) for c, s in highest.items()))
            out.extend((int(query_ids[at + r]), c, -s) for s, c in found)
    return out


def nearest(queries: DataFrame, candidates: DataFrame, k: int = NEAREST, id_col: str = "vec_id",
            vector_col: str = "embedding") -> DataFrame:
    """``query_id, rank, vec_id, score`` of each query's ``k`` nearest candidates other than itself."""
    def blocks(rows, label, size):
        rows = stored(usable(rows, id_col, vector_col), label)
        count = max(1, -(-rows.count() // size))
        # Dealt by a hash of the whole row and its task: copies spread too, and a retried task deals alike.
        block = F.pmod(F.xxhash64("id", "v", F.spark_partition_id()), F.lit(count)).cast("int")
        return rows.withColumn("block", block), count

    q, nq = blocks(queries, "ann-queries", QUERY_BLOCK)
    c, nc = blocks(candidates, "ann-candidates", CANDIDATE_BLOCK)
    q = q.select("*", F.explode(F.sequence(F.lit(0), F.lit(nc - 1))).alias("other")).select(
        (F.col("block").cast("long") * nc + F.col("other")).alias("tile"), "dim", "id", "v")
    c = c.select("*", F.explode(F.sequence(F.lit(0), F.lit(nq - 1))).alias("other")).select(
        (F.col("other").cast("long") * nc + F.col("block")).alias("tile"), "dim", "id", "v")

    def matrix(part: pa.Table):
        v = part.column("v").combine_chunks()
        return part.column("id").to_numpy(), v.flatten().to_numpy().reshape(len(v), -1)

    def run(left: pa.Table, right: pa.Table):
        found = tile(*matrix(left), *matrix(right), k) if left.num_rows and right.num_rows else []
        q_ids, ids, score = zip(*found) if found else ((), (), ())
        return pa.table([pa.array(q_ids, pa.int64()), pa.array(ids, pa.int64()), pa.array(score, pa.float64())],
                        ["query_id", "vec_id", "score"])

    kept = (q.groupBy("tile", "dim").cogroup(c.groupBy("tile", "dim"))
            .applyInArrow(run, "query_id long, vec_id long, score double"))
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    # Ids that repeat meet in several pairs; each tile keeps different ids, so none of the best is crowded out.
    kept = kept.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    return kept.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select(
        "query_id", "rank", "vec_id", "score")


def query(spark, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings")
    return nearest(rows.filter(F.col("vec_id") % EVERY == 0), rows)


SQL = """
WITH vectors AS (
  SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
scored AS (
  SELECT q.vec_id AS query_id, c.vec_id, max(list_cosine_similarity(q.v, c.v)) AS score
  FROM vectors q JOIN vectors c ON q.vec_id % 50 = 0 AND q.vec_id <> c.vec_id AND len(q.v) = len(c.v) GROUP BY ALL),
ranked AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM scored)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 5
"""
