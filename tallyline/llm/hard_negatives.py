"""Hard negatives for anchor rows: slot-decomposed selection over a block matrix join.

Every positive of an anchor asks for the best rows of other labels whose score
lies in a window below the positive's own score. The windows of one anchor
overlap, so they are not searched one by one. The upper limits of its positives
cut the scores into disjoint slots; one pass over the rows puts each row into
its slot, and the best ``k`` of a slot are kept, within a tile, within a task and
after the shuffle. A window reaches from its upper limit down, so it is answered
by the slots from there on: merged from the lowest slot upwards, each suffix
keeps its best ``k``, and the lower limit then ends the list.

Anchors and rows are cut into blocks of bounded size, and each pair of blocks is
a tile. The components are made integers once, before anything is repeated, and
travel as 16-bit numbers where they fit. Products are exact: in floating point
where all partial sums are whole numbers below its limit, else in Python integers.

Nulls and ties: rows with a null label or vector, or with a null or non-finite
component (256 times it included), take no part. Rows alike in id, label and
integer components count once; other rows that share an id are rows of their
own, but none is a positive of an anchor with that id. A row without an id is no
anchor and comes after all others of its score. Only vectors of equal length
meet. Scores outside 64 bits are set to the nearest that fits. Columns besides the
three are ignored; an empty table gives an empty table.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyline.llm.common import stored, table

EVERY = 100
POSITIVES = 5
NEGATIVES = 10
LOW, HIGH = 30, 90  # per cent of the positive's score
SCALE = 256.0
ANCHOR_BLOCK = 2048
ROW_BLOCK = 8192
PAIRS = 1 << 20
NO_ID = np.iinfo(np.int64).max
MOST = (1 << 63) - 1


def _packed(v: np.ndarray) -> bytes:
    return (v.astype("<i2") if v.size == 0 or np.abs(v).max() < 1 << 15 else v.astype("<f8")).tobytes()


def whole_vectors(rows: DataFrame, label: Column, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """``id, label, dim, v`` of the rows that take part, each once; ``v`` packs the components floor(256 x)."""
    def run(batches):
        for batch in batches:
            lists = batch.column(2)
            begins, ends = lists.offsets.to_numpy()[:-1], lists.offsets.to_numpy()[1:]
            flat = lists.values
            broken = flat.is_null().to_numpy(zero_copy_only=False)
            with np.errstate(over="ignore", invalid="ignore"):
                whole = np.floor(SCALE * flat.fill_null(0.0).to_numpy(zero_copy_only=False))
            before = np.append(0, np.cumsum(broken | ~np.isfinite(whole)))
            usable = np.flatnonzero(before[ends] == before[begins])
            vectors = [_packed(whole[begins[i]:ends[i]]) for i in usable]
            at = pa.array(usable)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(at), batch.column(1).take(at), pa.array((ends - begins)[usable], pa.int32()),
                 pa.array(vectors, pa.binary())], ["id", "label", "dim", "v"])

    plain = rows.select(F.col(id_col).cast("long").alias("id"), label.cast("long").alias("label"),
                        F.col(vector_col).cast("array<double>").alias("vector"))
    return plain.filter("label IS NOT NULL AND vector IS NOT NULL").mapInArrow(
        run, "id long, label long, dim int, v binary").distinct()


def _matrix(part: pa.Table) -> np.ndarray:
    vectors = part.column("v").to_pylist()
    dim = part.column("dim")[0].as_py()
    if all(len(v) == 2 * dim for v in vectors):
        return np.frombuffer(b"".join(vectors), "<i2").reshape(len(vectors), dim).astype(np.float32)
    return np.array([np.frombuffer(v, "<i2" if len(v) == 2 * dim else "<f8") for v in vectors], np.float64)


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """All inner products of the whole-numbered rows of ``a`` and ``b``, exactly, as int64."""
    bound = a.shape[1] * (int(np.abs(a).max(initial=0)) * int(np.abs(b).max(initial=0)))
    if bound < 1 << 53:
        kind = np.float32 if bound < 1 << 24 else np.float64
        return (a.astype(kind) @ b.astype(kind).T).astype(np.int64)
    a, b = ([[int(x) for x in row] for row in m] for m in (a, b))
    exact = [[max(-MOST, min(MOST, sum(x * y for x, y in zip(p, q)))) for q in b] for p in a]
    return np.array(exact, np.int64).reshape(len(a), len(b))


def best(scores: np.ndarray, fits: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, column) of the ``k`` largest fitting scores of each row, equal ones to the lesser column."""
    n = scores.shape[1]
    if np.abs(scores).max(initial=0) < (1 << 62) // max(n, 1):
        order = np.where(fits, scores * n + np.arange(n - 1, -1, -1), np.iinfo(np.int64).min)
        if n > k:
            near = np.argpartition(order, n - k, axis=1)[:, n - k:]
        else:
            near = np.broadcast_to(np.arange(n), scores.shape)
        i, j = np.nonzero(np.take_along_axis(fits, near, 1))
        return i, near[i, j]
    picked = [(i, j) for i in range(len(scores))
              for j in sorted(np.flatnonzero(fits[i]).tolist(), key=lambda j: (-int(scores[i, j]), j))[:k]]
    return tuple(np.array(picked, np.int64).reshape(-1, 2).T)


def _tiles(anchors: DataFrame, rows: DataFrame, pick: Callable, kind: str, schema: str) -> DataFrame:
    """``pick(anchor part, row ids, row labels, scores)`` for every tile; what it gives, with the anchor's key and the row's id."""
    def blocks(part: DataFrame, size: int):
        count = max(1, -(-part.count() // size))
        return part.withColumn("block", F.pmod(F.xxhash64("id", "label", "v"), F.lit(count)).cast("int")), count

    a, na = blocks(anchors, ANCHOR_BLOCK)
    r, nr = blocks(rows, ROW_BLOCK)
    # Anchors are repeated once per block of rows, rows once per block of anchors.
    a = a.withColumn("tile", F.explode(F.sequence(F.col("block").cast("long") * nr, F.col("block").cast("long") * nr + (nr - 1))))
    r = r.withColumn("tile", F.explode(F.sequence(F.col("block").cast("long"), F.lit(nr * (na - 1)) + F.col("block").cast("long"), F.lit(nr).cast("long"))))
    names = ["anchor", "id", "score", kind]
    types = [pa.int64(), pa.int64(), pa.int64(), pa.int32()]

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        found = [[], [], [], []]
        if left.num_rows and right.num_rows:
            right = right.sort_by([("id", "ascending")])  # nulls last
            ids = right.column("id").fill_null(NO_ID).to_numpy()
            labels, queries, vectors = right.column("label").to_numpy(), _matrix(left), _matrix(right)
            keys = left.column("anchor").to_numpy()
            step = max(1, PAIRS // len(ids))
            for at in range(0, left.num_rows, step):
                part = left.slice(at, step)
                scores = products(queries[at:at + step], vectors)
                i, j, slot = pick(part, ids, labels, scores)
                for held, more in zip(found, (keys[at + i], right.column("id").take(pa.array(j)).combine_chunks(), scores[i, j], slot)):
                    held.append(pa.array(more) if isinstance(more, np.ndarray) else more)
        columns = [pa.chunked_array(held, t) if held else pa.array([], t) for held, t in zip(found, types)]
        return pa.table(columns, names)

    # New names for the anchors' columns: both sides may come from one scan, whose columns a cogroup would take for its own.
    a = a.select(*[F.col(c).alias(c) for c in a.columns if c != "block"])
    return a.groupBy("tile", "dim").cogroup(r.drop("block").groupBy("tile", "dim")).applyInArrow(run, schema)


def _first(rows: DataFrame, within: list[str], k: int) -> DataFrame:
    order = Window.partitionBy(*within).orderBy(F.desc("score"), F.asc_nulls_last("id"))
    return rows.withColumn("n", F.row_number().over(order)).filter(F.col("n") <= k)


def positives(anchors: DataFrame, rows: DataFrame, k: int = POSITIVES) -> DataFrame:
    """``anchor, id, score, n``: the first ``k`` rows of each anchor's label under another id."""
    def pick(part, ids, labels, scores):
        own = part.column("id").to_numpy()
        fits = (part.column("label").to_numpy()[:, None] == labels[None, :]) & (own[:, None] != ids[None, :])
        i, j = best(scores, fits, k)
        return i, j, np.zeros(len(i), np.int32)

    kept = _tiles(anchors, rows, pick, "slot", "anchor long, id long, score long, slot int")
    return _first(kept, ["anchor"], k).drop("slot")


def slot_winners(anchors: DataFrame, rows: DataFrame, k: int = NEGATIVES) -> DataFrame:
    """``anchor, id, score, slot``: the best ``k`` rows of other labels in each slot.

    ``anchors`` bring ``uppers``, the slots' upper limits, largest first, and
    ``least``, below which no window reaches. Slot ``s`` holds the scores up to
    ``uppers[s]`` and above ``uppers[s + 1]``.
    """
    def pick(part, ids, labels, scores):
        limits = part.column("uppers").to_pylist()
        most = max(map(len, limits))
        uppers = np.array([u + [u[-1]] * (most - len(u)) for u in limits], np.int64)  # repeats make empty slots
        other = part.column("label").to_numpy()[:, None] != labels[None, :]
        other &= scores >= part.column("least").to_numpy()[:, None]
        found = []
        for s in range(most):
            fits = other & (scores <= uppers[:, s, None])
            if s + 1 < most:
                fits &= scores > uppers[:, s + 1, None]
            i, j = best(scores, fits, k)
            # An anchor's last limit, where repeated, holds the scores in its last repeat.
            last = np.array([len(u) - 1 for u in limits], np.int32)
            found.append((i, j, np.minimum(last[i], s).astype(np.int32)))
        return tuple(np.concatenate(x) for x in zip(*found))

    kept = _tiles(anchors, rows, pick, "slot", "anchor long, id long, score long, slot int")
    return _first(kept, ["anchor", "slot"], k).drop("n")


def suffix_merges(winners: list[tuple], slots: int, k: int = NEGATIVES) -> list[list[tuple]]:
    """For each slot the best ``k`` of it and all lower slots; ``winners`` are (slot, score, id)."""
    own = [[] for _ in range(slots)]
    for slot, score, row in winners:
        own[slot].append((score, row))
    merged, below = [[]] * slots, []
    for s in reversed(range(slots)):
        # Every score of a slot is above those of lower slots, so merging is laying end to end.
        own[s].sort(key=lambda x: (-x[0], x[1] is None, x[1] or 0))
        below = merged[s] = (own[s] + below)[:k]
    return merged


def mine(rows: DataFrame, anchors: DataFrame, k: int = NEGATIVES, n_positives: int = POSITIVES) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score``.

    Both tables as ``whole_vectors`` gives them; the anchors are among the rows.
    """
    # Rows are distinct, so the key of an anchor tells rows of one id apart.
    anchors = anchors.withColumn("anchor", F.xxhash64("id", "label", "v"))
    liked = stored(positives(anchors, rows, n_positives), "negatives-positives")
    limits = liked.withColumns({"upper": F.expr(f"CAST(floor(CAST(score AS DECIMAL(20,0)) * {HIGH} / 100) AS LONG)"),
                                "lower": F.expr(f"CAST(ceil(CAST(score AS DECIMAL(20,0)) * {LOW} / 100) AS LONG)")})
    asked = limits.groupBy("anchor").agg(
        F.collect_list(F.struct("n", "id", "score", "upper", "lower")).alias("positives"),
        F.reverse(F.array_sort(F.collect_set("upper"))).alias("uppers"), F.min("lower").alias("least"))
    queries = stored(anchors.join(asked, "anchor"), "negatives-limits")
    winners = slot_winners(queries.drop("positives"), rows, k).groupBy("anchor").agg(
        F.collect_list(F.struct("slot", "score", "id")).alias("winners"))

    def answer(batches):
        for batch in batches:
            out = []
            for row in batch.to_pylist():
                merged = suffix_merges([(w["slot"], w["score"], w["id"]) for w in row["winners"]], len(row["uppers"]), k)
                for p in sorted(row["positives"], key=lambda p: p["n"]):
                    found = [x for x in merged[row["uppers"].index(p["upper"])] if x[0] >= p["lower"]]
                    out += [(row["id"], p["id"], n, x[1], p["score"], x[0]) for n, x in enumerate(found, 1)]
            columns = list(zip(*out)) or [()] * 6
            types = [pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names)

    schema = ("anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long")
    names = [part.split()[0] for part in schema.split(", ")]
    # An anchor has a bounded number of positives and slot winners, whatever the table holds.
    return queries.select("anchor", "id", "positives", "uppers").join(winners, "anchor").mapInArrow(answer, schema)


def query(spark, sf_dir: str) -> DataFrame:
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    rows = stored(whole_vectors(table(spark, sf_dir, "embeddings"), label), "negatives-rows")
    return mine(rows, rows.filter(F.col("id") % EVERY == 0))


SQL = """
WITH vectors AS (
  SELECT DISTINCT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT a.vec_id AS anchor_id, r.vec_id AS row_id, a.label = r.label AS alike,
         CAST(list_inner_product(a.v, r.v) AS BIGINT) AS score
  FROM vectors a JOIN vectors r ON a.vec_id % 100 = 0 AND len(a.v) = len(r.v)),
positives AS (
  SELECT anchor_id, row_id AS positive_id, score AS positive_score FROM scored
  WHERE alike AND row_id IS DISTINCT FROM anchor_id
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, row_id NULLS LAST) <= 5)
SELECT p.anchor_id, p.positive_id,
       CAST(row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY s.score DESC, s.row_id NULLS LAST) AS INTEGER) AS rank,
       s.row_id AS negative_id, p.positive_score, s.score AS negative_score
FROM positives p JOIN scored s ON s.anchor_id = p.anchor_id AND NOT s.alike
 AND 30 * p.positive_score <= 100 * s.score AND 100 * s.score <= 90 * p.positive_score
QUALIFY rank <= 10
"""
