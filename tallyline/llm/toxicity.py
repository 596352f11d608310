"""Toxicity by a factorization machine over hashed terms.

A text's terms are its words and their first letters (the stems of inflected words),
hashed into ``BUCKETS`` buckets. The score is a logistic function of a
bias, a weight per bucket, and for each pair of buckets the inner product of
their factor vectors. A pair can so be worse than its parts: an insult beside
the mention of a group scores higher than either alone.

The machine learns from the rows of a sample of labelled ids, about ``SAMPLE`` of
them (those of least id digest): which buckets it sees, by document counts per
bucket and label, summed in Spark and ranked by chi-square, and the fit itself,
with ``FEATURES`` buckets. Both bounds are parameters. The sample is not drawn by
label, so a rare label is as rare in it, and an id with many rows brings them all.
What is fitted is all that the driver holds. Every document is scored whole.

Nulls and ties: a null or empty text has no terms and scores the bias; rows that
repeat a text score alike; a null doc_id is taken as the empty text for its
fold. Labels that are null, or of documents that are not there, are left out; a
doc_id labelled twice counts twice. With no labels of one kind, the score is
the share of toxic labels (0 without labels).
"""

from __future__ import annotations

import re
from dataclasses import astuple, dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyline.llm.common import stored, table

BUCKETS = 1 << 18
FEATURES = 4096
LEAST_DOCS = 4
SAMPLE = 20_000
FACTORS = 8
EPOCHS = 12
THRESHOLD = 0.3
STEMS = (3, 4, 5, 6)
MOST_CACHED = 500_000
_TERM = re.compile(r"\w+")


def held_out(doc_id: Column) -> Column:
    """The fold that is never learned from."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % 4 == 2


def buckets(word: str) -> tuple[int, ...]:
    """The hash buckets of a word: its own, and those of its first letters."""
    terms = [(word, 0), *((word[:n], n) for n in STEMS if n < len(word))]
    return tuple(xxhash.xxh64_intdigest(term.encode(), kind) % BUCKETS for term, kind in terms)


def term_buckets(text: str | None) -> set[int]:
    return {b for word in set(_TERM.findall((text or "").lower())) for b in buckets(word)}


@dataclass
class Machine:
    """A fitted machine over the chosen buckets."""

    chosen: np.ndarray
    bias: float
    linear: np.ndarray
    factors: np.ndarray

    def raw(self, rows: np.ndarray, features: np.ndarray, count: int) -> np.ndarray:
        """Scores before the logistic function; ``rows`` ascends and says whose each feature is."""
        out = np.full(count, self.bias) + np.bincount(rows, self.linear[features], count)
        for k in range(self.factors.shape[1]):
            v = self.factors[features, k]
            out += 0.5 * (np.bincount(rows, v, count) ** 2 - np.bincount(rows, v * v, count))
        return out


def logistic(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


def fit(lists: list[np.ndarray], labels: np.ndarray, chosen: np.ndarray, factors: int = FACTORS,
        epochs: int = EPOCHS, seed: int = 1, rate: float = 0.1, shrink: float = 1e-4) -> Machine:
    """Fit by AdaGrad in mini-batches. ``lists``: the feature numbers of each row."""
    random = np.random.default_rng(seed)
    share = labels.mean() if len(labels) else 0.0
    machine = Machine(chosen, float(np.log((share + 1e-6) / (1 - share + 1e-6))), np.zeros(len(chosen)),
                      random.normal(0, 0.02, (len(chosen), factors)))
    if not 0 < share < 1:
        return machine
    slope_b, slope_w, slope_v = 1e-6, np.full(len(chosen), 1e-6), np.full(machine.factors.shape, 1e-6)
    for _ in range(epochs):
        order = random.permutation(len(lists))
        for at in range(0, len(order), 64):
            part = order[at:at + 64]
            sizes = np.array([len(lists[i]) for i in part])
            rows = np.repeat(np.arange(len(part)), sizes)
            features = np.concatenate([lists[i] for i in part]) if sizes.sum() else np.zeros(0, np.int64)
            off = logistic(machine.raw(rows, features, len(part))) - labels[part]
            slope_b += (g := off.sum()) ** 2
            machine.bias -= rate * g / np.sqrt(slope_b)
            used, back = np.unique(features, return_inverse=True)
            g = np.bincount(back, off[rows], len(used)) + shrink * machine.linear[used]
            slope_w[used] += g ** 2
            machine.linear[used] -= rate * g / np.sqrt(slope_w[used])
            v = machine.factors[features]
            sums = np.zeros((len(part), v.shape[1]))
            np.add.at(sums, rows, v)
            each = off[rows][:, None] * (sums[rows] - v)
            g = np.zeros((len(used), v.shape[1]))
            np.add.at(g, back, each)
            g += shrink * machine.factors[used]
            slope_v[used] += g ** 2
            machine.factors[used] -= rate * g / np.sqrt(slope_v[used])
    return machine


def labelled_rows(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``doc_id, toxic, terms`` of the documents that may be learned from."""
    def run(batches):
        for batch in batches:
            terms = [sorted(term_buckets(t.as_py())) for t in batch.column(2)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(terms, pa.list_(pa.int32()))],
                                             ["doc_id", "toxic", "terms"])

    known = labels.filter("toxic in (0, 1) and doc_id is not null").filter(~held_out(F.col("doc_id"))).select(
        "doc_id", F.col("toxic").cast("int").alias("toxic"))
    rows = docs.select("doc_id", "text").join(known, "doc_id").select("doc_id", "toxic", "text")
    return rows.mapInArrow(run, "doc_id long, toxic int, terms array<int>")


def sample_of(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """Labels of at most about ``sample`` documents, chosen by a digest of their ids."""
    known = labels.filter("toxic in (0, 1) and doc_id is not null").filter(~held_out(F.col("doc_id")))
    total = known.count()
    share = min(1.0, sample / max(total, 1))
    return known.filter(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) < int(share * (1 << 30)))


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, features: int = FEATURES) -> Machine:
    """The machine fitted to the labelled documents outside the held-out fold."""
    rows = stored(labelled_rows(docs, sample_of(docs, labels, sample)), "toxic-terms")
    n0, n1 = (rows.filter(f"toxic = {k}").count() for k in (0, 1))
    found = rows.select("toxic", F.explode("terms").alias("bucket")).groupBy("bucket").agg(
        F.sum(F.lit(1) - F.col("toxic")).alias("a"), F.sum("toxic").alias("b"))
    a, b, total = F.col("a").cast("double"), F.col("b").cast("double"), float(max(n0 + n1, 1))
    share = float(n1) / total
    expected = (a + b) * F.lit(share)
    chi = F.pow(b - expected, 2) / F.greatest(expected * (1 - share), F.lit(1e-9))
    best = (found.filter(a + b >= LEAST_DOCS).withColumn("chi", chi).orderBy(F.desc("chi"), "bucket").limit(features)
            .select("bucket").toPandas())
    chosen = np.sort(best["bucket"].to_numpy(np.int64))
    learned = rows.select("toxic", F.array_intersect("terms", F.array(*[F.lit(int(c)) for c in chosen]).cast("array<int>"))
                          .alias("terms"), "doc_id").toPandas().sort_values("doc_id", kind="stable")
    lists = [np.searchsorted(chosen, np.sort(np.asarray(t, np.int64))) for t in learned["terms"]]
    return fit(lists, learned["toxic"].to_numpy(np.float64), chosen)


def scores(texts, model: Machine, place: dict[int, int], known: dict[str, tuple[int, ...]]) -> np.ndarray:
    """Scores of a column of texts. ``place``: feature number by bucket; ``known``: features by word, filled here."""
    rows, features = [], []
    for i, text in enumerate(texts):
        if len(known) > MOST_CACHED:
            known.clear()
        got = set()
        for word in set(_TERM.findall((text.as_py() or "").lower())):
            own = known.get(word)
            if own is None:
                own = known[word] = tuple(place[b] for b in buckets(word) if b in place)
            if own:
                got.update(own)
        rows.extend([i] * len(got))
        features.extend(sorted(got))
    return logistic(model.raw(np.array(rows, np.int64), np.array(features, np.int64), len(texts)))


def scored(docs: DataFrame, machine: Machine, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, score`` for every row of ``docs``."""
    shared = docs.sparkSession.sparkContext.broadcast(astuple(machine))  # bounded by FEATURES

    def run(batches):
        model, known = Machine(*shared.value), {}
        place = {int(b): i for i, b in enumerate(model.chosen)}
        for batch in batches:
            score = scores(batch.column(1), model, place, known)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(score, pa.float64())], ["doc_id", "score"])

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(
        run, "doc_id long, score double")


def judged(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``doc_id, held_out, score, predicted`` of every row of ``docs``."""
    return scored(docs, train(docs, labels)).select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
        F.when(F.col("score") >= THRESHOLD, 1).otherwise(0).alias("predicted"))


def accepted(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs`` that are not judged toxic, with their columns."""
    rows = docs.select(F.struct(*docs.columns).alias("row"), "text")
    shared = docs.sparkSession.sparkContext.broadcast(astuple(train(docs, labels)))  # bounded by FEATURES

    def run(batches):
        model, known = Machine(*shared.value), {}
        place = {int(b): i for i, b in enumerate(model.chosen)}
        for batch in batches:
            yield batch.filter(pa.array(scores(batch.column(1), model, place, known) < THRESHOLD)).select(["row"])

    return rows.mapInArrow(run, rows.select("row").schema).select("row.*")


def query(spark, sf_dir: str) -> DataFrame:
    return judged(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
