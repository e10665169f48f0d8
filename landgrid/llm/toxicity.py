"""Toxicity by non-negative positive-unlabelled learning.

Confirmed toxic texts (P) and texts whose labels are not looked at (U) train a
logistic model over hashed words and word beginnings. The risk estimator is
corrected by the class prior p, with both classes brought to equal weight:
R_P(+) / 2 + max(0, R_U(-) - p * R_P(-)) / (2 * (1 - p)); where the bracket falls
below zero, the step goes back along it.

Training reads a bounded, documented number of labelled rows (``MOST_POSITIVE``,
``MOST_UNLABELLED``), the first ones by hash of id; every text is scored, whole.

Defined results: null text counts as empty; a text without words has the score
of the model's bias alone; without toxic labels every score is 0. Repeated rows
get equal scores; of rows that share a labelled id one text is learned from; texts
are read whole, whatever their length; only the id and the text column are read, so
other columns' names don't matter.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from landgrid.llm.common import table, written

MOST_POSITIVE = 4000
MOST_UNLABELLED = 12000
DIMENSIONS = 1 << 18
#: Lengths of the word beginnings that count besides the word.
BEGINNINGS = (4, 6)
EPOCHS = 20
#: Features that training looks at: by so many standard errors their shares in P and U must differ.
LEAST_Z = 4.5
LEAST_LIFT = 2.0
BATCH = 64
RATE = 0.15
DECAY = 1e-5
SEED = 11
MEMO = 300_000
_WORD = re.compile(r"[^\W_]+")


class Features:
    """Distinct hashed features of a text; the hashes of words are remembered up to a bound."""

    def __init__(self):
        import xxhash

        self.hash, self.memo = xxhash.xxh32_intdigest, {}

    def of_word(self, word: str) -> tuple[int, ...]:
        found = self.memo.get(word)
        if found is None:
            kinds = [f"w {word}", *(f"b {word[:k]}" for k in BEGINNINGS if len(word) > k)]
            found = self.memo[word] = tuple(self.hash(k) % DIMENSIONS for k in kinds)
        return found

    def __call__(self, text: str) -> np.ndarray:
        if len(self.memo) > MEMO:
            self.memo.clear()
        ids: set[int] = set()
        for word in set(_WORD.findall(text.lower())):
            ids.update(self.of_word(word))
        return np.fromiter(sorted(ids), np.int32, len(ids))


@dataclass
class Model:
    weights: np.ndarray | None = None
    bias: float = 0.0

    def margin(self, ids: list[np.ndarray]) -> np.ndarray:
        flat, ends = np.concatenate([*ids, np.zeros(0, np.int32)]), np.cumsum([0, *map(len, ids)])
        sums = np.concatenate([[0.0], np.cumsum(self.weights[flat].astype(float))])
        return self.bias + sums[ends[1:]] - sums[ends[:-1]]

    def score(self, ids: list[np.ndarray]) -> np.ndarray:
        if self.weights is None:
            return np.zeros(len(ids))
        return 1 / (1 + np.exp(-np.clip(self.margin(ids), -60, 60)))


def telling(positive: list[np.ndarray], unlabelled: list[np.ndarray]) -> np.ndarray:
    """Whether a feature's shares in P and in U differ by more than LEAST_Z standard errors and the factor LEAST_LIFT."""
    p, u = (np.bincount(np.concatenate(x), minlength=DIMENSIONS) / len(x) for x in (positive, unlabelled))
    both = (p * len(positive) + u * len(unlabelled)) / (len(positive) + len(unlabelled))
    spread = np.sqrt(np.maximum(both * (1 - both), 1e-12) * (1 / len(positive) + 1 / len(unlabelled)))
    return (np.abs(p - u) > LEAST_Z * spread) & (np.maximum(p, u) > LEAST_LIFT * np.minimum(p, u))


def train(positive: list[np.ndarray], unlabelled: list[np.ndarray], prior: float, epochs: int = EPOCHS) -> Model:
    """Minimise the non-negative risk with logistic loss by Adagrad over mini-batches."""
    rng = np.random.RandomState(SEED)
    chosen = telling(positive, unlabelled)
    positive, unlabelled = ([x[chosen[x]] for x in rows] for rows in (positive, unlabelled))
    model = Model(np.zeros(DIMENSIONS), 0.0)
    other = 0.5 / (1 - prior)
    seen, seen_bias = np.full(DIMENSIONS, 1e-2), 1e-2
    steps = max(1, -(-max(len(positive), len(unlabelled)) // (3 * BATCH)))
    order_p, order_u = np.zeros(0, int), np.zeros(0, int)
    for _ in range(epochs * steps):
        if len(order_p) < BATCH:
            order_p = np.concatenate([order_p, rng.permutation(len(positive))])
        if len(order_u) < 3 * BATCH:
            order_u = np.concatenate([order_u, rng.permutation(len(unlabelled))])
        own_p, order_p = [positive[i] for i in order_p[:BATCH]], order_p[BATCH:]
        own_u, order_u = [unlabelled[i] for i in order_u[: 3 * BATCH]], order_u[3 * BATCH :]
        zp, zu = model.margin(own_p), model.margin(own_u)
        sp, su = (1 / (1 + np.exp(-np.clip(z, -60, 60))) for z in (zp, zu))
        negative = np.logaddexp(0, zu).mean() - prior * np.logaddexp(0, zp).mean()
        gp, gu = -prior * sp / len(zp) * other, su / len(zu) * other
        if negative >= 0:
            gp = gp + 0.5 * (sp - 1) / len(zp)
        else:
            gp, gu = -gp, -gu
        rows = [*own_p, *own_u]
        by_row = np.concatenate([gp, gu])
        flat = np.concatenate(rows)
        ids, at = np.unique(flat, return_inverse=True)
        grad = np.bincount(at, np.repeat(by_row, [len(r) for r in rows]), len(ids)) + DECAY * model.weights[ids]
        seen[ids] += grad * grad
        model.weights[ids] -= RATE * grad / np.sqrt(seen[ids])
        seen_bias += by_row.sum() ** 2
        model.bias -= RATE * by_row.sum() / np.sqrt(seen_bias)
    return model


def _telling(found: DataFrame, n_positive: int, n_unlabelled: int) -> DataFrame:
    """(feature): those of ``telling``, from counts that every partition makes of (positive, unlabelled, ids)."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((2, DIMENSIONS), np.int64)
        for batch in batches:
            for p, u, ids in zip(*(batch.column(c).to_pylist() for c in ("positive", "unlabelled", "ids"))):
                own = np.frombuffer(ids, np.int32)
                sums[0][own] += p
                sums[1][own] += u
        at = np.flatnonzero(sums.any(0)).astype(np.int32)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(sums[0][at]), pa.array(sums[1][at])], names=["feature", "p", "u"])

    counts = found.mapInArrow(count, "feature int, p long, u long").groupBy("feature").agg(F.sum("p").alias("p"), F.sum("u").alias("u"))
    p, u, both = F.col("p") / n_positive, F.col("u") / n_unlabelled, (F.col("p") + F.col("u")) / (n_positive + n_unlabelled)
    spread = F.sqrt(F.greatest(both * (1 - both), F.lit(1e-12)) * (1 / n_positive + 1 / n_unlabelled))
    return counts.where((F.abs(p - u) > LEAST_Z * spread) & (F.greatest(p, u) > LEAST_LIFT * F.least(p, u))).select("feature")


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> Model:
    """labels: (id, label), label 1 for confirmed toxic texts; others serve as unlabelled.

    Features are counted where the texts are; of the chosen rows only the features that training looks at reach the driver.
    """
    spark = docs.sparkSession
    known = labels.where(F.col("label").isNotNull() & F.col(id_col).isNotNull())
    prior = known.agg(F.avg(F.col("label").cast("double"))).first()[0]
    if not prior:
        return Model()
    by_hash = [F.xxhash64(id_col), F.col(id_col)]
    sample = {0: known.orderBy(*by_hash).limit(MOST_UNLABELLED), 1: known.where("label = 1").orderBy(*by_hash).limit(MOST_POSITIVE)}
    chosen = {k: {r[0] for r in v.select(id_col).collect()} for k, v in sample.items()}
    flags = T.StructType([docs.schema[id_col], T.StructField("positive", T.BooleanType()), T.StructField("unlabelled", T.BooleanType())])
    ids = spark.createDataFrame([(i, i in chosen[1], i in chosen[0]) for i in sorted(chosen[0] | chosen[1])], flags)  # at most both bounds' ids
    schema = T.StructType([docs.schema[id_col], T.StructField("ids", T.BinaryType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        make = Features()
        for batch in batches:
            found = [make(t or "").tobytes() for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.binary())], names=[id_col, "ids"])

    own = docs.select(id_col, text_col).join(F.broadcast(ids), id_col, "left_semi").mapInArrow(run, schema)
    rows = written(own.groupBy(id_col).agg(F.min("ids").alias("ids")).join(F.broadcast(ids), id_col), "toxicity_rows")  # one text where an id repeats
    n = rows.agg(F.count_if("positive"), F.count_if("unlabelled")).first()
    if not all(n):
        return Model()
    telling_ids = np.sort(np.array([r[0] for r in _telling(rows, *n).collect()], np.int32))

    def only(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept = [np.intersect1d(np.frombuffer(x, np.int32), telling_ids, assume_unique=True).astype(np.int32).tobytes() for x in batch.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(kept, pa.binary())], names=[id_col, "ids"])

    held = {r[0]: np.frombuffer(r[1], np.int32) for r in rows.select(id_col, "ids").mapInArrow(only, schema).collect()}
    return train(*([held[i] for i in sorted(chosen[k]) if i in held] for k in (1, 0)), min(prior, 0.99))


def scores(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text", out: str = "score") -> DataFrame:
    """(id, score) of each text; a map."""
    schema = T.StructType([docs.schema[id_col], T.StructField(out, T.DoubleType())])
    held = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        make, own = Features(), held.value
        for batch in batches:
            found: list[float] = []
            texts = batch.column(1)
            for a in range(0, len(texts), 256):
                found.extend(own.score([make(t or "") for t in texts.slice(a, 256).to_pylist()]))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.float64())], names=[id_col, out])

    return docs.select(id_col, text_col).mapInArrow(run, schema)


def held_out() -> Column:
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 5 == 0, F.lit(False))


def op6_toxicity(spark, sf_dir: str) -> DataFrame:
    """A toxicity score for every row of ``documents``."""
    docs = table(spark, sf_dir, "documents")
    labels = table(spark, sf_dir, "labels").where(~held_out()).select("doc_id", F.col("toxic").alias("label"))
    found = scores(docs, fit(docs, labels))
    return found.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
