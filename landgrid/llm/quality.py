"""Document quality: a kernel ridge classifier by random Fourier features.

Statistics of each whole text (no label, language, source or id among them) are
standardised and mapped to random Fourier features, which approximate a
Gaussian kernel. Ridge scores are fitted from normal equations that every
partition sums on its own; a reduction tree keyed by partition adds the sums up. An
isotonic fit on a fold of its own turns scores into probabilities.

Defined results: null text counts as empty; empty texts are scored like others
(all statistics zero); without labels of both kinds every score is the share of
label 1 (0.5 without any label). Repeated rows get equal scores; texts are read whole,
whatever their length; scoring reads the id and the text column alone, and
``keep_good`` passes all columns through, so other columns' names don't matter.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from landgrid.llm.common import table, written
from landgrid.llm.fingerprint import WordHashes, shingles

#: Random Fourier features, width of the Gaussian kernel in standard deviations, ridge per row, seed.
FEATURES = 256
WIDTH = 4.0
RIDGE = 1e-4
SEED = 7
#: So many partitions' sums are added at a time, level by level, until as few reach the driver.
FAN_IN = 16
#: Scores are calibrated in steps of 1 / STEPS.
STEPS = 2000
KEEP_FROM = 0.7

STATISTICS = (
    "log_words word_bytes symbols exclamations capitals bars type_token repeats distinct_3 top_word digits lines repeated_lines stops non_ascii capital_words".split()
)
_CLASS = np.zeros((256, 9))
for _i, _chars in enumerate((b"#*$%&<>@^~", b"!", b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"|", b"0123456789", b".,;:?", bytes(range(128, 256)), b"abcdefghijklmnopqrstuvwxyz", b"\n")):
    _CLASS[list(_chars), _i] = 1


def statistics(text: bytes, hashes: WordHashes) -> np.ndarray:
    """The statistics of one text, all finite."""
    words = text.split()
    n = len(words)
    out = np.zeros(len(STATISTICS), np.float32)
    if not n:
        return out
    symbols, shouts, upper, bars, digits, stops, other, lower, breaks = np.bincount(np.frombuffer(text, np.uint8), minlength=256) @ _CLASS
    h = hashes(words)
    _, counts = np.unique(h, return_counts=True)
    threes = shingles(h, 3)
    lines = [x for x in text.split(b"\n") if x.strip()]
    out[:] = (
        np.log1p(n),
        np.log1p(len(text) / n),
        np.sqrt(symbols / n),
        np.sqrt(shouts / n),
        upper / max(1.0, upper + lower),
        np.sqrt(bars / n),
        np.log1p(len(counts)) / np.log1p(n),
        float((h[1:] == h[:-1]).mean()) if n > 1 else 0.0,
        len(np.unique(threes)) / len(threes),
        counts.max() / n,
        np.sqrt(digits / n),
        np.log1p(breaks) / np.log1p(n),
        1 - len(set(lines)) / len(lines),
        np.sqrt(stops / n),
        other / len(text),
        sum(w.isupper() for w in words) / n,
    )
    return out


def features(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, features array<float>) of each row; a map."""
    schema = T.StructType([docs.schema[id_col], T.StructField("features", T.ArrayType(T.FloatType()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for batch in batches:
            rows = [statistics(t or b"", hashes) for t in batch.column(1).cast(pa.binary()).to_pylist()]
            flat = np.concatenate(rows) if rows else np.zeros(0, np.float32)
            values = pa.ListArray.from_arrays(np.arange(len(rows) + 1, dtype=np.int32) * len(STATISTICS), pa.array(flat))
            yield pa.RecordBatch.from_arrays([batch.column(0), values], names=[id_col, "features"])

    return docs.select(id_col, text_col).mapInArrow(run, schema)


@dataclass
class Model:
    """What scoring needs; a few hundred KB whatever the corpus."""

    prior: float = 0.5
    mean: np.ndarray | None = None
    scale: np.ndarray | None = None
    weights: np.ndarray | None = None
    phases: np.ndarray | None = None
    beta: np.ndarray | None = None
    steps: np.ndarray = field(default_factory=lambda: np.zeros(0))
    values: np.ndarray = field(default_factory=lambda: np.zeros(0))

    def fourier(self, x: np.ndarray) -> np.ndarray:
        z = np.cos((x - self.mean) / self.scale @ self.weights + self.phases) * np.sqrt(2 / len(self.phases))
        return np.hstack([z, np.ones((len(x), 1))])

    def raw(self, x: np.ndarray) -> np.ndarray:
        return self.fourier(x) @ self.beta

    def score(self, x: np.ndarray) -> np.ndarray:
        if self.beta is None or not len(x):
            return np.full(len(x), self.prior)
        raw = self.raw(x)
        return np.interp(raw, self.steps, self.values) if len(self.steps) else np.clip(raw, 0, 1)


def _rows(batch: pa.RecordBatch, name: str) -> np.ndarray:
    values = batch.column(name)
    return values.flatten().to_numpy(zero_copy_only=False).reshape(len(values), -1).astype(float) if len(values) else np.zeros((0, len(STATISTICS)))


def _summed(labelled: DataFrame, model: Model) -> tuple[np.ndarray, np.ndarray]:
    """Z'Z and Z'y, summed by partition, then FAN_IN sums at a time; no task and not the driver holds more."""
    d = len(model.phases) + 1

    def partition(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        total = np.zeros((d, d + 1))
        for batch in batches:
            z, y = model.fourier(_rows(batch, "features")), batch.column("label").to_numpy(zero_copy_only=False)
            total += z.T @ np.column_stack([z, y])
        yield pa.RecordBatch.from_arrays([pa.array([TaskContext.get().partitionId()], pa.int32()), pa.array([total.tobytes()])], names=["part", "sums"])

    def reduce(pdf):
        total = sum(np.frombuffer(b) for b in pdf["sums"])
        return pdf.head(1).assign(sums=[total.tobytes()])

    schema = "part int, sums binary"
    parts = written(labelled.select("features", "label").mapInArrow(partition, schema), "normal_equations")
    left = (parts.agg(F.max("part")).first()[0] or 0) + 1
    while left > FAN_IN:
        left = -(-left // FAN_IN)
        parts = written(parts.withColumn("part", F.pmod("part", F.lit(left))).groupBy("part").applyInPandas(reduce, schema), "normal_equations")
    total = sum((np.frombuffer(r["sums"]) for r in parts.collect()), np.zeros(d * (d + 1))).reshape(d, d + 1)
    return total[:, :-1], total[:, -1]


def isotonic(x: np.ndarray, n: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pool adjacent violators over sorted x with n rows of sum y; block centres and their means."""
    held: list[list[float]] = []
    for a, k, s in zip(x.tolist(), n.tolist(), y.tolist()):
        held.append([a * k, k, s])
        while len(held) > 1 and held[-2][2] * held[-1][1] >= held[-1][2] * held[-2][1]:
            last = held.pop()
            held[-1] = [p + q for p, q in zip(held[-1], last)]
    return np.array([a / k for a, k, _ in held]), np.array([s / k for _, k, s in held])


def fit(feats: DataFrame, labels: DataFrame, calibrate: Column, id_col: str = "doc_id") -> Model:
    """Fit on rows of labels (id, label 0/1) of which ``calibrate`` sets those of the isotonic fit apart.

    All labelled rows count. They are joined on their statistics, never on texts.
    """
    labels = labels.where(F.col("label").isNotNull()).select(id_col, F.col("label").cast("double").alias("label"), calibrate.alias("_calibrates"))
    joined = written(feats.join(labels, id_col).select("features", "label", "_calibrates"), "labelled")
    fold = joined.where(~F.col("_calibrates"))
    columns = [F.col("features")[i].cast("double") for i in range(len(STATISTICS))]
    stats = fold.agg(F.count("*").alias("n"), F.avg("label").alias("prior"), F.array(*map(F.avg, columns)).alias("mean"), F.array(*map(F.stddev_pop, columns)).alias("sd")).first()
    if not stats["n"] or stats["prior"] in (0.0, 1.0):
        return Model(prior=0.5 if stats["prior"] is None else stats["prior"])
    rng = np.random.RandomState(SEED)
    sd = np.array(stats["sd"])
    model = Model(stats["prior"], np.array(stats["mean"]), np.where(sd > 1e-6, sd, 1.0), rng.normal(size=(len(STATISTICS), FEATURES)) / WIDTH, rng.uniform(0, 2 * np.pi, FEATURES))
    zz, zy = _summed(fold, model)
    penalty = np.eye(len(zz)) * RIDGE * stats["n"]
    penalty[-1, -1] = 1e-9
    model.beta = np.linalg.solve(zz + penalty, zy)

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            step = np.clip(np.rint(model.raw(_rows(batch, "features")) * STEPS), -STEPS, 2 * STEPS).astype(np.int32) if len(batch) else np.zeros(0, np.int32)
            yield pa.RecordBatch.from_arrays([pa.array(step), batch.column("label")], names=["step", "label"])

    apart = joined.where("_calibrates").select("features", "label").mapInArrow(scored, "step int, label double")
    bins = apart.groupBy("step").agg(F.count("*").alias("n"), F.sum("label").alias("y")).collect()  # at most 3 * STEPS rows
    if bins:
        x, n, y = np.array(sorted((r["step"] / STEPS, r["n"], r["y"]) for r in bins)).T
        model.steps, model.values = isotonic(x, n, y)
    return model


def score_features(feats: DataFrame, model: Model, id_col: str = "doc_id", out: str = "score") -> DataFrame:
    """(id, score) of each row of features."""
    schema = T.StructType([feats.schema[id_col], T.StructField(out, T.DoubleType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(model.score(_rows(batch, "features")), pa.float64())], names=[id_col, out])

    return feats.select(id_col, "features").mapInArrow(run, schema)


def keep_good(docs: DataFrame, model: Model, threshold: float = KEEP_FROM, text_col: str = "text") -> DataFrame:
    """The rows of docs, all their columns, whose score reaches the threshold; a map."""
    at = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for batch in batches:
            rows = [statistics(t or b"", hashes) for t in batch.column(at).cast(pa.binary()).to_pylist()]
            if rows:
                yield batch.filter(pa.array(model.score(np.array(rows, float)) >= threshold))

    return docs.mapInArrow(run, docs.schema)


def crc_of(column: str, modulus: int) -> Column:
    return F.crc32(F.col(column).cast("string")) % modulus


def quality_labels(spark, sf_dir: str) -> tuple[DataFrame, Column]:
    """Labels outside the held-out fold, and which of them calibrate."""
    labels = table(spark, sf_dir, "labels").where(crc_of("doc_id", 4) != 2).select("doc_id", F.col("quality").alias("label"))
    return labels, crc_of("doc_id", 4) == 3


def op5_quality(spark, sf_dir: str) -> DataFrame:
    """A quality score for every row of ``documents``."""
    feats = written(features(table(spark, sf_dir, "documents")), "quality")
    model = fit(feats, *quality_labels(spark, sf_dir))
    held_out = F.coalesce(crc_of("doc_id", 4) == 2, F.lit(False)).alias("held_out")
    return score_features(feats, model).select("doc_id", held_out, "score", (F.col("score") >= KEEP_FROM).cast("int").alias("predicted"))
