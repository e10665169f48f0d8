import numpy as np
import pytest

from landgrid.llm.quality import WordHashes, features, fit, isotonic, keep_good, op5_quality, score_features, statistics


def auc(score, label):
    order = np.argsort(score, kind="stable")
    s, y = np.array(score)[order], np.array(label)[order]
    _, first, count = np.unique(s, return_index=True, return_counts=True)
    rank = np.repeat(first + (count + 1) / 2, count)
    pos = y.sum()
    return (rank[y == 1].sum() - pos * (pos + 1) / 2) / (pos * (len(y) - pos))


def test_statistics_are_finite():
    for t in (b"", b" \n", b"a", "É!! ***".encode(), b"x" * 10**6, b"| " * 50):
        assert np.isfinite(statistics(t, WordHashes())).all()


def test_isotonic():
    x, v = isotonic(np.arange(6.0), np.ones(6), np.array([0, 1, 0, 1, 1, 1.0]))
    assert v.tolist() == sorted(v) and v[0] == 0 and v[-1] == 1 and 0.5 in v


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.1"
    rows = op5_quality(spark, sf).collect()
    assert len(rows) == spark.read.parquet(f"{sf}/documents.parquet").count()
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7) for r in rows)
    by = {r.doc_id: r for r in rows}
    held = [(by[r.doc_id], r.quality) for r in spark.read.parquet(f"{sf}/labels.parquet").collect() if by[r.doc_id].held_out]
    assert auc([r.score for r, _ in held], [y for _, y in held]) > 0.97
    assert np.mean([r.predicted == y for r, y in held]) > 0.95


DOCS = [(1, None, "a"), (2, "", "a"), (3, "good words stand here " * 20, "a"), (3, "good words stand here " * 20, "a"), (None, "x", None)]


@pytest.mark.parametrize("labels", [[], [(1, 1)], [(1, None), (9, 0)], [(1, 0), (2, 1), (3, 1)]])
def test_few_labels_nulls_and_repeats(spark, labels):
    df = spark.createDataFrame(DOCS, "doc_id long, text string, score string")
    lab = spark.createDataFrame(labels, "doc_id long, label int")
    from pyspark.sql import functions as F

    feats = features(df)
    model = fit(feats, lab, F.col("doc_id") == 99)
    out = score_features(feats, model).collect()
    assert len(out) == len(DOCS) and all(0 <= r.score <= 1 for r in out)
    kept = keep_good(df, model, 0.0)
    assert kept.columns == df.columns and kept.count() == len(DOCS)
    assert keep_good(df.limit(0), model).count() == 0


def test_normal_equations_against_numpy(spark):
    """The fitted weights are those of a direct solution over all rows at once."""
    from pyspark.sql import functions as F

    import landgrid.llm.quality as q

    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").repartition(40)
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet").select("doc_id", F.col("quality").alias("label"))
    feats = features(docs)
    model = fit(feats, labels, F.col("doc_id") % 5 == 0)
    rows = [r for r in feats.join(labels, "doc_id").collect() if r.doc_id % 5]
    x, y = np.array([r.features for r in rows], float), np.array([r.label for r in rows], float)
    sd = x.std(0)
    assert np.allclose(model.mean, x.mean(0)) and np.allclose(model.scale, np.where(sd > 1e-6, sd, 1))
    z = np.c_[np.cos((x - x.mean(0)) / model.scale @ model.weights + model.phases) * np.sqrt(2 / q.FEATURES), np.ones(len(x))]
    penalty = np.sqrt(np.r_[np.full(q.FEATURES, q.RIDGE * len(x)), 1e-9])
    beta = np.linalg.lstsq(np.r_[z, np.diag(penalty)], np.r_[y, np.zeros(len(penalty))], rcond=None)[0]
    assert np.allclose(z @ beta, model.raw(x), atol=1e-5)


def test_isotonic_against_its_definition():
    rng = np.random.RandomState(2)
    for _ in range(30):
        n = rng.randint(1, 5, 12).astype(float)
        y = np.array([rng.binomial(int(k), 0.5) for k in n], float)
        x, v = isotonic(np.arange(12.0), n, y)
        mean = lambda a, b: y[a:b].sum() / n[a:b].sum()
        want = [max(min(mean(a, b) for b in range(i + 1, 13)) for a in range(i + 1)) for i in range(12)]
        assert np.allclose(sorted(set(np.round(v, 9))), sorted(set(np.round(want, 9))))


def test_very_long_text_and_clashing_names(spark):
    df = spark.createDataFrame([(1, "word and more, " * 300_000, 3, "l")], "doc_id long, text string, features int, label string")
    assert len(features(df).collect()[0].features) == len(statistics(b"", WordHashes()))
