import numpy as np

from landgrid.llm.toxicity import Features, Model, fit, op6_toxicity, scores, train


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.1"
    rows = op6_toxicity(spark, sf).collect()
    assert len(rows) == spark.read.parquet(f"{sf}/documents.parquet").count()
    by = {r.doc_id: r for r in rows}
    held = [(by[r.doc_id], r.toxic) for r in spark.read.parquet(f"{sf}/labels.parquet").collect() if by[r.doc_id].held_out]
    toxic = [r.predicted for r, y in held if y]
    clean = [r.predicted for r, y in held if not y]
    assert np.mean(toxic) > 0.9 and np.mean(clean) < 0.05
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in rows)


def test_risk_is_corrected_by_the_prior():
    """Unlabelled rows hold positives; the model must still call them positive."""
    rng = np.random.RandomState(0)
    words = lambda k: {int(x) for x in rng.randint(100, 400, k)}
    positive = [np.array(sorted(words(20) | {7}), np.int32) for _ in range(300)]
    mixed = [np.array(sorted(words(20) | ({7} if i % 5 == 0 else set())), np.int32) for i in range(1500)]
    model = train(positive, mixed, 0.2)
    s = model.score(mixed)
    truth = np.arange(1500) % 5 == 0
    assert (s[truth] > 0.5).mean() > 0.95 and (s[~truth] > 0.5).mean() < 0.05


def test_edges(spark):
    docs = spark.createDataFrame([(1, None, 1), (2, "", 1), (3, "bad bad", 1), (3, "bad bad", 1), (None, "fine", 1)], "doc_id long, text string, label int")
    none = fit(docs, spark.createDataFrame([], "doc_id long, label int"))
    assert none.weights is None and {r.score for r in scores(docs, none).collect()} == {0.0}
    one = fit(docs, spark.createDataFrame([(3, 1), (1, 0), (77, 1), (2, None)], "doc_id long, label int"))
    out = scores(docs, one).collect()
    assert len(out) == 5 and all(0 <= r.score <= 1 for r in out)
    assert scores(docs.limit(0), one).collect() == []
    assert Model().score([Features()("x")]).tolist() == [0.0]


def risk(model, positive, unlabelled, prior):
    """The corrected risk, as the paper writes it, with both classes brought to equal weight."""
    loss = lambda z: np.log1p(np.exp(-z))
    zp, zu = model.margin(positive), model.margin(unlabelled)
    return 0.5 * loss(zp).mean() + 0.5 / (1 - prior) * max(0.0, loss(-zu).mean() - prior * loss(-zp).mean())


def test_training_lowers_the_corrected_risk():
    rng = np.random.RandomState(3)
    words = lambda k: {int(x) for x in rng.randint(100, 300, k)}
    positive = [np.array(sorted(words(15) | ({7} if rng.rand() < 0.8 else {8})), np.int32) for _ in range(200)]
    unlabelled = [np.array(sorted(words(15) | ({7} if i % 4 == 0 else {9})), np.int32) for i in range(1000)]
    model = train(positive, unlabelled, 0.25)
    zero = Model(np.zeros_like(model.weights), 0.0)
    best = risk(model, positive, unlabelled, 0.25)
    assert best < 0.5 * risk(zero, positive, unlabelled, 0.25)
    for feature, step in ((7, -1.0), (9, 1.0)):
        worse = Model(model.weights.copy(), model.bias)
        worse.weights[feature] += step
        assert risk(worse, positive, unlabelled, 0.25) > best - 1e-3


def test_counts_choose_the_same_features_as_numpy(spark):
    from landgrid.llm.toxicity import _telling, telling

    rng = np.random.RandomState(1)
    rows = [(bool(i % 3 == 0), bool(i % 3 or i % 2), np.array(sorted({int(x) for x in rng.randint(0, 50, 8)} | ({60} if i % 3 == 0 else {61})), np.int32).tobytes()) for i in range(400)]
    df = spark.createDataFrame(rows, "positive boolean, unlabelled boolean, ids binary").repartition(5)
    sets = [[np.frombuffer(r[2], np.int32) for r in rows if r[k]] for k in (0, 1)]
    got = {r.feature for r in _telling(df, len(sets[0]), len(sets[1])).collect()}
    assert got == set(np.flatnonzero(telling(*sets)).tolist()) and 60 in got


def test_very_long_text(spark):
    df = spark.createDataFrame([(1, "bad words " * 200_000), (2, "good")], "doc_id long, text string")
    model = fit(df, spark.createDataFrame([(1, 1), (2, 0)], "doc_id long, label int"))
    assert scores(df, model).count() == 2
