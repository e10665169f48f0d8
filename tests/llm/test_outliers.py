from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from landgrid.llm.outliers import CUTOFF, LEAST, counted, estimated, keep_passing
from landgrid.llm.outliers import judged as judge


def judged(stats):
    return judge(stats, *estimated(stats))


def brute_counts(text):
    words = [w for w in __import__("re").findall(r"[^\x20\x09-\x0D]+", text or "")]
    lines = [x for x in (text or "").split("\n") if __import__("re").search(r"[^\x20\x09-\x0D]", x)]
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    often = Counter(windows)
    covered = {i + k for i, w in enumerate(windows) if often[w] > 1 for k in range(3)}
    n = len(words)
    return n, sum(map(len, words)), sum(c in "#*$%&|<>" for c in text or ""), len(lines) - len(set(lines)), len(covered), n < 50 or 100 * len(covered) > 50 * n


TEXTS = [None, "", "a", "a b", "a b c a b c", "x\n x\nx\n\n \nx", "a a a a", "É é ## | <b>  y", "w1 w2 w3 w4 " * 40, " ".join(f"w{i}" for i in range(60)), " ".join(f"w{i % 97}" for i in range(20000))]


def test_counts(spark):
    df = spark.createDataFrame([(i, t, "en", None, 1) for i, t in enumerate(TEXTS)], "doc_id long, text string, lang string, source string, n_words int")
    got = {r.doc_id: (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) for r in counted(df).collect()}
    for i, t in enumerate(TEXTS):
        assert got[i] == brute_counts(t), i


def rows_of(n, seed, bad):
    rng = np.random.RandomState(seed)
    for i in range(n):
        m = int(np.exp(rng.normal(5.5, 0.7))) + 60
        words = ["".join(rng.choice(list("abcdefghij"), rng.randint(2, 9))) for _ in range(m)]
        yield " ".join(f"{w}***" for w in words) if i in bad else " ".join(words)


def test_outliers_go_and_clean_rows_stay(spark):
    rows = []
    for g, (lang, source, n) in enumerate([("en", "a", 200), ("en", "b", 60), ("de", None, 15), ("fr", "c", 15), (None, "d", 14)]):
        bad = {0, 1} if n < 50 else set(range(0, n, 4))
        rows += [(1000 * g + i, t, lang, source, i in bad) for i, t in enumerate(rows_of(n, g, bad))]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, bad boolean")
    for r in judged(counted(df)).collect():
        assert r.kept == (not r.bad), r
    kept = keep_passing(df.withColumn("n_words", F.lit("clash")))
    assert kept.columns == [*df.columns, "n_words"] and sorted(r.doc_id for r in kept.collect()) == sorted(r[0] for r in rows if not r[4])
    again = sorted((r.doc_id, r.distance) for r in judged(counted(df.repartition(7))).collect())
    assert again == sorted((r.doc_id, r.distance) for r in judged(counted(df)).collect())


def test_distance_is_that_of_the_least_determinant(spark):
    """numpy's version of the same estimate, from either start, on one group."""
    from landgrid.llm.outliers import BINS_AN_OCTAVE, CONSISTENCY, CORE, FLOORS, SCALE, STEPS

    rows = [(i, t, "en", "a") for i, t in enumerate(rows_of(150, 9, set(range(0, 150, 5))))]
    got = {r.doc_id: r.distance for r in judged(counted(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string"))).collect()}
    ids, x = [], []
    for i, t, *_ in rows:
        n, chars, sym, dup, rep, failed = brute_counts(t)
        if not failed:
            ids.append(i)
            x.append([np.log1p(n), np.log(chars / n), np.log1p(100 * sym / n), np.log1p(100 * dup / 1), rep / n])
    x = np.floor(np.array(x) * SCALE + 0.5) / SCALE
    floors = np.diag(np.square(FLOORS))
    at = lambda q: np.sort(x, 0)[int(np.ceil(q * len(x))) - 1]
    fits = [(x.mean(0), np.cov(x.T, bias=True) + floors), (at(0.5), np.diag(((at(0.75) - at(0.25)) / 1.349) ** 2) + floors)]
    best = None
    for m, c in fits:
        for _ in range(STEPS):
            d = np.einsum("ij,jk,ik->i", x - m, np.linalg.inv(c), x - m)
            bins = np.floor(np.log2(1 + d) * BINS_AN_OCTAVE)
            limit = np.sort(bins)[int(np.ceil(CORE * len(x))) - 1]
            own = x[bins <= limit]
            m, c = own.mean(0), np.cov(own.T, bias=True) * CONSISTENCY + floors
        if best is None or np.linalg.det(c) < best[0] - 1e-12:
            best = np.linalg.det(c), m, c
    d = np.einsum("ij,jk,ik->i", x - best[1], np.linalg.inv(best[2]), x - best[1])
    for i, v in zip(ids, d):
        assert abs(got[i] - v) < 1e-6 * max(1, v)
    assert LEAST <= len(ids) and max(d) > CUTOFF


def test_few_or_no_rows(spark):
    schema = "doc_id long, text string, lang string, source string"
    few = spark.createDataFrame([(1, " ".join(f"w{i}" for i in range(60)), "en", "a"), (2, None, None, None)], schema)
    assert {r.doc_id: r.kept for r in judged(counted(few)).collect()} == {1: True, 2: False}
    assert judged(counted(few.limit(0))).collect() == []
