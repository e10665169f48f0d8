from collections import defaultdict

import pytest

from landgrid.llm.mixing import mix, mix_sizes, op2_mixing, sized, targets, written


def brute_targets(sizes, weights=(3, 1, 2), share=1.5, most=2.0):
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    w = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    left, open_, out = share * sum(sizes.values()), set(names), {}
    while open_:
        total = sum(w[s] for s in open_)
        over = {s for s in open_ if left * w[s] / total > most * sizes[s]}
        if not over:
            return out | {s: left * w[s] / total for s in open_}
        for s in over:
            out[s] = most * sizes[s]
            left -= out[s]
        open_ -= over
    return out


CASES = [
    {"a": 10, "b": 1000, "c": 5, "d": 70, None: 3},
    {"a": 0, "b": 0},
    {None: 7},
    {"é": 100, "z": 100, "Z": 1, "": 50},
    {f"s{i}": i * i for i in range(25)},
]


@pytest.mark.parametrize("sizes", CASES)
def test_targets(spark, sizes):
    df = spark.createDataFrame([(0, s, n, 0) for s, n in sizes.items()], "doc_id long, source string, size long, key long")
    got = {r.source: r.target for r in targets(df).collect()}
    want = brute_targets(sizes)
    assert got.keys() == want.keys()
    for s in want:
        assert got[s] == pytest.approx(want[s], abs=1e-6)


def check(rows):
    by = defaultdict(list)
    for r in rows:
        by[r.target, r.source_size].append(r)
        if r.size:
            assert r.taken % r.size == 0
            mean = r.target / r.source_size
            assert int(mean + 1e-9) <= r.taken // r.size <= int(mean - 1e-9) + 1 <= 2
        else:
            assert r.taken == 0
    for (target, size), held in by.items():
        if sum(r.size for r in held) == size:
            assert abs(sum(r.taken for r in held) - target) <= max(r.size for r in held)


def test_query(spark):
    rows = op2_mixing(spark, "/root/testdata/sf0.01").collect()
    assert len(rows) == 1000
    check(rows)
    assert sorted(rows) == sorted(op2_mixing(spark, "/root/testdata/sf0.01").repartition(3).collect())


def test_levels_nulls_ties(spark):
    docs = [(i, "w " * (i % 50), "hot" if i % 3 else None) for i in range(3000)] + [(7, "one two", "hot")] * 5 + [(None, None, "x"), (None, "a", "")]
    sizes = written(sized(spark.createDataFrame(docs, "doc_id long, text string, source string")), "t")
    from pyspark.sql import functions as F

    got = [mix_sizes(sizes, group=g).withColumn("taken", F.col("copies") * F.col("size")).collect() for g in (8, 256)]
    for rows in got:
        assert len(rows) == len(docs)
        check(rows)


def test_unbiased(spark):
    """Over many documents of one size the share of extra copies is the fractional rest."""
    docs = [(i, "w w w w", "a") for i in range(4000)] + [(i + 9000, "w w w w", "b") for i in range(4000)]
    rows = mix_sizes(sized(spark.createDataFrame(docs, "doc_id long, text string, source string"))).collect()
    for source in "ab":
        own = [r for r in rows if r.source == source]
        assert abs(sum(r.copies * r.size for r in own) - own[0].target) <= 4
        first = sum(r.copies for r in own if r.doc_id % 9000 < 2000) / 2000
        assert abs(first - own[0].target / own[0].source_size) < 0.06


def test_mix_repeats_rows(spark):
    docs = [(i, "w " * (1 + i % 7), "ab"[i % 2], i) for i in range(200)] + [(5, "w " * 6, "b", 77)]
    df = spark.createDataFrame(docs, "doc_id long, text string, source string, copies int")
    out = mix(df)
    assert out.columns == df.columns
    words = defaultdict(int)
    for r in out.collect():
        words[r.source] += len(r.text.split())
    goal = {r.source: r.target for r in targets(sized(df)).collect()}
    for s, t in goal.items():
        assert abs(words[s] - t) <= 14


def test_empty(spark):
    df = spark.createDataFrame([], "doc_id long, text string, source string")
    assert mix_sizes(sized(df)).collect() == [] and mix(df).collect() == []


def test_hot_repeats_clashing_names_and_a_very_long_text(spark):
    docs = [(1, "w w w", "hot", 5, "k")] * 2000 + [(None, "a b", None, 6, "n")] * 500 + [(i, "one two three four", "cold", i, "c") for i in range(50, 150)] + [(9, "w " * 200_000, "long", 1, "x")]
    df = spark.createDataFrame(docs, "doc_id long, text string, source string, _key int, total string").repartition(7)
    rows = mix_sizes(sized(df), group=16).collect()
    assert len(rows) == len(docs)
    for s in ("hot", "cold", "long", None):
        own = [r for r in rows if r.source == s]
        assert abs(sum(r.copies * r.size for r in own) - own[0].target) <= own[0].size
        assert max(r.copies for r in own) <= 2 and (s != "hot" or max(r.copies for r in own) - min(r.copies for r in own) <= 1)
    out = mix(df)
    assert out.columns == df.columns and {tuple(r) for r in out.collect()} <= set(docs)
    totals = defaultdict(int)
    for r in out.collect():
        totals[r.source] += 1
    want = defaultdict(int)
    for r in mix_sizes(sized(df)).collect():
        want[r.source] += r.copies
    assert {k: v for k, v in totals.items()} == {k: v for k, v in want.items() if v}
