import random

import numpy as np
import pytest

from landgrid.llm.ngram_join import Scheme, Unit, join_ngrams, keys, mixed, op8_ngram_join, sketch, spanning


def brute(docs, n, percent):
    """(doc_id, size, component) by all pairs of whole sets."""
    sets = []
    for _, t in docs:
        lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "")
        w = [x for x in __import__("re").split(r"[\x20\x09-\x0D]+", lower) if x]
        sets.append({tuple(w[i : i + n]) for i in range(len(w) - n + 1)} if len(w) >= n else {tuple(w)} if w else set())
    up = list(range(len(docs)))

    def root(i):
        while up[i] != i:
            i = up[i]
        return i

    for i in range(len(docs)):
        for j in range(i):
            if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j]):
                up[root(i)] = root(j)
    least = {}
    for i, (d, _) in enumerate(docs):
        if d is not None:
            least[root(i)] = min(d, least.get(root(i), d))
    return sorted(((d, len(sets[i]), least.get(root(i))) for i, (d, _) in enumerate(docs)), key=str)


def corpus(seed, groups, sizes, edits):
    rng = random.Random(seed)
    docs, vocabulary = [], [f"w{i}" for i in range(400)]
    for _ in range(groups):
        base = [rng.choice(vocabulary) for _ in range(rng.choice(sizes))]
        for _ in range(rng.choice((1, 2, 3, 12))):
            own = list(base)
            for _ in range(rng.randint(0, max(1, int(edits * len(base))))):
                at = rng.randrange(len(own))
                kind = rng.random()
                if kind < 0.4:
                    own[at] = rng.choice(vocabulary)
                elif kind < 0.7:
                    own.insert(at, rng.choice(vocabulary))
                elif len(own) > 1:
                    del own[at]
            docs.append((len(docs), " ".join(w.upper() if rng.random() < 0.2 else w for w in own)))
    rng.shuffle(docs)
    return docs


@pytest.mark.parametrize("n,percent,unit,sizes,edits", [(3, 90, 512, (1, 2, 5, 11, 12, 20, 40, 90, 300), 0.06), (5, 80, 4, (4, 6, 9, 14, 25, 60, 200), 0.08), (1, 80, 512, (5, 8, 15, 30), 0.3), (2, 60, 6, (3, 6, 10, 30), 0.3)])
def test_against_brute_force(spark, n, percent, unit, sizes, edits):
    docs = corpus(n * percent, 60, sizes, edits)
    docs += [(9001, None), (9002, ""), (9003, " \n"), (9004, "one"), (9005, "ONE"), (9004, "one"), (None, "null id text one two three four five six"), (9006, "null id text one two three four five six"), (None, None)]
    df = spark.createDataFrame([(d, t, 1) for d, t in docs], "doc_id long, text string, node int")
    got = sorted((tuple(r) for r in join_ngrams(df, Scheme(n, percent), unit).collect()), key=str)
    assert got == brute(docs, n, percent)


@pytest.mark.parametrize("scheme", [Scheme(3, 90), Scheme(5, 80), Scheme(1, 60)])
def test_every_qualifying_pair_shares_a_key(scheme):
    rng = np.random.RandomState(3)
    for _ in range(400):
        size = int(np.exp(rng.uniform(0.7, 6.5))) + 1
        a = np.unique(mixed(rng.randint(0, 2**62, size).astype(np.uint64)))
        most = scheme.differ(2 * len(a))
        gone = rng.randint(0, most + 1)
        b = np.unique(np.r_[a[gone // 2 :], mixed(rng.randint(0, 2**62, gone - gone // 2).astype(np.uint64))])
        both = len(np.intersect1d(a, b))
        if len(b) and 100 * both >= scheme.percent * (len(a) + len(b) - both) and both < max(len(a), len(b)):
            assert len(np.intersect1d(keys(a, scheme), keys(b, scheme))), (len(a), len(b), both)


def test_bound_holds_for_all_small_sizes():
    for percent in (60, 80, 90):
        s = Scheme(3, percent)
        for x in range(1, 60):
            for y in range(x, 60):
                least = next((i for i in range(x + 1) if 100 * i >= percent * (x + y - i)), None)
                if least is not None and x + y - 2 * least:
                    common = set(s.bands(x)) & set(s.bands(y))
                    assert common and all(s.segments(b)[0] >= x + y - 2 * least for b in common), (x, y)


def test_spanning():
    scheme = Scheme(1, 80)
    sets = [np.unique(mixed(np.arange(k, k + 100).astype(np.uint64))) for k in (0, 3, 5, 5000)]
    unit = Unit(scheme, np.arange(4), np.full(4, 100), [sketch(s, 1024) for s in sets], np.zeros(4, int))
    assert sorted(tuple(sorted(e)) for e in spanning(unit)) == [(0, 1), (1, 2)]


@pytest.mark.parametrize("edits,unit", [(9, 2048), (6, 64), (3, 16)])
def test_large_group_at_the_threshold(spark, monkeypatch, edits, unit):
    """Copies of one text, about as far from each other as the threshold: by chunks, by salt, by pieces and at once."""
    import landgrid.llm.ngram_join as module

    rng = random.Random(edits)
    base = [f"w{rng.randrange(5000)}" for _ in range(300)]
    docs = []
    for i in range(300):
        own = list(base)
        for _ in range(rng.randint(0, edits)):
            own[rng.randrange(300)] = f"x{rng.randrange(10**9)}"
        docs.append((i, " ".join(own)))
    docs += [(1000 + i, t) for i, t in corpus(edits, 20, (20, 60), 0.08)]
    if unit < 2048:
        for name, value in (("SAMPLE", 200), ("OFTEN", 10), ("MEET", 40)):
            monkeypatch.setattr(module, name, value)
    df = spark.createDataFrame(docs, "doc_id long, text string")
    got = sorted((tuple(r) for r in join_ngrams(df, Scheme(5, 80), unit).collect()), key=str)
    assert got == brute(docs, 5, 80)


def test_none(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert join_ngrams(df).collect() == []


def test_query(spark):
    sf = "/root/testdata/sf0.001"
    docs = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    assert sorted((tuple(r) for r in op8_ngram_join(spark, sf).collect()), key=str) == brute(docs, 3, 90)


def test_keep_one_where_ids_repeat(spark):
    from landgrid.llm.ngram_join import keep_one

    a, b, c, d = (" ".join(f"{x}{i}" for i in range(40)) for x in "abcé")
    rows = [(1, a), (2, a), (2, b), (3, c), (3, d), (3, d), (4, d), (5, b), (6, "x"), (6, "y"), (6, "y"), (None, a)]
    out = keep_one(spark.createDataFrame(rows, "doc_id long, text string"), Scheme(5, 80)).collect()
    want = [(1, a), (2, b), (3, c), (3, d), (6, "x"), (6, "y"), (None, a)]
    assert sorted(map(tuple, out), key=str) == sorted(want, key=str)


def test_very_long_text(spark):
    text = " ".join(f"w{i}" for i in range(150_000))
    df = spark.createDataFrame([(5, text), (3, text + " end"), (9, text[: len(text) // 2]), (7, "short text")], "doc_id long, text string")
    got = {r.doc_id: r.component_id for r in join_ngrams(df, Scheme(5, 80)).collect()}
    assert got == {5: 3, 3: 3, 9: 9, 7: 7}
