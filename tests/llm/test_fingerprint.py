import hashlib
from collections import Counter

import numpy as np

from landgrid.llm.fingerprint import Fingerprinter, Sampler, as_text, edited_fingerprints, fingerprints, likeness


def test_collision_rate_is_generalised_jaccard():
    rng = np.random.RandomState(5)
    sampler = Sampler(4096, 3)
    for _ in range(4):
        terms = np.unique(rng.randint(0, 2**63, 60).astype(np.uint64))
        a, b = rng.randint(0, 6, len(terms)), rng.randint(0, 6, len(terms))
        want = np.minimum(a, b).sum() / np.maximum(a, b).sum()
        got = likeness(sampler(terms[a > 0], a[a > 0]), sampler(terms[b > 0], b[b > 0]))
        assert abs(got - want) < 4 * np.sqrt(want * (1 - want) / 4096) + 0.005


def brute(rows):
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or ""))
    make, out = Fingerprinter(), []
    for i, (doc_id, text) in enumerate(rows):
        text, following = text or "", rows[(i + 1) % len(rows)][1] or ""
        cut = len(text) // 2
        edited = text[: len(text) - cut] + following[:cut]
        f, e, n = make(text.encode()), make(edited.encode()), make(following.encode())
        out.append((doc_id, len(text), hashlib.sha256(edited.encode()).hexdigest(), as_text(f), as_text(e), likeness(f, e), likeness(f, n)))
    return Counter(out)


ROWS = [(5, "é one two three four five six seven"), (1, None), (2, ""), (9, "one"), (9, "one"), (9, "zwei"), (7, "word " * 5000), (None, "no id here"), (12, "\n \t"), (3, "a b c d e f g h" * 9)]


def test_edited_against_brute_force(spark):
    df = spark.createDataFrame([(i, t, "x") for i, t in ROWS], "doc_id long, text string, n_chars string")
    for bucket_bytes in (1 << 20, 300, 40):
        got = Counter(tuple(r) for r in edited_fingerprints(df, bucket_bytes=bucket_bytes).collect())
        assert got == brute(ROWS), bucket_bytes


def test_one_row_and_none(spark):
    one = spark.createDataFrame([(4, "a b c d")], "doc_id long, text string")
    assert Counter(tuple(r) for r in edited_fingerprints(one).collect()) == brute([(4, "a b c d")])
    assert edited_fingerprints(one.limit(0)).collect() == []


def test_equal_texts_equal_fingerprints(spark):
    df = spark.createDataFrame([(1, "a b"), (2, "A  b\n"), (3, None), (4, " "), (5, "a b c d e f")], "doc_id long, text string")
    f = {r.doc_id: r.fingerprint for r in fingerprints(df).collect()}
    assert f[1] == f[2] != f[5] and f[3] == f[4] == ""


def test_query_on_table(spark):
    from landgrid.llm.fingerprint import op10_fingerprint

    sf = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    assert Counter(tuple(r) for r in op10_fingerprint(spark, sf).collect()) == brute(rows)


def test_one_id_for_all_rows_is_split_by_text(spark):
    rows = [(None, f"{i % 50} " * 30) for i in range(200)] + [(3, "z " * 40_000)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert Counter(tuple(r) for r in edited_fingerprints(df, bucket_bytes=600).collect()) == brute(rows)


def test_fingerprint_against_exact_jaccard():
    """Of whole texts: the estimate against weighted shingles counted in Python."""
    import random

    rng = random.Random(6)
    make = Fingerprinter(4096)
    for _ in range(6):
        a = [rng.choice("abcdefgh") + rng.choice("xyz") for _ in range(300)]
        b = list(a)
        for _ in range(rng.randint(0, 40)):
            b[rng.randrange(300)] = "new"
        ca, cb = (Counter(tuple(x[i : i + 5]) for i in range(296)) for x in (a, b))
        want = sum((ca & cb).values()) / sum((ca | cb).values())
        got = likeness(make(" ".join(a).encode()), make(" ".join(b).encode()))
        assert abs(got - want) < 0.05
