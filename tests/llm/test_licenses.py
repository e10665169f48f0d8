import re

from landgrid.llm.license_rules import BASE, GATE, RULES, regex
from landgrid.llm.licenses import op3_licenses, oracle, scan


def brute(text):
    """Lower case, words, base places and kept detections in plain Python."""
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower)
    base = [(i, label) for label, phrase in BASE for i in range(len(words)) if words[i : i + len(phrase.split())] == phrase.split()]
    found = []
    if re.search(GATE, lower):
        norm = "".join(f" {w} " for w in words)
        for k, r in enumerate(RULES):
            if r.keyword in norm:
                for m in re.finditer(regex(r.pattern), norm):
                    s, e = (norm[:x].count(" ") // 2 for x in m.span())
                    found.append((s, e, r.level, k, r.label, r.score))
    keep = [
        d for d in found
        if not any(o[0] <= d[0] and o[1] >= d[1] and o[2] >= d[2] and (o[0] < d[0] or o[1] > d[1] or o[2] > d[2] or o[3] < d[3]) for o in found)
    ]
    labels = {d[4] for d in keep} | {b[1] for b in base}
    starts = [b[0] for b in base]
    return (
        len(words), len(base), min(starts, default=None), max(starts, default=None), ",".join(sorted({b[1] for b in base})), ",".join(sorted(labels)),
        max((d[5] for d in keep), default=0.0),
    )


TEXTS = [
    None, "", " \n ", "MIT License", "mit license mit license MIT-LICENSE x", "The Mit. License? CC-BY-NC-SA 4.0 cc by", "é MIT\x00license É",
    "gnu general public license version 3 or later, GNU GENERAL PUBLIC LICENSE", "licensed under the Apache License, Version 2.0. " * 40,
    "accby cc  by", "xmit license", "mit licenses", "K cc by K", "Copyright (c) 2020 Foo. All rights reserved. Released under the MIT License.",
    "GPLv3 and LGPL 2.1 and spdx-license-identifier: GPL-3.0-or-later", "word " * 30000 + "apache license", "CC0 1.0 creative commons attribution sharealike 3.0 unported license",
]


def test_rules():
    assert 200 < len(RULES) < 400 and len({(r.label, r.pattern) for r in RULES}) == len(RULES)
    for r in RULES:
        example = re.sub(r"\s+", " ", re.sub(r"\(([^)|]*)[^)]*\)", r"\1", re.sub(r"\[[^\]]*\]|~\d", "", r.pattern)).replace("#", "7").replace("*", "any")).strip()
        assert any(d for d in [re.search(regex(r.pattern), "".join(f" {w} " for w in example.split()))]), r
        assert re.search(GATE, example) and r.keyword in example, r


def test_against_brute_force(spark):
    rows = [(i, t, "old") for i, t in enumerate(TEXTS)] + [(3, "MIT License", "old")]
    df = spark.createDataFrame(rows, "doc_id long, text string, labels string")
    got = sorted(tuple(r) for r in scan(df).collect())
    want = sorted((i, *brute(t)) for i, t, _ in rows)
    for g, w in zip(got, want, strict=True):
        assert g == w
    assert scan(df.limit(0)).collect() == []


def test_oracle_agrees(spark):
    import duckdb

    sf = "/root/testdata/sf0.001"
    con = duckdb.connect()
    con.sql(f"create view documents as select * from '{sf}/documents.parquet'")
    want = sorted(con.sql(oracle()).fetchall())
    got = sorted(tuple(r) for r in op3_licenses(spark, sf).collect())
    assert got == want
    texts = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()
    assert got == sorted((r.doc_id, *brute(r.text)) for r in texts)
