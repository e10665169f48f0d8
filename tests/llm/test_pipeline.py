from collections import Counter, defaultdict

import corpus_pipeline
from landgrid.llm.common import release, table, written
from tests.llm.test_mixing import brute_targets
from tests.llm.test_ngram_join import brute
from tests.llm.test_outliers import brute_counts
from tests.llm.test_packing import check as check_packing

SF = "/root/testdata/sf0.01"


def test_stages_one_by_one(spark):
    docs = table(spark, SF, "documents")
    columns = docs.columns
    kept, rows = [docs], [docs.collect()]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = written(stage(spark, kept[-1], SF), "test")
        assert out.columns == columns, name
        kept.append(out)
        rows.append(out.collect())
        assert not Counter(set(rows[-1])) - Counter(set(rows[-2]))
    quality = {r.doc_id: r.quality for r in table(spark, SF, "labels").collect()}
    left = {r.doc_id for r in rows[1]}
    good, bad = [d for d, q in quality.items() if q], [d for d, q in quality.items() if not q]
    assert sum(d in left for d in good) > 0.97 * len(good) and sum(d in left for d in bad) < 0.15 * len(bad)
    passing = {r.doc_id for r in rows[1] if not brute_counts(r.text)[-1]}
    assert {r.doc_id for r in rows[2]} <= passing and len(rows[2]) > 0.97 * len(passing)
    want = {d for d, _, c in brute([(r.doc_id, r.text) for r in rows[2]], 5, 80) if d == c}
    assert sorted(r.doc_id for r in rows[3]) == sorted(want)
    size, taken = defaultdict(int), defaultdict(int)
    for r in rows[3]:
        size[r.source] += len(r.text.split())
    for r in rows[4]:
        taken[r.source] += len(r.text.split())
    most = max(len(r.text.split()) for r in rows[3])
    assert all(abs(taken[s] - t) <= most for s, t in brute_targets(size).items())
    check_packing(corpus_pipeline.STAGES[-1][1](spark, kept[-1], SF).collect(), [(r.doc_id, r.text) for r in rows[4]], 4096)


def test_run_is_repeatable_and_releases(spark):
    a = sorted(corpus_pipeline.run(spark, "/root/testdata/sf0.001").collect())
    assert a and a == sorted(corpus_pipeline.run(spark, "/root/testdata/sf0.001").collect())
    assert release(spark) > 0


def test_edges(spark, tmp_path):
    """Nulls in every column, empty and very long texts, repeated ids and rows, columns with the operators' own names."""
    from pyspark.sql import functions as F

    docs = table(spark, "/root/testdata/sf0.001", "documents")
    extra = ["_row", "node", "key", "total", "features", "label", "_gone", "size", "row", "id"]
    wide = docs.select("*", *[F.when(F.lit(True), i).alias(c) for i, c in enumerate(extra)])
    good = docs.where("n_chars between 800 and 4000").orderBy("doc_id").limit(2).collect()
    tail = list(range(len(extra)))
    odd = [
        (None, None, None, None, None, *[None] * len(extra)),
        (None, good[0].text + " and a last line of words of its own", "en", None, 1, *tail),
        (10**9, "", "en", "web", 0, *tail),
        (10**9 + 1, good[0].text.replace(" ", "  "), None, None, 1, *tail),
        (10**9 + 2, good[1].text, "en", "web", 1, *tail),
        (10**9 + 2, " ".join(f"word{i} {'of the' if i % 3 else 'and'}" for i in range(60_000)), "en", "web", 1, *tail),
        (10**9 + 3, None, "en", "web", None, *tail),
        *[(10**9 + 4, good[0].text, "en", "web", 1, *tail)] * 3,
    ]
    all_ = wide.unionByName(spark.createDataFrame(odd, ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in wide.schema)))
    for name, df in (("odd", all_), ("none", all_.limit(0))):
        root = str(tmp_path / name)
        df.repartition(3).write.parquet(f"{root}/documents.parquet")
        table(spark, "/root/testdata/sf0.001", "labels").write.parquet(f"{root}/labels.parquet")
        kept = table(spark, root, "documents")
        for stage_name, stage in corpus_pipeline.STAGES[:-1]:
            kept = written(stage(spark, kept, root), "edge")
            assert kept.columns == wide.columns, stage_name
            if stage_name == "n-gram Jaccard join":
                rows = [(r.doc_id, r.text) for r in kept.collect()]
                assert len([r for r in rows if r[0] == 10**9 + 4]) <= 1 and (None, None) not in rows and (10**9, "") not in rows
        out = corpus_pipeline.STAGES[-1][1](spark, kept, root)
        assert (out.count() > 0) == (name == "odd")
