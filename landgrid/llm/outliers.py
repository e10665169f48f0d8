"""Quality rules: text statistics, and robust multivariate outliers.

Counts over each whole text give a base rule. Of the texts that pass it, a vector
of transformed statistics is compared with the minimum-covariance-determinant
estimate of its language and source: from two starts (mean and covariance of all;
medians and quartile ranges) concentration steps refit on the share ``CORE`` of
texts that lie nearest, and the fit of least determinant is kept. A text goes
when its squared Mahalanobis distance exceeds ``CUTOFF``.

A step is one pass over the (small) vectors: moments are summed by bin of distance
in each group, so a source with a third of all rows is added up in every task, and
the bins' running sums give the core's moments without ranking any row. Vectors
are whole multiples of 1/SCALE, so sums are exact and reruns agree.

DataFrame functions only. Defined results: null text counts as empty and fails the
base rule; null language or source is a value of its own; groups of fewer than
``LEAST`` texts are judged with the rest of their language, then with the rest of
all; where even that is smaller, only the base rule decides. Statistics that are
equal in all texts of a group don't make the fit degenerate: ``FLOORS`` are the
least standard deviations that a verdict may rest on. Repeated rows get equal
results.
"""

from __future__ import annotations

from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from landgrid.llm.common import WORD, table, written
from landgrid.llm.licenses import let

SYMBOLS = r"[#*$%&|<>]"
MIN_WORDS, MAX_REPEATED_PERCENT = 50, 50
#: log words, log word length, log share of symbols, log share of repeated lines, share of repeated words.
VECTOR = ("x1", "x2", "x3", "x4", "x5")
FLOORS = (0.5, 0.06, 0.4, 1.0, 0.1)
SCALE = 1024
CORE = 0.75
#: CORE / P(chi2_7 <= q), where P(chi2_5 <= q) = CORE: makes the core's covariance that of all normal rows.
CONSISTENCY = 1.41207
#: The chi-square quantile with 5 degrees of freedom at 1 - 1e-8.
CUTOFF = 45.795
STEPS = 4
LEAST = 40
BINS_AN_OCTAVE = 32
D = len(VECTOR)
PAIRS = [(i, j) for i in range(D) for j in range(i + 1)]


def repeated_words(words: Column) -> Column:
    """Words in windows of three that occur twice or more, by sorted window hashes."""
    windows = F.transform(F.sequence(F.lit(0), F.size(words) - 3), lambda i: F.xxhash64(F.get(words, i), F.get(words, i + 1), F.get(words, i + 2)))

    def covered(keys: Column) -> Column:
        def count(s: Column) -> Column:
            again = F.filter(s, lambda x, j: (x["k"] == F.coalesce(F.get(s, j - 1)["k"], F.bitwise_not(x["k"]))) | (x["k"] == F.coalesce(F.get(s, j + 1)["k"], F.bitwise_not(x["k"]))))
            return F.size(F.array_distinct(F.flatten(F.transform(again, lambda x: F.array(x["i"], x["i"] + 1, x["i"] + 2)))))

        placed = F.sort_array(F.transform(keys, lambda k, i: F.struct(k.alias("k"), i.alias("i"))))
        return F.when(F.size(F.array_distinct(keys)) == F.size(keys), F.lit(0)).otherwise(let(placed, count))

    return F.when(F.size(words) < 3, F.lit(0)).otherwise(let(windows, covered))


COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines"]


def counts(text_col: str = "text") -> Column:
    """A struct of the counts of a text."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike(WORD))

    def of(words: Column) -> Column:
        return let(
            lines,
            lambda own: F.struct(
                F.size(words).alias("n_words"),
                F.char_length(F.array_join(words, "")).alias("word_chars"),
                (F.char_length(text) - F.char_length(F.regexp_replace(text, SYMBOLS, ""))).alias("n_symbols"),
                (F.size(own) - F.size(F.array_distinct(own))).alias("n_dup_lines"),
                repeated_words(words).alias("n_repeat_words"),
                F.size(own).alias("n_lines"),
            ),
        )

    return let(F.regexp_extract_all(text, F.lit(WORD), F.lit(0)), of)


def counted(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """docs without the text, with the counts and base_failed."""
    rest = [c for c in docs.columns if c != text_col and c not in (*COUNTS, "base_failed")]
    rows = docs.select(*rest, counts(text_col).alias("_s")).select(*rest, *[F.col(f"_s.{n}").cast("long").alias(n) for n in COUNTS])
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEATED_PERCENT * F.col("n_words"))
    return rows.withColumn("base_failed", failed)


def vectors(stats: DataFrame) -> DataFrame:
    """The transformed statistics as whole multiples of 1 / SCALE."""
    n, lines = F.greatest(F.col("n_words"), F.lit(1)), F.greatest(F.col("n_lines"), F.lit(1))
    values = (F.log1p("n_words"), F.log(F.greatest(F.col("word_chars"), F.lit(1)) / n), F.log1p(100 * F.col("n_symbols") / n), F.log1p(100 * F.col("n_dup_lines") / lines), F.col("n_repeat_words") / n)
    return stats.withColumns({x: F.round(v * SCALE).cast("long") for x, v in zip(VECTOR, values)})


def _own() -> Column:
    return F.to_json(F.struct("lang", "source"))


def group_names(rows: DataFrame, least: int = LEAST) -> DataFrame:
    """(_own, _group): for each language and source its group, or what is pooled for want of rows; null where nothing can be estimated."""
    sizes = written(rows.groupBy(_own().alias("_own"), F.to_json(F.struct("lang")).alias("_lang")).agg(F.count("*").alias("_n")), "groups")
    small = F.when(F.col("_n") < least, F.col("_n")).otherwise(0)
    pooled = sizes.withColumn("_rest", F.sum(small).over(Window.partitionBy("_lang")))
    last = F.when((F.col("_n") < least) & (F.col("_rest") < least), F.col("_n")).otherwise(0)
    pooled = pooled.withColumn("_last", F.sum(last).over(Window.partitionBy()))
    group = F.when(F.col("_n") >= least, F.col("_own")).when(F.col("_rest") >= least, F.concat(F.lit("rest "), F.col("_lang"))).when(F.col("_last") >= least, F.lit("rest"))
    return written(pooled.select("_own", group.alias("_group")), "group_names")


def grouped(rows: DataFrame, names: DataFrame) -> DataFrame:
    """Add _group; rows of no group keep null."""
    return rows.withColumn("_own", _own()).join(names, "_own", "left").drop("_own")


def _moments() -> list[Column]:
    sums = [F.sum(x).alias(f"s_{x}") for x in VECTOR]
    return [F.count("*").alias("n"), *sums, *[F.sum(F.col(VECTOR[i]) * F.col(VECTOR[j])).alias(f"q_{i}{j}") for i, j in PAIRS]]


MOMENTS = ["n", *[f"s_{x}" for x in VECTOR], *[f"q_{i}{j}" for i, j in PAIRS]]


def _estimate(sums: DataFrame, factor: float) -> DataFrame:
    """(_group, start, means, covariances c_ij with floors) from moments."""
    mean = [F.col(f"s_{x}") / F.col("n") / SCALE for x in VECTOR]
    cov = {(i, j): (F.col(f"q_{i}{j}") / F.col("n") / SCALE**2 - mean[i] * mean[j]) * factor + (FLOORS[i] ** 2 if i == j else 0.0) for i, j in PAIRS}
    return sums.select("_group", "start", *[m.alias(f"m{i}") for i, m in enumerate(mean)], *[cov[p].alias(f"c{p[0]}{p[1]}") for p in PAIRS])


def _whitened(estimate: DataFrame) -> DataFrame:
    """Add w_ij, the inverse of the covariance's Cholesky factor, and log_det."""
    df = estimate
    c = F.col
    for j in range(D):
        df = df.withColumn(f"l{j}{j}", F.sqrt(F.greatest(reduce(lambda a, k: a - c(f"l{j}{k}") * c(f"l{j}{k}"), range(j), c(f"c{j}{j}")), F.lit(1e-9))))
        df = df.withColumns({f"l{i}{j}": reduce(lambda a, k: a - c(f"l{i}{k}") * c(f"l{j}{k}"), range(j), c(f"c{i}{j}")) / c(f"l{j}{j}") for i in range(j + 1, D)}) if j + 1 < D else df
    for i in range(D):
        df = df.withColumn(f"w{i}{i}", 1 / c(f"l{i}{i}"))
        if i:
            df = df.withColumns({f"w{i}{j}": -reduce(add, [c(f"l{i}{k}") * c(f"w{k}{j}") for k in range(j, i)]) / c(f"l{i}{i}") for j in range(i)})
    df = df.withColumn("log_det", 2 * reduce(add, [F.log(f"l{i}{i}") for i in range(D)]))
    return df.select("_group", "start", "log_det", *[f"m{i}" for i in range(D)], *[f"w{i}{j}" for i, j in PAIRS])


def _distance() -> Column:
    """Squared Mahalanobis distance of a row that holds vector and estimate."""
    x = [F.col(v) / SCALE - F.col(f"m{i}") for i, v in enumerate(VECTOR)]
    z = [reduce(add, [F.col(f"w{i}{j}") * x[j] for j in range(i + 1)]) for i in range(D)]
    return reduce(add, [v * v for v in z])


def _quartiles(rows: DataFrame) -> DataFrame:
    """(_group, start 1, estimate) with medians as means and quartile ranges as deviations, from counts of values."""
    long = rows.select("_group", F.posexplode(F.array(*VECTOR)).alias("axis", "x")).groupBy("_group", "axis", "x").agg(F.count("*").alias("n"))
    by = Window.partitionBy("_group", "axis")
    long = long.withColumn("_up", F.sum("n").over(by.orderBy("x"))).withColumn("_all", F.sum("n").over(by))
    at = lambda q: F.min(F.when(F.col("_up") >= q * F.col("_all"), F.col("x"))) / SCALE
    q = long.groupBy("_group", "axis").agg(at(0.5).alias("m"), ((at(0.75) - at(0.25)) / 1.349).alias("sd"))
    wide = q.groupBy("_group").pivot("axis", list(range(D))).agg(F.first("m").alias("m"), F.first("sd").alias("sd"))
    return wide.select(
        "_group",
        F.lit(1).alias("start"),
        *[F.col(f"{i}_m").alias(f"m{i}") for i in range(D)],
        *[(F.col(f"{i}_sd") * F.col(f"{i}_sd") + FLOORS[i] ** 2 if i == j else F.lit(0.0)).alias(f"c{i}{j}") for i, j in PAIRS],
    )


def fit(rows: DataFrame, steps: int = STEPS) -> DataFrame:
    """The estimate of each _group: (_group, means, whitening, log_det); one row a group, written."""
    rows = rows.where("_group is not null").select("_group", *VECTOR)
    classical = _estimate(rows.groupBy("_group").agg(*_moments()).withColumn("start", F.lit(0)), 1.0)
    now = written(_whitened(classical.unionByName(_quartiles(rows))), "mcd0")
    for step in range(1, steps + 1):
        near = rows.join(now, "_group").withColumn("bin", F.floor(F.log2(1 + _distance()) * BINS_AN_OCTAVE).cast("int"))
        by_bin = near.groupBy("_group", "start", "bin").agg(*_moments())
        own = Window.partitionBy("_group", "start")
        run = own.orderBy("bin").rowsBetween(Window.unboundedPreceding, 0)
        sums = by_bin.select("_group", "start", "bin", F.col("n").alias("_own"), F.sum("n").over(own).alias("_all"), *[F.sum(m).over(run).alias(m) for m in MOMENTS])
        core = sums.where((F.col("n") >= CORE * F.col("_all")) & (F.col("n") - F.col("_own") < CORE * F.col("_all")))
        now = written(_whitened(_estimate(core, CONSISTENCY)), f"mcd{step}")
    best = F.row_number().over(Window.partitionBy("_group").orderBy("log_det", "start"))
    return written(now.withColumn("_best", best).where("_best = 1").drop("_best", "start"), "mcd")


def estimated(stats: DataFrame, least: int = LEAST) -> tuple[DataFrame, DataFrame]:
    """Group names and estimates from the rows of stats that pass the base rule."""
    passed = vectors(stats.where(~F.col("base_failed")))
    names = group_names(passed, least)
    return names, fit(grouped(passed, names))


def judged(stats: DataFrame, names: DataFrame, estimates: DataFrame, cutoff: float = CUTOFF) -> DataFrame:
    """Add distance (null where the base rule failed or nothing could be estimated) and kept; both other tables are small."""
    rows = grouped(vectors(stats), names).join(estimates, "_group", "left")
    rows = rows.withColumn("distance", F.when(~F.col("base_failed"), _distance()))
    return rows.select(*stats.columns, "distance", (~F.col("base_failed") & (F.coalesce("distance", F.lit(0.0)) <= cutoff)).alias("kept"))


def keep_passing(docs: DataFrame, cutoff: float = CUTOFF, least: int = LEAST) -> DataFrame:
    """The rows of docs that are kept, with all their columns; texts are counted once and never shuffled.

    The rows that pass the base rule are written beside their counts, so that the estimates read the counts' columns alone.
    """
    rows = counted(docs.select(F.struct(*docs.columns).alias("_row"), "text", "lang", "source"))
    passed = written(rows.where(~F.col("base_failed")), "passed")
    return judged(passed, *estimated(passed, least), cutoff).where("kept").select("_row.*")


def quality_counts(spark, sf_dir: str) -> DataFrame:
    """The counts and the base rule of every row of ``documents``: what SQL can say of op4."""
    found = counted(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select("doc_id", *COUNTS[:-1], "base_failed")


COUNTS_ORACLE = r"""
with d as (
  select doc_id, coalesce(text, '') t, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') w from documents
), windows as (
  select doc_id, i, w[i] a, w[i + 1] b, w[i + 2] c from (select doc_id, w, unnest(range(1, len(w) - 1)) i from d where len(w) >= 3)
), again as (
  select doc_id, i from windows qualify count(*) over (partition by doc_id, a, b, c) > 1
), repeated as (
  select doc_id, count(distinct i + k) n from again, (values (0), (1), (2)) s(k) group by doc_id
), lines as (
  select doc_id, l, count(*) n from (select doc_id, unnest(string_split(t, chr(10))) l from d) where regexp_matches(l, '[^\x20\x09-\x0D]') group by all
), extra as (select doc_id, sum(n - 1)::bigint n from lines group by doc_id),
counts as (
  select doc_id, len(w)::bigint n_words, length(array_to_string(w, ''))::bigint word_chars, (length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')))::bigint n_symbols,
    coalesce(e.n, 0) n_dup_lines, coalesce(r.n, 0)::bigint n_repeat_words
  from d left join extra e using (doc_id) left join repeated r using (doc_id)
)
select *, n_words < 50 or 100 * n_repeat_words > 50 * n_words base_failed from counts
"""


def op4_outliers(spark, sf_dir: str) -> DataFrame:
    """Counts and verdict for every row of ``documents``."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source")
    stats = written(counted(docs), "counts")
    return judged(stats, *estimated(stats)).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "distance")
