"""Audits, insights and summaries. All are single aggregations with partial sums; roll-ups use grouping sets."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from landgrid.functions import fields
from landgrid.operators.status import STAGES, long_form, status_of


def percent(part: Column, whole: Column) -> Column:
    """Floor of the percentage, 0 where there is nothing to divide by."""
    return F.coalesce(F.floor(part * 100 / F.nullif(whole, F.lit(0))), F.lit(0)).cast("long")


def stage_rollup(wide: DataFrame) -> DataFrame:
    """Counts by collection and stage, with totals of each collection and of all."""
    long = long_form(wide, "collection_num")
    rolled = long.rollup("collection_num", "stage").agg(
        F.count("*").alias("n"), F.count_if(F.col("status") == "done").alias("done"), F.count_if(F.col("status") == "failed").alias("failed"), F.grouping_id().cast("long").alias("level")
    )
    return rolled.withColumn("done_pct", percent(F.col("done"), F.col("n")))


def stage_quality(wide: DataFrame) -> DataFrame:
    """For each stage how many are done, and their mean confidence."""
    done = F.col("status") == "done"
    return long_form(wide).groupBy("stage").agg(F.count_if(done).alias("done"), F.round(F.avg(F.when(done, F.col("confidence"))), 6).alias("avg_confidence"))


def field_completeness(rows: DataFrame) -> DataFrame:
    """How many records have all, any or none of section, township and range."""
    n = sum(F.col(c).isNotNull().cast("int") for c in ("section", "twp", "rng"))
    return rows.agg(F.count_if(n == 3).alias("full_str"), F.count_if(n > 0).alias("any_str"), F.count_if(n == 0).alias("no_str"), F.count("*").alias("n"))


def confidence_bins(wide: DataFrame) -> DataFrame:
    """Done stages by tens of confidence."""
    done = long_form(wide).where("status = 'done'").withColumn("bin", F.expr("confidence div 10 * 10"))
    return done.groupBy("stage", "bin").agg(F.count("*").alias("n"))


def failure_analysis(wide: DataFrame, examples: int = 5) -> DataFrame:
    """Failures by stage, error and era: count, span of years, first stems; by capped number of examples, then key."""
    failed = long_form(wide, "collection_num", "year").where("status = 'failed'").withColumn("tier", fields.tier("collection_num"))
    by = failed.groupBy("stage", "error_type", "tier").agg(
        F.count("*").alias("n"),
        F.min(F.col("year").try_cast("int")).alias("min_year"),
        F.max(F.col("year").try_cast("int")).alias("max_year"),
    )
    w = Window.partitionBy("stage", "error_type", "tier").orderBy("stem")
    first = failed.withColumn("_n", F.row_number().over(w)).where(F.col("_n") <= examples)
    first = first.groupBy("stage", "error_type", "tier").agg(F.array_sort(F.collect_list("stem")).alias("examples"))
    return by.join(first, ["stage", "error_type", "tier"])


def clusters(wide: DataFrame, n: int = 15) -> DataFrame:
    """The largest groups of failures by collection, stage, error and decade."""
    failed = long_form(wide, "collection_num", "year").where("status = 'failed'").withColumn("decade", fields.decade("year"))
    return failed.groupBy("collection_num", "stage", "error_type", "decade").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "collection_num", "stage", "error_type", "decade").limit(n)


def rates(wide: DataFrame) -> DataFrame:
    """Share of done by collection, a column for each stage."""
    ok = {s: percent(F.count_if(status_of(s) == "done"), F.count("*")).alias(f"{s}_pct") for s in STAGES}
    return wide.groupBy("collection_num").agg(F.count("*").alias("n"), *ok.values())


def flips(base: DataFrame, now: DataFrame) -> DataFrame:
    """Stages that had failed and are done, by collection and stage."""
    before = long_form(base).where("status = 'failed'").select("stem", "stage")
    after = long_form(now, "collection_num").where("status = 'done'")
    return after.join(before, ["stem", "stage"], "left_semi").groupBy("collection_num", "stage").agg(F.count("*").alias("n"))


def method_families(rows: DataFrame, source: str = "source") -> DataFrame:
    """Resolved records by family of method: the pass that placed them."""
    s = F.col(source)
    family = F.when(s.startswith("p3_"), "pass3").when(s.startswith("p4_"), "pass4").when(s.contains("_p2_"), "pass2").when(s == "section_centroid", "centroid").otherwise(s)
    return rows.groupBy(family.alias("family")).agg(F.count("*").alias("n"))


def agreement(candidate: DataFrame, verified: DataFrame, columns: list[str], key: str = "stem") -> DataFrame:
    """For each field how many rows both have, and how many agree."""
    v = verified.select(key, *[F.col(c).alias(f"_{c}") for c in columns])
    met = candidate.join(v, key)
    each = [F.struct(F.lit(c).alias("field"), (F.col(c).isNotNull() & F.col(f"_{c}").isNotNull()).alias("both"), F.coalesce(F.col(c) == F.col(f"_{c}"), F.lit(False)).alias("same")) for c in columns]
    by = met.select(F.inline(F.array(*each))).groupBy("field").agg(F.count_if("both").alias("n"), F.count_if("same").alias("agree"))
    return by.withColumn("agree_pct", percent(F.col("agree"), F.col("n")))


def coverage(rows: DataFrame, flag: str, group: str = "collection_num") -> DataFrame:
    return rows.groupBy(group).agg(F.count("*").alias("n"), F.count_if(flag).alias("hit")).withColumn("pct", percent(F.col("hit"), F.col("n")))


def top_mismatches(verdicts: DataFrame, n: int = 8) -> DataFrame:
    """The commonest pairs of extracted county and counties of the section."""
    wrong = verdicts.where("verdict = 'mismatch'").withColumn("grid_counties", F.array_join("counties", "|"))
    return wrong.groupBy("county", "grid_counties").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "county", "grid_counties").limit(n)


def upper_median(df: DataFrame, group: str, value: str) -> DataFrame:
    """The upper middle value of each group by ranks (element n div 2 of the sorted values)."""
    w = Window.partitionBy(group)
    ranked = df.where(F.col(value).isNotNull()).withColumn("_r", F.row_number().over(w.orderBy(value)) - 1).withColumn("_n", F.count("*").over(w))
    return ranked.where("_r = _n div 2").select(group, F.col(value).alias("median"))


def top_per_group(df: DataFrame, group: str, value: str, n: int = 3) -> DataFrame:
    """The commonest values of each group."""
    counts = df.groupBy(group, value).agg(F.count("*").alias("n"))
    w = Window.partitionBy(group).orderBy(F.desc("n"), value)
    return counts.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= n)


def cross_table(df: DataFrame, row: str, column: str, values: list) -> DataFrame:
    return df.groupBy(row).pivot(column, values).agg(F.count(F.lit(1))).fillna(0)


def cost(wide: DataFrame, calls: float = 1.6, recognise: float = 2.768, read: float = 0.056) -> DataFrame:
    """Cost by collection of the records that wait, at the given prices for a thousand."""
    pending = F.count_if(status_of("location") == "pending")
    return wide.groupBy("collection_num").agg(pending.alias("pending")).withColumn("cost", F.round(F.col("pending") / 1000 * (recognise + read), 6)).withColumn("calls", F.round(F.col("pending") * calls, 1))


def queue_delta(before: DataFrame, after: DataFrame, stage: str = "stage") -> DataFrame:
    """Change of a review queue by stage."""
    a, b = (t.groupBy(stage).agg(F.count("*").alias(n)) for t, n in ((before, "before"), (after, "after")))
    return a.join(b, stage, "full").fillna(0).withColumn("delta", F.col("after") - F.col("before"))


def histogram(rows: DataFrame, column: str) -> DataFrame:
    return rows.groupBy(column).agg(F.count("*").alias("n"))


def hit_rate(rows: DataFrame, within: float = 0.06) -> DataFrame:
    """Share of predictions close to the truth, by source; columns x, y, true_x, true_y."""
    d = F.sqrt(F.pow(F.col("x") - F.col("true_x"), 2) + F.pow(F.col("y") - F.col("true_y"), 2))
    return rows.groupBy("source").agg(F.count("*").alias("n"), F.round(F.avg((d <= within).cast("double")), 6).alias("hit_rate"))


def index_summary(records: DataFrame) -> DataFrame:
    """Records, size, collections and years of an index."""
    return records.agg(
        F.count("*").alias("n"), F.round(F.sum("file_size_bytes") / 1048576, 6).alias("mb"), F.countDistinct("collection_num").alias("collections"), F.min("year").alias("min_year"), F.max("year").alias("max_year")
    )


def run_insights(runs: DataFrame) -> DataFrame:
    """For each stage of a run log (stage, status, confidence, seconds): counts, means, share of low confidence."""
    done = F.col("status") == "done"
    by = runs.groupBy("stage").agg(
        F.count("*").alias("n"),
        F.count_if(done).alias("detected"),
        F.count_if(F.col("status") == "failed").alias("failed"),
        F.count_if(F.col("status") == "skipped").alias("skipped"),
        F.round(F.avg(F.when(done, F.col("confidence"))), 6).alias("avg_confidence"),
        F.round(F.avg("seconds"), 6).alias("avg_seconds"),
        percent(F.count_if(done & (F.col("confidence") < 50)), F.count_if(done)).alias("low_pct"),
    )
    return by.withColumn("recommend", percent(F.col("failed"), F.col("n")) >= 10)


def trend(history: DataFrame, least_runs: int = 3, least: int = 10, rate: float = 0.3) -> DataFrame:
    """Stages that keep failing over a history (run, stage, status, error_type, n), with their dominant error."""
    by = history.groupBy("stage").agg(F.countDistinct("run").alias("runs"), F.sum("n").alias("total"), F.sum(F.when(F.col("status") == "failed", F.col("n")).otherwise(0)).alias("failed"))
    errors = history.where("status = 'failed' and error_type is not null").groupBy("stage", "error_type").agg(F.sum("n").alias("n"))
    top = errors.groupBy("stage").agg(F.max(F.struct("n", "error_type")).alias("m")).select("stage", F.col("m.error_type").alias("dominant_error"))
    return by.where((F.col("runs") >= least_runs) & (F.col("total") >= least) & (F.col("failed") >= rate * F.col("total"))).join(top, "stage", "left")


def suspects(done: DataFrame, envelopes: DataFrame, pad: float = 0.04) -> DataFrame:
    """By collection, grids whose centre lies outside the envelope by more than twice the pad."""
    from landgrid.functions.geometry import suspect

    met = done.join(envelopes, "collection_num")
    return met.groupBy("collection_num").agg(F.count("*").alias("n"), F.count_if(suspect("cx", "cy", "x0", "y0", "x1", "y1", pad)).alias("suspects"))


def slice_report(wide: DataFrame, reasons: int = 8) -> DataFrame:
    """For each stage: records, done, failed, skipped, share of done, mean confidence, and its commonest reasons of failure."""
    rows = long_form(wide)
    counts = rows.groupBy("stage").agg(
        F.count("*").alias("n"),
        *[F.count_if(F.col("status") == s).alias(s) for s in ("done", "failed", "skipped")],
        F.avg(F.when(F.col("status") == "done", F.coalesce("confidence", F.lit(0)))).alias("avg_confidence"),
    )
    why = rows.where("status = 'failed'").groupBy("stage", F.coalesce("error_type", F.lit("unknown")).alias("reason")).agg(F.count("*").alias("k"))
    ranked = why.withColumn("_r", F.row_number().over(Window.partitionBy("stage").orderBy(F.desc("k"), "reason"))).where(F.col("_r") <= reasons)
    text = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("_r", "reason", "k"))), lambda x: F.concat(x["reason"], F.lit("="), x["k"].cast("string"))), ",")
    top = ranked.groupBy("stage").agg(text.alias("reasons"))
    return counts.join(top, "stage", "left").withColumn("done_pct", percent(F.col("done"), F.col("n"))).withColumn("reasons", F.coalesce("reasons", F.lit("")))


def smoke_report(wide: DataFrame) -> DataFrame:
    """(tier, what, n): statuses by stage, bands of county score, and how many of three survey fields each era's records have."""
    tier = fields.tier("collection_num").alias("tier")
    stages = long_form(wide, "collection_num").groupBy(tier, F.concat_ws(" ", "stage", "status").alias("what")).agg(F.count("*").alias("n"))
    score = fields.score("county_score")
    band = F.when(score >= 95, "score 95+").when(score >= 86, "score 86-94").when(score >= 72, "score 72-85").otherwise("score below 72")
    found = sum(F.col(c).isNotNull().cast("int") for c in ("section", "twp", "rng"))
    more = [wide.groupBy(tier, x.alias("what")).agg(F.count("*").alias("n")) for x in (band, F.concat(F.lit("fields "), found.cast("string")))]
    return stages.unionByName(more[0]).unionByName(more[1])


def audit(wide: DataFrame) -> DataFrame:
    """(section, name, n) of a collection audit: success rates, confidence, missing and bad survey fields, errors, score deciles, years, dots of grids, whole records."""
    done = lambda s: status_of(s) == "done"
    rows = long_form(wide, "year")
    place = done("location")
    part = lambda section, df: df.select(F.lit(section).alias("section"), F.col("name").cast("string").alias("name"), F.col("n").cast("long").alias("n"))
    tally = lambda df, name: df.groupBy(name.alias("name")).agg(F.count("*").alias("n"))
    ended = F.count_if(F.col("status").isin("done", "failed"))
    rates_ = rows.groupBy(F.col("stage").alias("name")).agg(percent(F.count_if(F.col("status") == "done"), ended).alias("n"))
    missing = wide.where(place).select(F.explode(F.array_compact(F.array(*[F.when(F.col(c).isNull(), c) for c in ("section", "twp", "rng")]))).alias("m"))
    ok = F.coalesce(F.col("section").between(1, 36), F.lit(True)) & F.coalesce(F.col("twp").between(1, 29), F.lit(True)) & F.coalesce(F.col("rng").between(1, 28), F.lit(True))
    whole = done("grid") & done("county") & done("dot") & place & F.col("section").isNotNull() & F.col("twp").isNotNull() & F.col("rng").isNotNull()
    by_year = wide.groupBy(F.col("year").alias("name")).agg(percent(F.count_if(place), F.count_if(status_of("location").isin("done", "failed"))).alias("n"))
    dots = wide.where(done("grid")).groupBy(status_of("dot").alias("name")).agg(F.count("*").alias("n"))
    sections = {
        "rate": rates_,
        "confidence": tally(wide.where(place), F.floor(F.col("location_confidence") / 10) * 10),
        "missing": tally(missing, F.col("m")),
        "sane": tally(wide.where(place), F.when(ok, "good").otherwise("bad")),
        "error": tally(rows.where("status = 'failed'"), F.concat_ws(" ", "stage", F.coalesce("error_type", F.lit("unknown")))),
        "score": tally(wide.where(done("county")), F.floor(F.col("county_score") / 10) * 10),
        "year": by_year,
        "dot of grid": dots,
        "whole": tally(wide, F.when(whole, "yes").otherwise("no")),
    }
    out = None
    for name, df in sections.items():
        out = part(name, df) if out is None else out.unionByName(part(name, df))
    return out


def markdown(df: DataFrame, title: str) -> str:
    """A report as a Markdown table: every row, fetched a partition at a time."""
    lines = [f"## {title}", "", "| " + " | ".join(df.columns) + " |", "|" + "--|" * len(df.columns)]
    lines += ["| " + " | ".join("" if v is None else str(v).replace("|", "\\|").replace("\n", " ") for v in r) + " |" for r in df.toLocalIterator()]
    return "\n".join(lines) + "\n"
