"""Ledger, orphans, publishing, corrections, worklists and backfills: keyed joins of whole tables."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from landgrid.functions import fields
from landgrid.operators.status import STAGES, long_form, status_of


def ledger(index: DataFrame, status: DataFrame, coords: DataFrame, site: DataFrame) -> DataFrame:
    """Every record of the index with its state: mapped, resolved, failed at its first failed stage, processed or untouched."""
    first_failed = F.coalesce(*[F.when(status_of(s) == "failed", s) for s in STAGES])
    s = status.select("stem", F.lit(True).alias("_s"), first_failed.alias("failed_stage"))
    c = coords.where("lat is not null").select("stem", F.lit(True).alias("_c"))
    m = site.select("stem", F.lit(True).alias("_m"))
    rows = index.join(s, "stem", "left").join(c, "stem", "left").join(m, "stem", "left")
    state = F.when(F.col("_m"), "mapped").when(F.col("_c"), "resolved").when(F.col("failed_stage").isNotNull(), "failed").when(F.col("_s"), "processed").otherwise("untouched")
    return rows.withColumn("state", state).drop("_s", "_c", "_m")


def orphans(index: DataFrame, status: DataFrame, coords: DataFrame, site: DataFrame) -> DataFrame:
    """Stems that one table has and the table before it lacks."""
    minus = lambda a, b, kind: a.select("stem").join(b.select("stem"), "stem", "left_anti").distinct().withColumn("kind", F.lit(kind))
    return minus(status, index, "status_not_in_index").unionByName(minus(site, index, "site_not_in_index")).unionByName(minus(site, coords, "site_not_in_coords"))


def backfilled(rows: DataFrame, *sources: DataFrame, columns: tuple[str, ...] = ("collection_num", "year", "month")) -> DataFrame:
    """Null columns of rows from the first source that has all of them."""
    out = rows
    for i, s in enumerate(sources):
        whole = s.where(" and ".join(f"{c} is not null" for c in columns)).select("stem", F.struct(*columns).alias(f"_{i}"))
        out = out.join(whole, "stem", "left")
    found = F.coalesce(*[F.col(f"_{i}") for i in range(len(sources))])
    return out.withColumns({c: F.coalesce(c, found[c]) for c in columns}).drop(*[f"_{i}" for i in range(len(sources))])


def published(new: DataFrame, prior: DataFrame, marks: tuple[str, ...] = ("verified", "corrected")) -> DataFrame:
    """A build that never shrinks: the new features, with human marks of the prior build, and prior features that it lacks."""
    own = [c for c in marks if c in prior.columns]
    carried = prior.select("stem", *[F.col(c).alias(f"_{c}") for c in own])
    base = new.drop(*own).join(carried, "stem", "left").withColumns({c: F.coalesce(f"_{c}", F.lit(False)) for c in own}).drop(*[f"_{c}" for c in own])
    kept = prior.join(new.select("stem"), "stem", "left_anti")
    return base.withColumn("carried", F.lit(False)).unionByName(kept.withColumn("carried", F.lit(True)), allowMissingColumns=True)


def completed_groups(index: DataFrame, status: DataFrame, done: DataFrame, keys: list[str]) -> DataFrame:
    """Groups of the index all of whose records are finished, that are not published yet."""
    from landgrid.operators.status import finished

    over = finished(status, resume=True).select("stem", F.lit(1).alias("_f"))
    by = index.join(over, "stem", "left").groupBy(*keys).agg(F.count("*").alias("n"), F.count("_f").alias("n_finished"))
    return by.where("n_finished >= n").join(done.select(*keys), keys, "left_anti")


def failed_export(index: DataFrame, status: DataFrame) -> DataFrame:
    """Failed records of the index with their failed stages and error kinds, in stage order."""
    each = lambda f: F.array_join(F.array_compact(F.array(*[F.when(status_of(s) == "failed", f(s)) for s in STAGES])), ",")
    rows = status.select("stem", each(F.lit).alias("failed_stages"), each(lambda s: F.coalesce(F.col(f"{s}_error_type"), F.lit(""))).alias("error_types"))
    return index.join(rows.where("failed_stages <> ''"), "stem")


def worklists(status: DataFrame, coords: DataFrame) -> DataFrame:
    """Records to review: unresolved, not failed, by what they lack; the first category that fits."""
    resolved = coords.where("lat is not null").select("stem")
    open_ = status.join(resolved, "stem", "left_anti")
    have = lambda c: F.col(c).isNotNull()
    survey = have("section") & have("twp") & have("rng")
    category = (
        F.when((status_of("dot") == "done") & ~survey, "dot_without_survey")
        .when(survey & (status_of("dot") != "done"), "survey_without_dot")
        .when(have("section") | have("twp") | have("rng"), "partial_survey")
        .when(status_of("county") == "done", "county_only")
    )
    return open_.withColumn("category", category).where("category is not null")


def last_changes(log: DataFrame) -> DataFrame:
    """The change of each (stem, field) with the highest issue number."""
    best = log.groupBy("stem", "field").agg(F.max(F.struct("issue", "new")).alias("b"))
    return best.select("stem", "field", F.col("b.new").alias("new"), F.col("b.issue").alias("issue"))


def corrected(rows: DataFrame, log: DataFrame, columns: list[str]) -> DataFrame:
    """Rows after the changes: a value that the log has replaces the old one."""
    wide = last_changes(log).groupBy("stem").pivot("field", columns).agg(F.first("new"))
    new = wide.select("stem", *[F.col(c).alias(f"_{c}") for c in columns])
    return rows.join(new, "stem", "left").withColumns({c: F.coalesce(F.col(f"_{c}").try_cast(dict(rows.dtypes)[c]), F.col(c)) for c in columns}).drop(*[f"_{c}" for c in columns])


def change_log(rows: DataFrame, log: DataFrame, columns: list[str]) -> DataFrame:
    """What the changes alter: stem, field, old, new, issue; changes to the value that a row has are none."""
    old = rows.select("stem", F.inline(F.array(*[F.struct(F.lit(c).alias("field"), F.col(c).cast("string").alias("old")) for c in columns])))
    return last_changes(log).join(old, ["stem", "field"]).where("not (old <=> new)").select("stem", "field", "old", "new", "issue")


SURVEY = ["section", "twp", "ns", "rng", "ew", "quad"]


def reapplied(rows: DataFrame, log: DataFrame, resolve: Callable[[DataFrame], DataFrame], survey: list[str] = SURVEY, other: tuple[str, ...] = ("county",)) -> DataFrame:
    """Mapped rows (stem, survey fields, county, lat, lon, resolution) after the changes, with coordinates to match, and note.

    lat and lon of the log win; one that the log lacks is the row's, and without it the override is ignored. Else rows
    whose survey fields change go to ``resolve`` (rows -> stem, lat, lon, source), and those that it doesn't place keep
    their coordinates, marked "+needs-coord-rerun". note: human_latlong, latlong_incomplete, reresolved, needs_rerun,
    fields_updated, no_change; null for rows that the log doesn't name. corrected tells whether anything changed.
    Changes of no use (values that don't parse, fields that rows don't have) are none; county alone doesn't re-resolve.
    """
    fields_ = [c for c in (*survey, *other) if c in rows.columns]
    types = dict(rows.dtypes)
    wide = last_changes(log).groupBy("stem").pivot("field", [*fields_, "lat", "lon"]).agg(F.first("new"))
    new = wide.select("stem", F.lit(True).alias("_named"), *[F.col(c).try_cast(types[c]).alias(f"_{c}") for c in fields_], *[fields.coordinate(c).alias(f"_{c}") for c in ("lat", "lon")])
    differs = lambda names: reduce(lambda a, b: a | b, [F.col(f"_{c}").isNotNull() & ~F.col(f"_{c}").eqNullSafe(F.col(c)) for c in names], F.lit(False))
    met = rows.join(new, "stem", "left").withColumns({"_any": differs(fields_), "_moved": differs([c for c in survey if c in fields_])})
    met = met.withColumns({c: F.coalesce(f"_{c}", c) for c in fields_})
    met = met.withColumn("_given", F.col("_lat").isNotNull() | F.col("_lon").isNotNull())
    met = met.withColumns({f"_{c}": F.coalesce(f"_{c}", c) for c in ("lat", "lon")})
    # the join is by stem and only rows to resolve take part in it
    again = F.col("_moved") & ~F.col("_given")
    found = resolve(met.where(again).select(*rows.columns)).where("lat is not null and lon is not null")
    found = found.select("stem", F.struct("lat", "lon", "source").alias("_found"))
    met = met.join(found, "stem", "left")
    whole = F.col("_given") & F.col("_lat").isNotNull() & F.col("_lon").isNotNull()
    placed = again & F.col("_found").isNotNull()
    note = F.when(whole, "human_latlong").when(F.col("_given"), "latlong_incomplete").when(placed, "reresolved").when(again, "needs_rerun").when(F.col("_any"), "fields_updated").when(F.col("_named"), "no_change")
    at = lambda c: F.when(whole, F.round(F.col(f"_{c}"), 7)).when(placed, F.round(F.col(f"_found.{c}"), 7)).otherwise(F.col(c))
    source = F.when(whole, "human_latlong").when(placed, F.col("_found.source")).when(again, F.concat(F.coalesce("resolution", F.lit("")), F.lit("+needs-coord-rerun"))).otherwise(F.col("resolution"))
    result = {"lat": at("lat"), "lon": at("lon"), "resolution": source, "note": note, "corrected": F.coalesce(F.col("_any") | whole, F.lit(False))}
    kept = [c for c in rows.columns if c not in result]
    return met.select(*kept, *[v.alias(k) for k, v in result.items()])


def upgraded(coords: DataFrame, printed: DataFrame, source: str = "modern_text_section_centroid") -> DataFrame:
    """Coordinates of one source replaced by printed ones where there are any."""
    p = printed.select("stem", F.col("lat").alias("_lat"), F.col("lon").alias("_lon"))
    use = (F.col("source") == source) & F.col("_lat").isNotNull()
    met = coords.join(p, "stem", "left")
    return met.withColumns({"lat": F.when(use, F.col("_lat")).otherwise(F.col("lat")), "lon": F.when(use, F.col("_lon")).otherwise(F.col("lon")), "source": F.when(use, "printed_latlon").otherwise(F.col("source"))}).drop("_lat", "_lon")


def only_unmapped(rows: DataFrame, site: DataFrame) -> DataFrame:
    return rows.join(site.select("stem"), "stem", "left_anti")


def missing_objects(index: DataFrame, stored: DataFrame, prefix: str) -> DataFrame:
    """Records without a stored object, and the key that each is to have."""
    key = F.concat_ws("/", F.lit(prefix), F.col("collection_num").cast("string"), F.col("year").cast("string"), F.concat("stem", F.lit(".pdf")))
    return index.join(stored.select("stem"), "stem", "left_anti").select("stem", key.alias("key"))


def completed_index(index: DataFrame, listed: DataFrame) -> DataFrame:
    """The index with the listed files that it lacks."""
    return index.unionByName(listed.join(index.select("stem"), "stem", "left_anti"), allowMissingColumns=True)


def confirmed(decisions: DataFrame) -> DataFrame:
    """The last confirmed review decision of each record (column at orders them)."""
    from landgrid.operators.status import newest

    return newest(decisions.where("decision = 'confirmed'"), ["stem"], "at")


def progress(index: DataFrame, status: DataFrame, *keys: str) -> DataFrame:
    """Of each group: records, finished ones, and those not started (absent or blank)."""
    state = status.select("stem", F.coalesce(*[fields.blank_to_null(f"{s}_status") for s in STAGES]).alias("_any"), *[f"{s}_status" for s in STAGES])
    met = index.join(state, "stem", "left")
    over = F.forall(F.array(*[fields.blank_to_null(f"{s}_status") for s in STAGES]), lambda s: F.coalesce(s.isin("done", "skipped", "failed"), F.lit(False)))
    return met.groupBy(*keys).agg(F.count("*").alias("n"), F.count_if(over).alias("finished"), F.count_if(F.col("_any").isNull()).alias("not_started"))


def stage_failures(status: DataFrame) -> DataFrame:
    """Summary of failures by stage and error with each stage's total."""
    failed = long_form(status).where("status = 'failed'").groupBy("stage", "error_type").agg(F.count("*").alias("n"))
    return failed.withColumn("total", F.sum("n").over(Window.partitionBy("stage")))


def authorised(issues: DataFrame, members: tuple[str, ...] = ("OWNER", "MEMBER", "COLLABORATOR"), title: str = "correction:") -> tuple[DataFrame, DataFrame]:
    """Issues with the title prefix: those of members, and those of others."""
    own = issues.where(F.lower("title").startswith(title))
    ok: Column = F.col("association").isin(*members)
    return own.where(ok), own.where(~F.coalesce(ok, F.lit(False)))
