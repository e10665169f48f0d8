"""The status store: one row a record, five stages; long form, gates, merges, retries."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from landgrid.functions import fields

STAGES = ("latlong", "grid", "location", "county", "dot")
TERMINAL = ("done", "skipped")
#: Least share of records with printed coordinates for which the costly stage runs.
PRIOR_GATE = 0.05


def status_of(stage: str) -> Column:
    """A stage's status; blank is pending."""
    return F.coalesce(fields.blank_to_null(f"{stage}_status"), F.lit("pending"))


def long_form(wide: DataFrame, *keep: str, stages: tuple[str, ...] = STAGES) -> DataFrame:
    """stem, stage, status, confidence, error_type and the columns to keep: one pass, no shuffle."""
    has = set(wide.columns)
    entry = lambda s: F.struct(
        F.lit(s).alias("stage"),
        status_of(s).alias("status"),
        (fields.score(f"{s}_confidence") if f"{s}_confidence" in has else F.lit(0)).alias("confidence"),
        (F.col(f"{s}_error_type") if f"{s}_error_type" in has else F.lit(None).cast("string")).alias("error_type"),
    )
    return wide.select("stem", *keep, F.inline(F.array(*[entry(s) for s in stages])))


def tally(wide: DataFrame) -> DataFrame:
    """Records of each status in each stage."""
    return long_form(wide).groupBy("stage", "status").agg(F.count("*").alias("n"))


def newest(log: DataFrame, keys: list[str], version: str, *tie: str) -> DataFrame:
    """The latest row of each key. max_by keeps one row a key in every task before the shuffle."""
    rest = [c for c in log.columns if c not in keys]
    best = F.max(F.struct(version, *[t for t in tie], *[c for c in rest if c not in (version, *tie)]))
    return log.groupBy(*keys).agg(best.alias("b")).select(*keys, *[F.col(f"b.{c}").alias(c) for c in rest])


def ranked_merge(tables: list[DataFrame], key: str, score: Column) -> DataFrame:
    """Rows of several tables by key: greatest score wins, earlier tables win ties; columns are united."""
    tagged = [t.withColumn("_source", F.lit(i)) for i, t in enumerate(tables)]
    all_ = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tagged).withColumn("_score", score)
    w = Window.partitionBy(key).orderBy(F.desc_nulls_last("_score"), "_source")
    return all_.withColumn("_n", F.row_number().over(w)).where("_n = 1").drop("_n", "_score", "_source")


def overlaid(base: DataFrame, dirty: DataFrame, key: str = "stem") -> DataFrame:
    """The store after a save: rows that changed replace those on disk."""
    return base.join(dirty.select(key), key, "left_anti").unionByName(dirty, allowMissingColumns=True)


def merged_base_and_shards(base: DataFrame, shards: list[DataFrame], key: str = "stem") -> DataFrame:
    """Base, then shards in order; a later table replaces whole rows."""
    return ranked_merge([base, *shards], key, F.col("_source"))


def gates(wide: DataFrame) -> DataFrame:
    """Add run_<stage>: whether each stage is to run, by prior and by what earlier stages found."""
    pending = lambda s: status_of(s).isin("pending", "failed")
    has_ll = (status_of("latlong") == "done") & fields.blank_to_null("latlong_lat").isNotNull()
    return wide.withColumns(
        {
            "run_latlong": pending("latlong") & (fields.latlong_prior("collection_num") >= PRIOR_GATE),
            "run_grid": pending("grid") & ~has_ll,
            "run_location": pending("location") & ~has_ll,
            "run_county": pending("county"),
            "run_dot": pending("dot") & (status_of("grid") == "done"),
        }
    )


def finished(wide: DataFrame, resume: bool = False) -> DataFrame:
    """Records of which some stage has a status and all are done, skipped or (on resume) failed."""
    ok = [*TERMINAL, "failed"] if resume else list(TERMINAL)
    statuses = F.array(*[fields.blank_to_null(f"{s}_status") for s in STAGES])
    return wide.where(F.exists(statuses, lambda s: s.isNotNull()) & F.forall(statuses, lambda s: F.coalesce(s.isin(ok), F.lit(False))))


def split(wide: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(success and review, failed) by one derived column."""
    rows = fields.classified(wide)
    return rows.where("final_status <> 'failed'"), rows.where("final_status = 'failed'")


def reset(wide: DataFrame, when: Column, stages: tuple[str, ...], blank: tuple[str, ...] = ()) -> DataFrame:
    """Stages of the rows that match back to pending, and columns blank; other rows stay."""
    new = {f"{s}_status": F.when(when, "pending").otherwise(F.col(f"{s}_status")) for s in stages}
    return wide.withColumns(new | {c: F.when(~when, F.col(c)) for c in blank})


def reset_skipped_location(wide: DataFrame) -> DataFrame:
    """Location skipped though no coordinates were found."""
    wrong = (status_of("location") == "skipped") & fields.blank_to_null("latlong_lat").isNull()
    return reset(wide, wrong, ("location",), ("location_confidence",))


def reset_misclassified(wide: DataFrame, form: str = "form_type") -> DataFrame:
    """Early collections whose form was taken for a later kind: everything runs again."""
    return reset(wide, (fields.tier("collection_num") == "early") & (F.col(form) == "MID"), STAGES, (form,))


def short_county_matches(log: DataFrame) -> DataFrame:
    """Records of a log (stem, candidate, county) whose county only candidates of one or two letters gave."""
    by = log.groupBy("stem", "county").agg(F.max(F.char_length("candidate")).alias("longest"))
    return by.where("longest <= 2").select("stem", "county")


def reset_short_county(wide: DataFrame, log: DataFrame) -> DataFrame:
    """Counties that only candidates of one or two letters gave run again."""
    hit = short_county_matches(log).select("stem", F.lit(True).alias("_hit")).distinct()
    met = wide.join(hit, "stem", "left").withColumn("_hit", F.coalesce("_hit", F.lit(False)))
    blank = tuple(c for c in ("county", "county_score", "county_confidence") if c in wide.columns)
    return reset(met, F.col("_hit"), ("county",), blank).drop("_hit")


def retry_plan(wide: DataFrame, policy: DataFrame) -> DataFrame:
    """Failed stages joined to the whole policy (stage, error_type, action, parameter); others take the action plain."""
    failed = long_form(wide).where("status = 'failed'").select("stem", "stage", "error_type")
    return failed.join(policy, ["stage", "error_type"], "left").withColumn("action", F.coalesce("action", F.lit("plain")))
