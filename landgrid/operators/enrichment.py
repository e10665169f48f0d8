"""What surrounds the cascade: who takes part, where a coordinate came from, and folding in what was recovered later."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from landgrid.functions import fields
from landgrid.operators import cascade, mining
from landgrid.session import written


def selected(records: DataFrame, collections: list[int] | None = None, years: tuple[int, int] | None = None, limit: int | None = None, key: str = "stem") -> DataFrame:
    """A run's records: of the collections and span of years asked for, and the first ``limit`` in order of key."""
    if collections:
        records = records.where(F.col("collection_num").isin(*collections))
    if years:
        records = records.where(F.col("year").between(*years))
    return records.orderBy(key).limit(limit) if limit else records


def _said(name: str) -> Column:
    return fields.blank_to_null(F.col(name).cast("string")).isNotNull()


def enrichable_skip() -> Column:
    """A skipped row with a dot, that lacks a survey field."""
    lacks = ~(_said("section") & _said("twp") & _said("rng"))
    return _said("dot_row") & _said("dot_col") & (fields.score("dot_confidence") > 0) & lacks


def centroid_eligible() -> Column:
    """All survey fields but no place of a dot: the dot stage was skipped, or is done without a place."""
    whole = _said("section") & _said("twp") & _said("rng")
    blank = ~_said("dot_row") & ~_said("dot_col")
    return whole & ((F.col("dot_status") == "skipped") | ((F.col("dot_status") == "done") & blank))


def runs(records: DataFrame, order: str, *keys: str) -> DataFrame:
    """Add run: the number of the stretch of neighbouring rows with the same keys, in order. Stretches are counted by range of
    the order column, so no task sees all rows; the order column must be unique."""
    own = F.struct(*keys)
    rows = written(records.repartitionByRange(order).sortWithinPartitions(order).withColumn("_p", F.spark_partition_id()), "runs")
    here = Window.partitionBy("_p").orderBy(order)
    rows = rows.withColumn("_new", F.coalesce((~own.eqNullSafe(F.lag(own).over(here))).cast("int"), F.lit(1)))
    ends = rows.groupBy("_p").agg(F.min_by(own, order).alias("first"), F.max_by(own, order).alias("last"), F.sum("_new").alias("n"))
    seen = Window.orderBy("_p")  # one row a partition
    ends = ends.withColumn("same", F.coalesce(F.lag("last").over(seen).eqNullSafe(F.col("first")) & (F.row_number().over(seen) > 1), F.lit(False)).cast("int"))
    before = ends.withColumn("_before", F.sum(F.col("n") - F.col("same")).over(seen) - F.col("n")).select("_p", "_before")
    return rows.join(before, "_p").withColumn("run", F.col("_before") + F.sum("_new").over(here)).drop("_p", "_new", "_before")


def quadrant_meta(ocr, unet) -> Column:
    """struct(source, agreement) of the evidence for a quadrant."""
    a, b = fields.blank_to_null(ocr).isNotNull(), fields.blank_to_null(unet).isNotNull()
    source = F.when(a & b, "both").when(a, "ocr").when(b, "unet").otherwise("none")
    same = F.when(a & b, F.when(fields.col(ocr) == fields.col(unet), "agree").otherwise("disagree")).when(a | b, "single_source").otherwise("none")
    return F.struct(source.alias("source"), same.alias("agreement"))


def derivation(lat, source, printed) -> Column:
    """How a coordinate came about; a printed one goes before all."""
    dot = F.when(fields.col(source) == "quadrant_direct", "dot_interpolation_quad").otherwise("dot_interpolation")
    return F.when(F.coalesce(fields.col(printed), F.lit(False)), "latlong_direct").when(fields.col(lat).isNotNull(), dot).otherwise("not_resolved")


def field_source(header, value) -> Column:
    """Where a survey field came from."""
    return F.when(fields.blank_to_null(header).isNotNull(), "header_block").when(fields.blank_to_null(value).isNotNull(), "ocr_extracted").otherwise("not_found")


def _centres(rows: DataFrame, grid: DataFrame, source: str) -> DataFrame:
    """stem, source, lat, lon, needs_review of rows with whole survey fields, by the centre of their section."""
    blank = {c: F.lit(None).cast(t) for c, t in (("dot_row", "int"), ("dot_col", "int"), ("x_norm", "double"), ("y_norm", "double")) if c not in rows.columns}
    ready = cascade.prepared(rows.withColumns(blank), mining.direction_stats(grid))
    return cascade.centroids(ready, cascade.grid_maps(grid)[0]).select("stem", F.lit(source).alias("source"), "lat", "lon", F.lit(True).alias("needs_review"))


def recovered_sections(status: DataFrame, texts: DataFrame, mapped: DataFrame, grid: DataFrame) -> DataFrame:
    """Located records without a section, extracted again from their texts (stem, text) and placed at the section's centre."""
    lost = status.where((F.col("location_status") == "done") & ~_said("section") & _said("twp") & _said("rng") & _said("county"))
    lost = lost.join(mapped.where("lat is not null").select("stem"), "stem", "left_anti")
    found = written(texts.join(lost.select("stem", "county"), "stem").select("stem", "county", fields.str_of_text("text").alias("x")), "read_again")
    t, r = fields.parsed("x.township", "NS"), fields.parsed("x.range", "EW")
    rows = found.select("stem", "county", F.col("x.section").cast("int").alias("section"), t["num"].alias("twp"), t["dir"].alias("ns"), r["num"].alias("rng"), r["dir"].alias("ew"))
    return _centres(rows.where("section is not null and twp is not null and rng is not null"), grid, "recovered_section_centroid")


def folded_campaign(shard: DataFrame, mapped: DataFrame, grid: DataFrame) -> DataFrame:
    """Records of a campaign that aren't mapped: by their dot, else by the centre of their section; stem, source, lat, lon, needs_review."""
    rows = shard.where(_said("section") & _said("twp") & _said("rng") & _said("county")).join(mapped.where("lat is not null").select("stem"), "stem", "left_anti")
    stats = written(mining.direction_stats(grid), "stats")
    sections, cells = (written(g, "grid") for g in cascade.grid_maps(grid))
    dotted = cascade.pass1(cascade.prepared(rows, stats), sections, cells).where("lat is not null").select("stem", "source", "lat", "lon")
    dotted = written(dotted.withColumn("needs_review", F.lit(True)), "campaign")
    rest = rows.join(dotted.select("stem"), "stem", "left_anti")
    centred = cascade.centroids(cascade.prepared(rest, stats), sections).select("stem", "source", "lat", "lon", F.lit(True).alias("needs_review"))
    return dotted.unionByName(centred)


def read_answer(answer) -> Column:
    """struct(section, township, range) of a model's answer, a line for each field; "not found" and values out of bounds are null."""
    raw = lambda name: F.trim(F.regexp_extract(fields.col(answer), rf"(?i){name}\s*[:\-]\s*([^\n/]+)", 1))
    told = lambda name: F.when((raw(name) != "") & ~F.contains(F.lower(raw(name)), F.lit("not")), raw(name))
    number = F.regexp_extract(told("Section"), "([0-9]+)", 1).try_cast("int")
    return F.struct(
        F.when(number.between(fields.SECTION_MIN, fields.SECTION_MAX), number.cast("string")).alias("section"), fields.bounded(told("Township"), "NS").alias("township"), fields.bounded(told("Range"), "EW").alias("range")
    )


def capped(n_found, strategy) -> Column:
    """Confidence of n of three fields: at most 75 where a model gave all, 85 where it filled a gap."""
    base, s = F.floor(fields.col(n_found) * 100 / 3), F.coalesce(fields.col(strategy), F.lit(""))
    return F.when(s.isin("llm", "llm_zone"), F.least(F.lit(75), base)).when(F.endswith(s, F.lit("+llm_fill")), F.least(F.lit(85), base)).otherwise(base).cast("int")
