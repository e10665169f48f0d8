"""What the land grid says about counties and sections, and group consensus."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

STR = ["sect", "twp", "ns", "rng", "ew"]


def section_boxes(grid: DataFrame, *more: str) -> DataFrame:
    """Box and number of cells of each section; boxes without extent go."""
    boxes = grid.groupBy(*STR, *more).agg(
        F.min("minx").alias("minx"), F.min("miny").alias("miny"), F.max("maxx").alias("maxx"), F.max("maxy").alias("maxy"), F.count("*").alias("n_cells")
    )
    return boxes.where("maxx > minx and maxy > miny")


def cell_boxes(grid: DataFrame) -> DataFrame:
    """One box of each (section, quadrant): the least, where the grid has several."""
    box = F.struct("minx", "miny", "maxx", "maxy", "county")
    return grid.groupBy(*STR, "quad").agg(F.min(box).alias("_box")).select(*STR, "quad", "_box.*")


def direction_stats(grid: DataFrame) -> DataFrame:
    """Directions of each county, most cells first; north and west first among equals."""
    counts = grid.groupBy("county", "ns", "ew").agg(F.count("*").alias("n"))

    def order(axis: str, first: str) -> DataFrame:
        by = counts.where(F.col(axis).isNotNull()).groupBy("county", axis).agg(F.sum("n").alias("n"))
        item = F.struct((-F.col("n")).alias("k"), (F.col(axis) != first).alias("l"), F.col(axis).alias("d"))
        return by.groupBy("county").agg(F.transform(F.array_sort(F.collect_list(item)), lambda x: x["d"]).alias(f"{axis}_order"))

    return order("ns", "N").join(order("ew", "W"), "county", "full")


def county_constraints(grid: DataFrame) -> DataFrame:
    """Limits of township and range, directions and number of sections of each county."""
    return grid.where("county is not null").groupBy("county").agg(
        F.min("twp").alias("min_twp"),
        F.max("twp").alias("max_twp"),
        F.array_sort(F.collect_set("ns")).alias("ns_values"),
        F.min("rng").alias("min_rng"),
        F.max("rng").alias("max_rng"),
        F.array_sort(F.collect_set("ew")).alias("ew_values"),
        F.countDistinct(*STR).alias("n_sections"),
    )


def dominant(counted: DataFrame, by: list[str], value: list[str], count: str = "n", factor: int = 4) -> DataFrame:
    """Of each group the value that stands alone or has ``factor`` times the next count."""
    w = Window.partitionBy(*by).orderBy(F.desc(count), *value)
    ranked = counted.withColumn("_next", F.lead(count).over(w)).withColumn("_rank", F.row_number().over(w))
    return ranked.where(f"_rank = 1 and (_next is null or {count} >= {factor} * _next)").drop("_next", "_rank")


def infer_missing(rows: DataFrame, grid: DataFrame, axis: str) -> DataFrame:
    """Rows (with county) whose township (or range) is null, filled where the county's grid leaves one dominant value.

    The grid is counted once by its keys, so rows meet counts, not cells.
    """
    value, known = (["twp", "ns"], ["rng", "ew"]) if axis == "twp" else (["rng", "ew"], ["twp", "ns"])
    counts = grid.groupBy("county", "sect", *known, *value).agg(F.count("*").alias("n"))
    best = dominant(counts, ["county", "sect", *known], value)
    filled = best.select("county", F.col("sect").alias("section"), *known, *[F.col(v).alias(f"_{v}") for v in value])
    return rows.join(filled, ["county", "section", *known]).withColumns({v: F.col(f"_{v}") for v in value}).drop(*[f"_{v}" for v in value])


def consensus(resolved: DataFrame, keys: list[str], values: list[str]) -> DataFrame:
    """Of each group the values on which all its rows agree, null where they differ."""
    agreed = lambda v: F.when(F.min(v) == F.max(v), F.min(v)).alias(v)
    return resolved.groupBy(*keys).agg(*[agreed(v) for v in values])


def filled_by_consensus(rows: DataFrame, agreed: DataFrame, keys: list[str], values: list[str]) -> DataFrame:
    """Null values of rows from their group's consensus."""
    other = agreed.select(*keys, *[F.col(v).alias(f"_{v}") for v in values])
    return rows.join(other, keys, "left").withColumns({v: F.coalesce(v, f"_{v}") for v in values}).drop(*[f"_{v}" for v in values])


def county_consistency(rows: DataFrame, grid: DataFrame) -> DataFrame:
    """agree, border (agrees, the section has several counties), mismatch or no_section for each row's county."""
    counties = grid.groupBy(*STR).agg(F.array_sort(F.collect_set("county")).alias("counties"))
    met = rows.join(counties.withColumnRenamed("sect", "section"), ["section", "twp", "ns", "rng", "ew"], "left")
    held = F.array_contains("counties", F.col("county"))
    verdict = F.when(F.col("counties").isNull(), "no_section").when(held & (F.size("counties") == 1), "agree").when(held, "border").otherwise("mismatch")
    return met.withColumn("verdict", verdict)


def pinned(rows: DataFrame, grid: DataFrame) -> DataFrame:
    """Missing directions from the row's county: kept where exactly one choice has cells there."""
    choices = grid.select("county", F.col("sect").alias("section"), "twp", "rng", F.col("ns").alias("_ns"), F.col("ew").alias("_ew")).distinct()
    met = rows.join(choices, ["county", "section", "twp", "rng"]).where("(ns is null or ns = _ns) and (ew is null or ew = _ew)")
    n = F.count("*").over(Window.partitionBy("stem"))
    return met.withColumn("_n", n).where("_n = 1").withColumns({"ns": F.col("_ns"), "ew": F.col("_ew")}).drop("_n", "_ns", "_ew")


def like_any(county: Column, patterns: Column) -> Column:
    return F.exists(patterns, lambda p: F.like(F.lower(county), F.lower(p)))
