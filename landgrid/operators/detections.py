"""Ranking of grid candidates, and the boundary to vision and language models.

Models are not built here: they come as functions over Arrow batches, or as a
table of their outputs, and everything about choosing between outputs is Spark.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Limits of a grid candidate, and of its width by era.
MOST_OF_IMAGE, LEAST_DENSITY, LEAST_SIDE = 0.92, 0.15, 50
ASPECT = (0.6, 1.7)
WIDTH_CAP = {"early": 565}
LEAST_CONTOUR, LEAST_RECT_SIDE = 2500, 10
#: Dot thresholds by era, and by default.
DOT_THRESHOLD = {"early": 0.52, "transition": 0.48, "mid": 0.35, "late": 0.28, "modern": 0.26}
DOT_DEFAULT, DOT_LEAST_AREA = 0.40, 8


def accepted(candidates: DataFrame) -> DataFrame:
    """Candidates (stem, page, detector, x, y, w, h, density, page_w, page_h, tier) within the limits."""
    cap = F.lit(None).cast("int")
    for era, width in WIDTH_CAP.items():
        cap = F.when(F.col("tier") == era, width).otherwise(cap)
    area = F.col("w") * F.col("h") / (F.col("page_w") * F.col("page_h"))
    return candidates.where(
        (F.col("w") >= LEAST_SIDE) & (F.col("h") >= LEAST_SIDE) & (F.col("w") / F.col("h")).between(*ASPECT) & (area < MOST_OF_IMAGE) & (F.col("density") >= LEAST_DENSITY) & (cap.isNull() | (F.col("w") <= cap))
    )


def best_grids(candidates: DataFrame) -> DataFrame:
    """One grid a record: the first page with a candidate, there the densest, then the smallest, then by detector."""
    order = [F.col("page"), F.desc("density"), F.col("w") * F.col("h"), F.col("detector")]
    ranked = accepted(candidates).withColumn("_n", F.row_number().over(Window.partitionBy("stem").orderBy(*order)))
    return ranked.where("_n = 1").withColumn("confidence", F.least(F.lit(100), F.floor(F.col("density") * 100).cast("int"))).drop("_n")


def line_grids(lines: DataFrame, least: int = 5, share: float = 0.08, degrees: float = 5.0) -> DataFrame:
    """Boxes from line segments (stem, page, x0, y0, x1, y1, page_w, page_h): five long lines or more each way."""
    dx, dy = F.abs(F.col("x1") - F.col("x0")), F.abs(F.col("y1") - F.col("y0"))
    angle = F.degrees(F.atan2(dy, dx))
    flat = (angle <= degrees) & (dx >= share * F.col("page_w"))
    upright = (angle >= 90 - degrees) & (dy >= share * F.col("page_h"))
    rows = lines.withColumns({"_h": flat, "_v": upright}).where("_h or _v").groupBy("stem", "page").agg(
        F.count_if("_h").alias("n_h"), F.count_if("_v").alias("n_v"), F.min(F.least("x0", "x1")).alias("x0"), F.min(F.least("y0", "y1")).alias("y0"), F.max(F.greatest("x0", "x1")).alias("x1"), F.max(F.greatest("y0", "y1")).alias("y1")
    )
    return rows.where((F.col("n_h") >= least) & (F.col("n_v") >= least))


def largest_quads(contours: DataFrame) -> DataFrame:
    """The largest contour of four to eight corners with sides over the least, of each page."""
    ok = contours.where(F.col("corners").between(4, 8) & (F.col("w") > LEAST_SIDE) & (F.col("h") > LEAST_SIDE))
    return ok.groupBy("stem", "page").agg(F.max_by(F.struct("x", "y", "w", "h"), F.col("w") * F.col("h")).alias("box"))


def rotated_grids(contours: DataFrame) -> DataFrame:
    """The box of each page's contour (stem, page, area, rect_w, rect_h, x, y, w, h) with the largest turned rectangle.

    rect_w and rect_h are the sides of the least rectangle at any angle, x to h the upright box. Small contours and thin
    rectangles don't count; of equal rectangles the one furthest up, then furthest left, is taken.
    """
    ok = contours.where((F.col("area") >= LEAST_CONTOUR) & (F.col("rect_w") > LEAST_RECT_SIDE) & (F.col("rect_h") > LEAST_RECT_SIDE))
    first = F.struct(F.col("rect_w") * F.col("rect_h"), -F.col("y"), -F.col("x"), F.col("w") * F.col("h"))
    return ok.groupBy("stem", "page").agg(F.max_by(F.struct("x", "y", "w", "h"), first).alias("box"))


def dots(peaks: DataFrame) -> DataFrame:
    """The strongest peak of each record (stem, tier, x, y, area, strength) that passes its era's threshold."""
    limit = F.lit(DOT_DEFAULT)
    for era, t in DOT_THRESHOLD.items():
        limit = F.when(F.col("tier") == era, t).otherwise(limit)
    ok = peaks.where((F.col("strength") >= limit) & (F.col("area") >= DOT_LEAST_AREA))
    return ok.groupBy("stem").agg(F.max(F.struct("strength", (-F.col("y")).alias("_y"), (-F.col("x")).alias("_x"))).alias("m")).select("stem", F.col("m.strength").alias("strength"), (-F.col("m._x")).alias("x"), (-F.col("m._y")).alias("y"))


def recognised(pages: DataFrame, cache: DataFrame, recognise: Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]], schema: str = "hash string, text string") -> DataFrame:
    """Recognition with a content-addressed cache: (hash, text) of pages that it lacks, to be appended.

    pages: (content binary). ``recognise`` maps batches of (hash, content) to the
    schema; only content that no row of the cache has a text for reaches it, once.
    """
    hashed = pages.select(F.sha2("content", 256).alias("hash"), "content")
    missing = hashed.join(cache.where("text is not null").select("hash"), "hash", "left_anti").dropDuplicates(["hash"])
    return missing.mapInPandas(recognise, schema).where("text <> ''")


def evicted(cache: DataFrame, days: int = 60, now: Column | None = None) -> DataFrame:
    """The cache without rows last used (used_at) longer ago than that, or at no known time."""
    return cache.where(F.col("used_at") >= (F.current_timestamp() if now is None else now) - F.make_interval(days=F.lit(days)))


def stub(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """A deterministic stand-in for a recogniser: content read as UTF-8."""
    for pdf in batches:
        yield pd.DataFrame({"hash": pdf["hash"], "text": [bytes(c).decode("utf-8", "replace") for c in pdf["content"]]})
