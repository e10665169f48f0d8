"""The resolution cascade: records with survey fields to coordinates.

Rows: stem, section, twp, ns, rng, ew, county, dot_row, dot_col, x_norm, y_norm,
and optionally ocr_quad, unet_quad (labels), centroid (boolean: take the section's
centre), skipped (boolean: its location stage was skipped; only the fourth pass sees it,
where it has a dot of some dot_confidence). Grid: sect, twp, ns, rng, ew, quad, county, minx, miny, maxx, maxy.

Pass 1 is one equi-join a level: the grid is folded once to a map of at most four
directions for each (section, township, range[, quadrant]), and a row picks its
first hit from the map, so no candidate is ever a row and nothing is ranked over a
window. Pass 2 enumerates candidates only for the few rows that pass 1 misses.
Grid tables are joined without hints: Spark broadcasts them where their size allows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from landgrid.functions import fields, geometry
from landgrid.operators import mining
from landgrid.session import written

KEY3 = ["section", "twp", "rng"]
OUT = ["stem", "source", "lat", "lon", "flags", "county_verified"]
BOX = ("minx", "miny", "maxx", "maxy")


def by_direction(boxes: DataFrame, *more: str) -> DataFrame:
    """(section, twp, rng, ...) -> map from "NE".. to box and counties."""
    entry = F.struct(F.concat("ns", "ew").alias("k"), F.struct(*BOX, "counties").alias("v"))
    return boxes.withColumnRenamed("sect", "section").groupBy(*KEY3, *more).agg(F.map_from_entries(F.collect_list(entry)).alias("boxes"))


def grid_maps(grid: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Sections and cells by direction. A cell that the grid has twice takes the least box."""
    counties = grid.groupBy(*mining.STR).agg(F.array_sort(F.collect_set("county")).alias("counties"))
    sections = mining.section_boxes(grid).join(counties, mining.STR)
    cells = mining.cell_boxes(grid).withColumn("counties", F.array_compact(F.array("county")))
    return by_direction(sections), by_direction(cells, "quad").withColumnRenamed("boxes", "cells")


def constrained(rows: DataFrame, constraints: DataFrame) -> DataFrame:
    """Add ns_try and ew_try by the limits of each row's county (``mining.county_constraints``).

    A known direction is the only one. A county with one direction settles it; where it has both, a township within
    its limits is north, and a range keeps the directions that its number allows. A county is found by its name,
    else as the first in order of name that begins with the row's name or its first word; else both are tried.
    """
    limits = constraints.where("county is not null").select(
        fields.county_base("county").alias("_base"), "max_twp", "max_rng", F.col("ns_values").alias("_nv"), F.col("ew_values").alias("_ev")
    )
    limits = limits.groupBy("_base").agg(F.max("max_twp").alias("_mt"), F.max("max_rng").alias("_mr"), F.array_sort(F.array_distinct(F.flatten(F.collect_list("_nv")))).alias("_nv"), F.array_sort(F.array_distinct(F.flatten(F.collect_list("_ev")))).alias("_ev"))
    starts = limits.select("_base", F.explode(F.transform(F.sequence(F.lit(1), F.char_length("_base")), lambda n: F.substring(F.col("_base"), F.lit(1), n))).alias("_start"))
    starts = starts.groupBy("_start").agg(F.min("_base").alias("_hit"))
    names = rows.select("county").distinct().withColumn("_own", fields.county_base("county")).withColumn("_word", F.get(F.split("_own", r"\s+"), 0))
    by = lambda key, to: starts.select(F.col("_start").alias(key), F.col("_hit").alias(to))
    found = names.join(limits.select(F.col("_base").alias("_own"), F.col("_base").alias("_same")), "_own", "left").join(by("_own", "_longer"), "_own", "left").join(by("_word", "_first"), "_word", "left")
    found = found.select("county", F.coalesce("_same", "_longer", "_first").alias("_base")).where("county is not null").join(limits, "_base")
    met = rows.join(found.drop("_base"), "county", "left")
    both = lambda *v: F.array(*map(F.lit, v))
    fits = F.filter("_ev", lambda e: F.col("rng") <= F.when(e == "W", F.col("_mr")).otherwise(fields.RANGE_MAX["E"]))
    ns = F.when(F.col("ns").isNotNull(), F.array("ns")).when(F.col("_nv").isNull(), both("N", "S")).when(F.size("_nv") == 1, F.col("_nv"))
    ns = ns.when((F.col("twp") <= F.col("_mt")) & F.array_contains("_nv", "N"), both("N")).otherwise(F.col("_nv"))
    ew = F.when(F.col("ew").isNotNull(), F.array("ew")).when(F.col("_ev").isNull(), both("W", "E")).when(F.size("_ev") == 1, F.col("_ev"))
    ew = ew.when(F.col("rng").isNull() | (F.size(fits) == 0), F.col("_ev")).otherwise(fits)
    return met.withColumns({"ns_try": ns, "ew_try": ew}).select(*rows.columns, "ns_try", "ew_try")


def by_statistics(rows: DataFrame, stats: DataFrame | None) -> DataFrame:
    """Add ns_try and ew_try by the cells of each row's county (``mining.direction_stats``)."""
    key = fields.county_base("county")
    if stats is not None:
        known = stats.where("county is not null").select(fields.county_base("county").alias("_key"), "ns_order", "ew_order").dropDuplicates(["_key"])
        rows = rows.withColumn("_key", key).join(known, "_key", "left").drop("_key")
    else:
        rows = rows.withColumns({c: F.lit(None).cast("array<string>") for c in ("ns_order", "ew_order")})

    def tries(axis: str, default: tuple[str, str]) -> Column:
        d, order = F.col(axis), F.col(f"{axis}_order")
        other = (F.size(order) == 1) & (F.get(order, 0) != d)
        return F.when(d.isNull(), F.coalesce(order, F.array(*map(F.lit, default)))).when(F.coalesce(other, F.lit(False)), F.array(F.get(order, 0), d)).otherwise(F.array(d))

    return rows.withColumns({"ns_try": tries("ns", ("N", "S")), "ew_try": tries("ew", ("W", "E"))}).drop("ns_order", "ew_order")


def prepared(rows: DataFrame, stats: DataFrame | None, constraints: DataFrame | None = None) -> DataFrame:
    """Add ns_try, ew_try, reason, quad, cell and quadrant flags.

    By statistics, a direction that is known stays, after the county's own where all of the county
    lies the other way; an unknown one follows the county's cells, then N, S and W, E. Where
    ``constraints`` are given they decide alone.
    """
    rows = by_statistics(rows, stats) if constraints is None else constrained(rows, constraints)
    reason = fields.bounds_reason("section", "twp", F.get("ns_try", 0), "rng", F.get("ew_try", 0))
    null = F.lit(None).cast("string")
    ocr, unet = (F.col(c) if c in rows.columns else null for c in ("ocr_quad", "unet_quad"))
    valid = lambda q: F.when(geometry.label_to_cell(q).isNotNull(), q)
    expected = geometry.cell_to_label("dot_row", "dot_col")
    rows = rows.withColumns({"_ocr": valid(ocr), "_unet": valid(unet), "_rc": expected})
    quad = F.coalesce("_ocr", "_unet", "_rc")
    flags = F.array_compact(F.array(F.when(F.col("_ocr") != F.col("_unet"), "quadrant_mismatch"), F.when(F.col("_unet") != F.col("_rc"), "unet_nw_rc_mismatch")))
    parsed = F.col("dot_row").between(1, 8) & F.col("dot_col").between(1, 8)
    cell = F.coalesce(geometry.label_to_cell(quad), F.when(parsed, F.struct(F.col("dot_row").cast("int").alias("row"), F.col("dot_col").cast("int").alias("col"))))
    return rows.withColumns({"reason": F.when(F.coalesce(parsed, F.lit(False)), reason).otherwise("parse_failed"), "quad": quad, "cell": cell, "qflags": flags}).drop("_ocr", "_unet", "_rc")


def _combined(ns: Column, ew: Column) -> Column:
    return F.flatten(F.transform(ns, lambda n: F.transform(ew, lambda e: F.concat(n, e))))


def _pick(boxes: Column, keys: Column) -> Column:
    """struct(k, v) of the first key that the map has."""
    hits = F.filter(F.transform(keys, lambda k: F.struct(k.alias("k"), F.try_element_at(boxes, k).alias("v"))), lambda x: x["v"].isNotNull())
    return F.get(hits, 0)


def _finish(lat: Column, lon: Column) -> tuple[Column, Column, Column]:
    ok = fields.in_box(lat, lon, fields.RESOLVER_BOX)
    return ok, F.when(ok, F.round(lat, 7)), F.when(ok, F.round(lon, 7))


def _sub_box(box: dict[str, Column], in_section: Column) -> dict[str, Column]:
    """The cell's part of a section's box where in_section holds, else the box itself."""
    row, column = F.col("cell.row"), F.col("cell.col")
    w, h = (box["maxx"] - box["minx"]) / geometry.GRID, (box["maxy"] - box["miny"]) / geometry.GRID
    part = {"minx": box["minx"] + (column - 1) * w, "miny": box["maxy"] - row * h, "maxx": box["minx"] + column * w, "maxy": box["maxy"] - (row - 1) * h}
    return {k: F.when(in_section, part[k]).otherwise(box[k]) for k in BOX}


def _located(df: DataFrame, box: dict[str, Column], in_section: Column) -> DataFrame:
    """Add _lat, _lon of the dot in its cell, and _ok: inside the state."""
    df = df.withColumns({f"_{k}": v for k, v in _sub_box(box, in_section).items()} | {"_rel": geometry.in_cell("x_norm", "y_norm", F.col("cell.row"), F.col("cell.col"))})
    lat = F.col("_maxy") - (F.col("_maxy") - F.col("_miny")) * F.col("_rel.y")
    lon = F.col("_minx") + (F.col("_maxx") - F.col("_minx")) * F.col("_rel.x")
    df = df.withColumns({"_lat": F.round(lat, 7), "_lon": F.round(lon, 7)}).drop(*[f"_{k}" for k in BOX], "_rel")
    return df.withColumn("_ok", fields.in_box(F.col("_lat"), F.col("_lon"), fields.RESOLVER_BOX))


def pass1(ready: DataFrame, sections: DataFrame, cells: DataFrame) -> DataFrame:
    """All rows with source, lat, lon, flags: quadrant_direct, a section strategy, rds_miss, or what their fields fail on."""
    whole = F.col("reason") == "ok"
    met = ready.where(whole).join(cells, [*KEY3, "quad"], "left").join(sections, KEY3, "left")
    met = met.unionByName(ready.where(~whole), allowMissingColumns=True)  # rows without a whole key never meet the grid
    tried = _combined(F.col("ns_try"), F.col("ew_try"))
    exact = F.when(F.col("ns").isNotNull() & F.col("ew").isNotNull(), F.array(F.concat("ns", "ew")))
    met = met.withColumns({"_cell": _pick(F.col("cells"), tried), "_exact": _pick(F.col("boxes"), exact), "_any": _pick(F.col("boxes"), tried)})
    strategy = (
        F.when(F.col("_exact").isNotNull(), "exact_county")
        .when(F.col("ns").isNotNull() & F.col("ew").isNotNull(), "county_constrained")
        .when(F.col("ns").isNotNull(), "ew_fallback")
        .when(F.col("ew").isNotNull(), "ns_fallback")
        .otherwise("ns_ew_fallback")
    )
    met = met.withColumn("_hit", F.coalesce("_cell", "_exact", "_any"))
    met = _located(met, {k: F.col(f"_hit.v.{k}") for k in BOX}, F.col("_cell").isNull())
    valid = F.col("reason") == "ok"
    hit = F.col("_hit").isNotNull()
    source = (
        F.when(F.col("reason") == "parse_failed", "parse_failed").when(~valid, "bounds_invalid").when(~hit, "rds_miss").when(~F.col("_ok"), "geometry_error").when(F.col("_cell").isNotNull(), "quadrant_direct").otherwise(strategy)
    )
    centred = F.when(F.col("x_norm").isNull() | F.col("y_norm").isNull(), "cell_centre_used")
    flags = F.concat("qflags", F.array_compact(F.array(F.when(~valid & (F.col("reason") != "parse_failed"), F.col("reason")), F.when(valid & hit, centred))))
    verified = F.exists(F.col("_hit.v.counties"), lambda c: F.exists(fields.county_variants("county"), lambda p: F.like(F.lower(c), F.lower(p))))
    done = valid & hit
    placed = done & F.col("_ok")
    result = {"source": source, "lat": F.when(placed, F.col("_lat")), "lon": F.when(placed, F.col("_lon")), "flags": flags, "county_verified": F.when(done, verified)}
    return met.withColumns(result).select(*ready.columns, *OUT[1:])


DELTAS = (-1, 1, -2, 2)


def pass2(misses: DataFrame, grid: DataFrame, stats: DataFrame | None) -> DataFrame:
    """Rows of rds_miss by exhaustive directions under their county: cell, section, then its neighbours."""

    def order(axis: str, default: tuple[str, str]) -> Column:
        rest = F.array(*map(F.lit, default))
        return F.when(F.col(axis).isNotNull(), F.array(axis)).otherwise(F.array_union(F.col(f"{axis}_try"), rest))

    rows = misses.select("stem", *KEY3, "ns", "ew", "county", "quad", "cell", "x_norm", "y_norm", order("ns", ("N", "S")).alias("_n"), order("ew", ("W", "E")).alias("_e"))
    rows = rows.select("*", F.posexplode(_combined(F.col("_n"), F.col("_e"))).alias("_i", "_d")).drop("_n", "_e")
    rows = rows.withColumns({"ns": F.substring("_d", 1, 1), "ew": F.substring("_d", 2, 1)})
    rows = rows.where(fields.bounds_reason("section", "twp", "ns", "rng", "ew") == "ok")
    like = mining.like_any(F.col("g_county"), fields.county_variants("county"))
    own_cells = grid.select(*mining.STR, "quad", F.col("county").alias("g_county"), *BOX)
    in_cell = rows.join(own_cells, [rows[a] == own_cells[b] for a, b in (("section", "sect"), ("twp", "twp"), ("rng", "rng"), ("ns", "ns"), ("ew", "ew"), ("quad", "quad"))]).where(like)
    in_cell = in_cell.select("stem", F.col("_i").alias("rank"), F.concat(F.lit("direction_inferred_p2_"), "_d").alias("source"), *BOX, "x_norm", "y_norm", "cell", F.lit(False).alias("_sec"))
    steps = F.array(F.struct(F.lit(0).alias("delta"), F.lit(100).alias("base")), *[F.struct(F.lit(d).alias("delta"), F.lit(200 + i).alias("base")) for i, d in enumerate(DELTAS)])
    near = rows.select("*", F.inline(steps)).withColumn("_s", F.col("section") + F.col("delta")).where(F.col("_s").between(fields.SECTION_MIN, fields.SECTION_MAX))
    boxes = mining.section_boxes(grid, "county").withColumnRenamed("county", "g_county")
    keyed = near.join(boxes, [near[a] == boxes[b] for a, b in (("_s", "sect"), ("twp", "twp"), ("rng", "rng"), ("ns", "ns"), ("ew", "ew"))]).where(like)
    rank = F.when(F.col("delta") == 0, F.col("base") + F.col("_i")).otherwise(200 + F.col("_i") * 4 + F.col("base") - 200)
    label = F.when(F.col("delta") == 0, F.concat(F.lit("direction_inferred_p2_"), "_d")).otherwise(F.concat(F.lit("sect_adj_p2_"), F.col("_s").cast("string"), F.lit("_"), "_d"))
    met = keyed.select("stem", rank.alias("rank"), label.alias("source"), *BOX, "x_norm", "y_norm", "cell")
    met = met.groupBy("stem", "rank", "source", "x_norm", "y_norm", "cell").agg(*[(F.min if c.startswith("min") else F.max)(c).alias(c) for c in BOX])
    in_section = met.select("stem", "rank", "source", *BOX, "x_norm", "y_norm", "cell", F.lit(True).alias("_sec"))
    found = _located(in_cell.unionByName(in_section), {k: F.col(k) for k in BOX}, F.col("_sec"))
    first = found.where("_ok").groupBy("stem").agg(F.min(F.struct("rank", "source", F.col("_lat").alias("lat"), F.col("_lon").alias("lon"))).alias("b"))
    return first.select("stem", "b.source", "b.lat", "b.lon")


def pass3(invalid: DataFrame, grid: DataFrame) -> DataFrame:
    """Rows without township (or range): filled where the grid of their county leaves one dominant value; stem, twp, ns, rng, ew, missing."""
    ok = F.col("section").between(fields.SECTION_MIN, fields.SECTION_MAX)
    cases = []
    for missing, (value, vdir), (known, kdir) in (("twp", ("twp", "ns"), ("rng", "ew")), ("rng", ("rng", "ew"), ("twp", "ns"))):
        rows = invalid.where(ok & F.col(missing).isNull() & F.col(known).isNotNull())
        counts = grid.groupBy("sect", known, kdir, "county", value, vdir).agg(F.count("*").alias("n")).select(
            F.col("sect").alias("section"), known, F.col(kdir).alias("_d"), F.col("county").alias("g_county"), F.col(value).alias("_v"), F.col(vdir).alias("_vd"), "n"
        )
        tried = rows.select("stem", "section", known, F.posexplode(f"{kdir}_try").alias("_i", "_d"), fields.county_variants("county").alias("_p"))
        tried = tried.select("stem", "section", known, "_i", "_d", F.posexplode("_p").alias("_j", "_pat"))
        met = tried.join(counts, ["section", known, "_d"]).where(F.like(F.lower("g_county"), F.lower("_pat")))
        met = met.groupBy("stem", "_i", "_j", "_pat", "_d", "_v", "_vd").agg(F.sum("n").alias("n"))
        alone = F.col("_pat") == "%"
        best = mining.dominant(met.where(~alone), ["stem", "_i", "_j"], ["_v", "_vd"]).unionByName(mining.dominant(met.where(alone), ["stem", "_i", "_j"], ["_v", "_vd"], factor=1 << 30))
        first = best.groupBy("stem").agg(F.min(F.struct("_i", "_j", "_d", "_v", "_vd")).alias("b"))
        filled = rows.select("stem", known).join(first, "stem").select(
            "stem", *(("b._v", "b._vd", known, "b._d") if missing == "twp" else (known, "b._d", "b._v", "b._vd"))
        ).toDF("stem", "twp", "ns", "rng", "ew")
        cases.append(filled.withColumn("missing", F.lit(missing)))
    return cases[0].unionByName(cases[1])


def refilled(rows: DataFrame, filled: DataFrame) -> DataFrame:
    """Rows with the survey fields that filled has for them."""
    own = [c for c in ("section", "twp", "ns", "rng", "ew") if c in filled.columns]
    new = filled.select("stem", *[F.col(c).alias(f"_{c}") for c in own], *[c for c in filled.columns if c in ("missing", "tags")])
    return rows.join(new, "stem").withColumns({c: F.coalesce(f"_{c}", c) for c in own}).drop(*[f"_{c}" for c in own])


def by_lease(rows: DataFrame, placed: DataFrame, section: bool = False) -> DataFrame:
    """Missing township and range (and section) of rows by what all placed rows of their lease and county agree on; stem, the
    fields, tags. A row goes unless all that it lacks is found, or where it lacks nothing."""
    packed = lambda n, d: F.concat(F.col(n).cast("string"), F.coalesce(d, F.lit("")))
    known = placed.where("lease is not null").withColumns({"_t": packed("twp", "ns"), "_r": packed("rng", "ew"), "_s": F.col("section").cast("string")})
    met = rows.join(mining.consensus(known, ["lease", "county"], ["_t", "_r", "_s"]), ["lease", "county"])
    part = lambda c, p: F.nullif(F.regexp_extract(c, p, 1), F.lit(""))
    needs = {"sect": (F.col("section").isNull() if section else F.lit(False), "_s"), "twp": (F.col("twp").isNull(), "_t"), "rng": (F.col("rng").isNull(), "_r")}
    for need, value in needs.values():
        met = met.where(~need | F.col(value).isNotNull())
    met = met.where(needs["sect"][0] | needs["twp"][0] | needs["rng"][0])
    tags = F.array_compact(F.array(*[F.when(need, F.concat(F.lit(f"p4_{k}_inferred:"), F.col(v))) for k, (need, v) in needs.items()]))
    lacks = lambda c, v: F.when(F.col(c).isNull(), v)
    return met.select(
        "stem",
        (lacks("section", F.col("_s").try_cast("int")) if section else F.lit(None).cast("int")).alias("section"),
        lacks("twp", part("_t", "^([0-9]+)").cast("int")).alias("twp"),
        lacks("twp", part("_t", "([NS])$")).alias("ns"),
        lacks("rng", part("_r", "^([0-9]+)").cast("int")).alias("rng"),
        lacks("rng", part("_r", "([EW])$")).alias("ew"),
        tags.alias("tags"),
    )


def centroids(ready: DataFrame, sections: DataFrame) -> DataFrame:
    """Pass 5: the centre of the section, by the same directions; stem, source, lat, lon, flags."""
    met = ready.join(sections, KEY3, "left").withColumn("_hit", _pick(F.col("boxes"), _combined(F.col("ns_try"), F.col("ew_try"))))
    ok, lat, lon = _finish((F.col("_hit.v.miny") + F.col("_hit.v.maxy")) / 2, (F.col("_hit.v.minx") + F.col("_hit.v.maxx")) / 2)
    survey_ok = fields.bounds_reason("section", "twp", F.get("ns_try", 0), "rng", F.get("ew_try", 0)) == "ok"
    hit = survey_ok & F.col("_hit").isNotNull() & ok
    flags = F.array(F.lit("approx_section_center"), F.concat(F.lit("direction:"), F.col("_hit.k")))
    return met.where(hit).select("stem", F.lit("section_centroid").alias("source"), lat.alias("lat"), lon.alias("lon"), flags.alias("flags"))


INPUT = ["stem", *KEY3, "ns", "ew", "county", "dot_row", "dot_col", "x_norm", "y_norm"]


def resolve(rows: DataFrame, grid: DataFrame, materialise=written, direction_source: str = "stats") -> DataFrame:
    """All passes: every row once, with source, lat, lon and flags; directions by "stats" or by "constraints" of the counties.

    ``materialise`` cuts the plan between passes: the fourth needs the results of
    the first three, and each pass is planned on tables with known sizes.
    """
    rows = rows.withColumn("lease", fields.lease_name("stem")) if "lease" not in rows.columns else rows
    stats = materialise(mining.direction_stats(grid), "direction_stats")
    limits = materialise(mining.county_constraints(grid), "constraints") if direction_source == "constraints" else None
    sections, cells = (materialise(g, n) for g, n in zip(grid_maps(grid), ("sections", "cells")))
    centroid = F.coalesce(F.col("centroid"), F.lit(False)) if "centroid" in rows.columns else F.lit(False)
    skipped = F.coalesce(F.col("skipped"), F.lit(False)) if "skipped" in rows.columns else F.lit(False)
    first = materialise(pass1(prepared(rows.where(~centroid & ~skipped), stats, limits), sections, cells), "pass1")
    result = lambda df, prefix="": df.select("stem", F.concat(F.lit(prefix), "source").alias("source"), "lat", "lon", "flags")
    done = first.where("lat is not null")
    second = materialise(pass2(first.where("source = 'rds_miss'"), grid, stats), "pass2").withColumn("flags", F.array(F.col("source")))
    invalid = first.where("source = 'bounds_invalid'").drop(*OUT[1:])
    base = rows.drop("centroid")
    filled = materialise(pass3(invalid, grid), "pass3")
    third = materialise(pass1(prepared(refilled(base, filled), stats, limits), sections, cells).where("lat is not null"), "pass3_placed")
    third = third.select("stem", F.concat(F.lit("p3_"), "missing", F.lit("_"), "source").alias("source"), "lat", "lon", "flags", "twp", "ns", "rng", "ew", "section", "lease", "county")
    keys = ["stem", "source", "lat", "lon", "flags", "twp", "ns", "rng", "ew", "section", "lease", "county"]
    two = second.join(base.select("stem", "twp", "ns", "rng", "ew", "section", "lease", "county"), "stem").select(keys)
    so_far = materialise(done.select(keys).unionByName(two).unionByName(third.select(keys)), "passes_1_to_3")
    waiting = base.join(invalid.select("stem"), "stem", "left_semi").join(so_far.select("stem"), "stem", "left_anti")
    asleep = rows.where(~centroid & skipped).drop("centroid")
    if "dot_confidence" in rows.columns:
        asleep = asleep.where("dot_row is not null and dot_col is not null and dot_confidence > 0")
    filled = materialise(by_lease(waiting, so_far).unionByName(by_lease(asleep, so_far, True)), "pass4")
    again = pass1(prepared(refilled(base, filled), stats, limits), sections, cells).where("lat is not null")
    fourth = materialise(again.select("stem", F.concat(F.lit("p4_"), "source").alias("source"), "lat", "lon", F.concat("tags", "flags").alias("flags")), "pass4_placed")
    fifth = centroids(prepared(rows.where(centroid).drop("centroid"), stats, limits), sections) if "centroid" in rows.columns else None
    placed = result(so_far).unionByName(fourth)
    if fifth is not None:
        placed = placed.unionByName(fifth)
    passed = rows.where(~centroid & skipped).select("stem", F.lit("skipped").alias("source"), F.lit(None).cast("double").alias("lat"), F.lit(None).cast("double").alias("lon"), F.array().cast("array<string>").alias("flags"))
    rest = result(first).unionByName(passed).join(placed.select("stem"), "stem", "left_anti")
    missed = rows.where(centroid).select("stem", F.lit("centroid_miss").alias("source"), F.lit(None).cast("double").alias("lat"), F.lit(None).cast("double").alias("lon"), F.array().cast("array<string>").alias("flags"))
    return placed.unionByName(rest).unionByName(missed.join(placed.select("stem"), "stem", "left_anti"))
