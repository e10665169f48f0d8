"""Quadrant codes, cell geometry and boxes as Column functions.

Three levels of halves name one of 8 x 8 cells of a section; labels run coarse to
fine, row 1 is north, column 1 is west.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from landgrid.functions.fields import col, group

GRID = 8
#: Fixed values: (row bit, column bit) of each half.
BITS = {"NW": (0, 0), "NE": (0, 1), "SW": (1, 0), "SE": (1, 1)}
SECTION_FEET, QUARTER_FEET, SIXTEENTH_FEET = 5280.0, 2640.0, 1320.0


def _bit(part: Column, axis: int) -> Column:
    return F.when(part.isin(*[k for k, v in BITS.items() if v[axis]]), 1).when(part.isin(*BITS), 0)


def label_to_cell(label) -> Column:
    """struct(row, col) of "NE-SW-NW"; null for anything else."""
    parts = F.split(col(label), "-")
    at = lambda axis: sum(((_bit(F.get(parts, i), axis) * (4 >> i)) for i in range(3)), F.lit(1))
    ok = (F.size(parts) == 3) & F.forall(parts, lambda p: p.isin(*BITS))
    return F.when(ok, F.struct(at(0).cast("int").alias("row"), at(1).cast("int").alias("col")))


def cell_to_label(row, column) -> Column:
    r, c = col(row).cast("int") - 1, col(column).cast("int") - 1
    names = F.array(*[F.lit(k) for k in BITS])
    part = lambda i: F.get(names, F.shiftright(r, 2 - i).bitwiseAND(1) * 2 + F.shiftright(c, 2 - i).bitwiseAND(1))
    ok = r.between(0, GRID - 1) & c.between(0, GRID - 1)
    return F.when(ok, F.concat_ws("-", *[part(i) for i in range(3)]))


def quadrants(spark: SparkSession) -> DataFrame:
    """The 64 cells as a table: label, row, col."""
    cells = spark.range(GRID * GRID).select((F.floor(F.col("id") / GRID) + 1).cast("int").alias("row"), (F.col("id") % GRID + 1).cast("int").alias("col"))
    return cells.withColumn("label", cell_to_label("row", "col"))


def notation(text) -> Column:
    """struct(type, label, row, col) of "C SW SW", "NW NE NW", "SW SW" or "SW", printed fine to coarse.

    Two levels leave four cells, of which the north-western is named.
    """
    t = F.upper(F.trim(col(text)))
    parts = F.filter(F.split(t, r"\s+"), lambda p: p.isin(*BITS))
    n, center = F.size(parts), t.rlike(r"^C\b")
    full = F.when(n >= 3, F.slice(parts, 1, 3)).when(n == 2, F.concat(F.array(F.lit("NW")), parts))
    label = F.array_join(F.reverse(full), "-")
    kind = F.when(center & (n > 0), "center").when(n >= 3, "three_level").when(n == 2, "two_level").when(n == 1, "one_level").otherwise("")
    cell = label_to_cell(label)
    return F.struct(kind.alias("type"), label.alias("label"), cell["row"].alias("row"), cell["col"].alias("col"))


def xy_to_cell(x, y) -> Column:
    """struct(row, col) of a position in a section, 0..1 from the north-west."""
    at = lambda v: F.greatest(F.lit(1), F.least(F.lit(GRID), F.floor(col(v) * GRID).cast("int") + 1))
    return F.when(col(x).isNotNull() & col(y).isNotNull(), F.struct(at(y).alias("row"), at(x).alias("col")))


def _point(lon: Column, lat: Column) -> Column:
    return F.struct(lon.alias("lon"), lat.alias("lat"))


def box_corners(minx, miny, maxx, maxy) -> Column:
    a, b, c, d = (col(v) for v in (minx, miny, maxx, maxy))
    return F.struct(_point(a, d).alias("tl"), _point(c, d).alias("tr"), _point(a, b).alias("bl"), _point(c, b).alias("br"))


def cell_corners(minx, miny, maxx, maxy, row, column) -> Column:
    """Corners of a cell of a section's box."""
    a, b, c, d, r, k = (col(v) for v in (minx, miny, maxx, maxy, row, column))
    w, h = (c - a) / GRID, (d - b) / GRID
    return box_corners(a + (k - 1) * w, d - r * h, a + k * w, d - (r - 1) * h)


def interpolated(corners, rel_x, rel_y) -> Column:
    """struct(lat, lon) of a position between four corners; 0 is north and west."""
    c, x, y = col(corners), col(rel_x), col(rel_y)
    mix = lambda f: (c["tl"][f] * (1 - x) + c["tr"][f] * x) * (1 - y) + (c["bl"][f] * (1 - x) + c["br"][f] * x) * y
    return F.struct(mix("lat").alias("lat"), mix("lon").alias("lon"))


def in_cell(x, y, row, column) -> Column:
    """struct(x, y) of a position within its cell; the centre where either falls outside it."""
    rx, ry = col(x) * GRID - (col(column) - 1), col(y) * GRID - (col(row) - 1)
    ok = F.coalesce(rx.between(0, 1) & ry.between(0, 1), F.lit(False))
    return F.struct(F.when(ok, rx).otherwise(0.5).alias("x"), F.when(ok, ry).otherwise(0.5).alias("y"))


def feet_to_rel(fsl, fnl, fwl, fel, reference) -> Column:
    """struct(x, y) in the referenced subdivision from feet off its lines; west and south lines first."""
    r = F.lower(F.coalesce(col(reference), F.lit("")))
    unit = F.when(r.contains("1/16"), SIXTEENTH_FEET).when(r.contains("1/4"), QUARTER_FEET).otherwise(SECTION_FEET)
    clamp = lambda v: F.when(v.isNotNull(), F.greatest(F.lit(0.0), F.least(F.lit(1.0), v)))
    x = F.coalesce(col(fwl) / unit, 1 - col(fel) / unit)
    y = F.coalesce(1 - col(fsl) / unit, col(fnl) / unit)
    return F.struct(clamp(x).alias("x"), clamp(y).alias("y"))


# --- boxes on pages ----------------------------------------------------------


def overlap(a0, a1, b0, b1) -> Column:
    """Shared part of two spans over the shorter; 0 where one has no length."""
    shared = F.greatest(F.lit(0.0), F.least(col(a1), col(b1)) - F.greatest(col(a0), col(b0)))
    least = F.least(col(a1) - col(a0), col(b1) - col(b0))
    return F.when(least > 0, shared / least).otherwise(0.0)


def center_in(x0, y0, x1, y1, box: tuple) -> Column:
    cx, cy = (col(x0) + col(x1)) / 2, (col(y0) + col(y1)) / 2
    return cx.between(box[0], box[2]) & cy.between(box[1], box[3])


def union_box(*boxes: Column) -> Column:
    """The least box around structs x0, y0, x1, y1."""
    span = lambda f, pick: pick(*[b[f] for b in boxes])
    return F.struct(span("x0", F.least).alias("x0"), span("y0", F.least).alias("y0"), span("x1", F.greatest).alias("x1"), span("y1", F.greatest).alias("y1"))


def zone(cx, cy) -> Column:
    """Where on a page, in shares of its size, a grid's centre lies."""
    x, y = col(cx), col(cy)
    low = F.when(x < 0.45, "bottom_left").otherwise("unknown")
    high = F.when(x < 0.30, "top_left").when(x > 0.58, "top_right").otherwise("top_center")
    return F.when(x.isNull() | y.isNull(), "unknown").when(y > 0.50, low).otherwise(high)


#: What each kind of form means for later stages: where the survey fields stand, how the county is written, what reads them.
FORMS = {
    "T1_LARGE": ("top_header", "name_county", "horizontal_group"),
    "T2_MED": ("right_of_grid", "name_county", "horizontal_group"),
    "T3_SMALL": ("upper_right", "any", "horizontal_group"),
    "T4_NOANCHOR": ("upper_right", "any", "vertical_stack"),
    "MID": ("left_of_grid", "any", "horizontal_group"),
    "LATE": ("left_of_grid", "stacked", "vertical_stack"),
    "UNKNOWN": ("any", "any", "any"),
}
#: A grid narrower than this share of its height is upright.
UPRIGHT = 0.75


def form_kind(cx, cy, aspect, anchor, era) -> Column:
    """Kind of form: zone by zone, at top left by anchor phrase and shape, at top centre and right not in early collections."""
    z, a = zone(cx, cy), F.lower(F.coalesce(col(anchor), F.lit("")))
    upright = F.coalesce(col(aspect), F.lit(1.0)) < UPRIGHT
    named = a.contains("spot well") | a.contains("locate well correctly") | (a.contains("locate well") & ~upright)
    at_left = F.when(named, "T2_MED").when(a.contains("locate well"), "T3_SMALL").otherwise("T4_NOANCHOR")
    late = ~F.coalesce(col(era), F.lit("")).isin("early", "transition")
    return F.when(z == "bottom_left", "T1_LARGE").when(z == "top_left", at_left).when((z == "top_center") & late, "MID").when((z == "top_right") & late, "LATE").otherwise("UNKNOWN")


def form_hints(cx, cy, aspect, anchor, era) -> Column:
    """struct(form_type, grid_zone, str_zone, county_format, str_strategy)."""
    kind = form_kind(cx, cy, aspect, anchor, era)
    hint = lambda i: F.element_at(F.create_map(*[F.lit(x) for k, v in FORMS.items() for x in (k, v[i])]), kind)
    return F.struct(kind.alias("form_type"), zone(cx, cy).alias("grid_zone"), *[hint(i).alias(n) for i, n in enumerate(("str_zone", "county_format", "str_strategy"))])


def zone_region(name, page_w, page_h, gx=None, gy=None, gw=None, gh=None, pad: int = 40) -> Column:
    """struct(x0, y0, x1, y1) in which a zone of survey fields lies; null for the whole page. Without a grid, grid zones are page parts."""
    n, w, h = col(name), col(page_w), col(page_h)
    null = F.lit(None).cast("int")
    x, y, dx, dy = (null if v is None else col(v) for v in (gx, gy, gw, gh))
    whole = lambda v: F.floor(v).cast("int")
    grid = x.isNotNull() & y.isNotNull() & dx.isNotNull() & dy.isNotNull()
    top = F.when(grid, F.greatest(F.lit(0), y - dy - pad)).otherwise(0)
    bottom = F.when(grid, F.least(h, y + dy + pad)).otherwise(h)
    made = lambda a, b, c, d: F.struct(*[v.cast("int").alias(k) for k, v in zip(("x0", "y0", "x1", "y1"), (a, b, c, d))])
    zero = F.lit(0)
    right = F.when(grid & (dx > 0), F.greatest(zero, x + dx - pad)).otherwise(whole(w * 0.40))
    left = F.when(grid & (x > 0), F.least(w, x + pad)).otherwise(whole(w * 0.55))
    parts = {
        "top_header": (zero, zero, w, whole(h * 0.42)),
        "upper_right": (whole(w * 0.33), zero, w, whole(h * 0.42)),
        "vertical_right": (whole(w * 0.45), zero, w, h),
        "vertical_left": (zero, zero, whole(w * 0.55), h),
        "right_of_grid": (right, top, w, bottom),
        "left_of_grid": (zero, top, left, bottom),
    }
    out = F.lit(None).cast("struct<x0:int,y0:int,x1:int,y1:int>")
    for k, v in parts.items():
        out = F.when(n == k, made(*v)).otherwise(out)
    return out


def page_order(collection_num, n_pages) -> Column:
    """Pages from 1 in the order they are read: the third first in long files of collection 12."""
    pages = F.when(col(n_pages) >= 1, F.sequence(F.lit(1), col(n_pages))).otherwise(F.array().cast("array<int>"))
    third = (col(collection_num) == 12) & (col(n_pages) >= 4)
    return F.when(third, F.concat(F.array(F.lit(3)), F.array_remove(pages, 3))).otherwise(pages)


#: How far a crop reaches above, below and beside an anchor phrase, by era.
CROP = {"early": (700, 1100, 450), "transition": (700, 800, 400), "mid": (600, 600, 380), "late": (380, 30, 200), "modern": (350, 50, 250)}


def crop_around(anchor, era, page_w, page_h) -> Column:
    """struct(x0, y0, x1, y1) around an anchor's box, within the page; null without an anchor or where nothing is left."""
    a, tier_ = col(anchor), F.coalesce(col(era), F.lit("early"))
    reach = lambda i: F.element_at(F.create_map(*[F.lit(x) for k, v in CROP.items() for x in (k, v[i])]), tier_)
    x0, x1 = F.greatest(F.lit(0), a["x0"] - reach(2)), F.least(col(page_w), a["x1"] + reach(2))
    y0, y1 = F.greatest(F.lit(0), a["y0"] - reach(0)), F.least(col(page_h), a["y1"] + reach(1))
    return F.when((x1 > x0) & (y1 > y0), F.struct(*[v.cast("int").alias(n) for n, v in (("x0", x0), ("y0", y0), ("x1", x1), ("y1", y1))]))


def corners_box(corners, w, h, most: int = 700, least: int = 10, span: int = 50) -> Column:
    """The box around the corner points of a small crop; null where the crop is large, the corners are few or span too little."""
    c = col(corners)
    side = lambda f, pick: pick(F.transform(c, lambda p: p[f]))
    x0, x1, y0, y1 = side("x", F.array_min), side("x", F.array_max), side("y", F.array_min), side("y", F.array_max)
    ok = (col(w) <= most) & (col(h) <= most) & (F.size(c) >= least) & (x1 - x0 >= span) & (y1 - y0 >= span)
    return F.when(ok, F.struct(x0.alias("x0"), y0.alias("y0"), x1.alias("x1"), y1.alias("y1")))


def line_density(horizontal, vertical, w, h) -> Column:
    """Share of line pixels, twentyfold and at most 1; 0 for slivers."""
    return F.when((col(w) < 10) | (col(h) < 10), 0.0).otherwise(F.least(F.lit(1.0), (col(horizontal) + col(vertical)) * 20))


def suspect(cx, cy, x0, y0, x1, y1, pad: float = 0.04) -> Column:
    """Whether a centre lies outside its collection's envelope by more than twice the pad."""
    inside = col(cx).between(col(x0) - 2 * pad, col(x1) + 2 * pad) & col(cy).between(col(y0) - 2 * pad, col(y1) + 2 * pad)
    return ~inside


def envelope_region(x0, y0, x1, y1, width, height, pad: float = 0.04) -> Column:
    """A page-relative envelope, padded and clamped, in pixels."""
    low = lambda v: F.greatest(F.lit(0.0), col(v) - pad)
    high = lambda v: F.least(F.lit(1.0), col(v) + pad)
    return F.struct((low(x0) * col(width)).alias("x0"), (low(y0) * col(height)).alias("y0"), (high(x1) * col(width)).alias("x1"), (high(y1) * col(height)).alias("y1"))


def quadrant_group(x) -> Column:
    """First of the printed quadrants in a text, as its own group."""
    return group(F.upper(col(x)), r"\b([NS][EW])\b")
