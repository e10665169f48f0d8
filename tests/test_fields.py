"""Field functions against literal cases and a plain Python model."""

import itertools

import pytest
from pyspark.sql import functions as F

from landgrid.functions import fields, geometry


def values(spark, rows, f):
    """f of each value, in order."""
    df = spark.createDataFrame([(i, r) for i, r in enumerate(rows)], "i int, x string")
    return [r.y for r in df.select("i", f(F.col("x")).alias("y")).orderBy("i").collect()]


@pytest.mark.parametrize(
    "f,cases",
    [
        (fields.norm_section, {"36": "36", "S 12": "12", "T7.0": "7", "0": None, "37": None, "x": None, "": None, None: None}),
        (fields.norm_township, {"T 25 n": "25N", "05N": "05N", "25.0": "25", "S": None, "100N": None, None: None}),
        (fields.norm_county, {"garfield county": "Garfield County", "N/A": None, "---": None, "Le Flore.,": "Le Flore", None: None}),
        (fields.norm_quadrant, {"ne nw_se": "NE-NW-SE", "NE-NW": None, "NE-NW-XX": None, None: None}),
        (fields.error_kind, {"HTTP 503": "api_error", "boom": "exception", "": "unknown", None: "unknown", "no_change": "not_detected", "keyword_not_found": "keyword_not_found"}),
        (fields.well_name, {"35_A B 1_9": "A B 1", "none": "none", "a_b": "a_b"}),
        (fields.lease_name, {"10503518_HUCKLEBERRY 2_1613736": "HUCKLEBERRY", "X_LEDBETTER AND TERRELL 56_1679383": "LEDBETTER AND TERRELL", "bad": None}),
        (fields.decade, {"1911": "1910s", "x": None}),
        (fields.slug, {"a b--c ": "a_b_c", "Collection (3)": "Collection_3"}),
        (lambda x: fields.direction_or(x, "NS", "N"), {"12": "N", "5S": "S", "x": None}),
        (fields.coordinate, {"181": None, "-97.5": -97.5, "a": None}),
        (fields.api_county, {"35003": "Alfalfa", "35001x": "Adair", "35002": None, "35155": None, "35153": "Woodward"}),
    ],
)
def test_cases(spark, f, cases):
    assert values(spark, list(cases), f) == list(cases.values())


def test_quadrants_round_trip(spark):
    bits = {"NW": (0, 0), "NE": (0, 1), "SW": (1, 0), "SE": (1, 1)}
    got = {r.label: (r.row, r.col) for r in geometry.quadrants(spark).collect()}
    want = {}
    for parts in itertools.product(bits, repeat=3):
        want["-".join(parts)] = tuple(1 + sum(bits[p][axis] * (4 >> i) for i, p in enumerate(parts)) for axis in (0, 1))
    assert got == want
    assert values(spark, ["NE-SW-NW", "NW-NW-NW", "SE-SE-SE", "bad", "NE-NW"], lambda x: F.to_json(geometry.label_to_cell(x)))[:3] == ['{"row":3,"col":5}', '{"row":1,"col":1}', '{"row":8,"col":8}']


def test_printed_quadrants(spark):
    f = lambda x: F.concat_ws("|", fields.quadrant_of_text(x)["db_label"], fields.quadrant_of_text(x)["confidence"])
    assert values(spark, ["NW SW NE", "NE/SW/NW", "SW NE NW", "prose only", "SE-NW", None], f) == ["NE-SW-NW|85", "NW-SW-NE|93", "NW-NE-SW|85", "", "NW-SE|45", ""]


def test_latlon(spark):
    f = lambda x: F.concat_ws("|", fields.latlon(x)["method"], fields.latlon(x)["confidence"])
    texts = ["lat: 36.1234 lon: -97.5678", "Location: lat 36.1234 lon -97.5678", "36 30 15 N 97 45 30 W", "35.1234 -98.5678", "none", "lat 99.1234 lon -97.1234"]
    assert values(spark, texts, f) == ["labeled|95", "labeled|97", "dms|90", "unlabeled|75", "", ""]


def test_feet(spark):
    row = spark.range(1)
    at = lambda *a: row.select(geometry.feet_to_rel(*[F.lit(v).cast("double") if i < 4 else F.lit(v) for i, v in enumerate(a)]).alias("r")).first().r
    assert tuple(at(660, None, 660, None, "1/4 SEC")) == (0.25, 0.75)
    assert tuple(at(None, 330, None, 330, "1/4 SEC")) == (0.875, 0.125)
    assert tuple(at(2640, None, None, None, "SEC")) == (None, 0.5)


def test_geometry(spark):
    c = spark.range(1).select(geometry.cell_corners(F.lit(0.0), F.lit(36.0), F.lit(1.0), F.lit(37.0), F.lit(1), F.lit(1)).alias("c"), geometry.in_cell(F.lit(0.63), F.lit(0.3), F.lit(3), F.lit(5)).alias("r"))
    r = c.select("c", "r", geometry.interpolated("c", F.lit(0.5), F.lit(0.5)).alias("m")).first()
    assert (r.c.tl.lon, r.c.tl.lat, r.c.br.lon, r.c.br.lat) == (0.0, 37.0, 0.125, 36.875)
    assert (r.m.lat, r.m.lon) == (36.9375, 0.0625) and (r.r.x, r.r.y) == (0.5, 0.5)


def test_bounds(spark):
    df = spark.createDataFrame([(14, 5, "N", 9, "W"), (37, 5, "N", 9, "W"), (1, 99, "N", 9, "W"), (1, None, None, 9, None), (1, 9, "S", 9, "W"), (1, 5, "N", 27, "E")], "s int, t int, n string, r int, e string")
    assert [r[0].split(":")[0] for r in df.select(fields.bounds_reason("s", "t", "n", "r", "e")).collect()] == ["ok", "section_invalid", "township_N_too_high", "township_invalid", "township_S_too_high", "range_E_too_high"]


def test_fuzzy_county(spark):
    f = lambda x: F.concat_ws("|", fields.fuzzy_county(x)["county"], fields.fuzzy_county(x)["score"])
    assert values(spark, ["Alfalfa County", "in tulsa now", "Garfeild", "zz", "qqqqqq"], f) == ["Alfalfa|100", "Tulsa|95", "Garfield|75", "", ""]
