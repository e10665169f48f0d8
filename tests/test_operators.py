"""Operators that have no query of their own: stores, sources, detections, streams."""

import json
import random
import zipfile

import duckdb
import pytest
from pyspark.sql import functions as F

from landgrid.operators import detections, reconcile, reports, status, tokens
from landgrid.plans import catalog
from landgrid.sources import readers, writers
from landgrid.streaming import streams


def test_store_versions(spark, tmp_path):
    rows = lambda *x: spark.createDataFrame(list(x), "stem string, n int")
    root = str(tmp_path / "store")
    assert writers.read_store(spark, root) is None
    assert writers.save_store(rows(("a", 1), ("b", 1)), root) == 0
    assert writers.save_store(rows(("b", 2), ("c", 2)), root) == 1
    assert sorted(map(tuple, writers.read_store(spark, root).collect())) == [("a", 1), ("b", 2), ("c", 2)]
    assert writers.read_store(spark, root, 0).count() == 2


def test_collection_scan(spark, tmp_path):
    folder = tmp_path / "ExportedFolderContents (3)" / "1911" / "01 - January"
    folder.mkdir(parents=True)
    (folder / "35003_A 1_7.pdf").write_bytes(b"x" * 9)
    r = readers.scan_collections(readers.files(spark, str(tmp_path))).first()
    assert (r.stem, r.collection_num, r.year, r.month, r.file_size_bytes, r.month_safe) == ("35003_A 1_7", 3, "1911", "01 - January", 9, "01_January")
    assert readers.scan_flat(readers.files(spark, str(tmp_path))).first().collection_num == 3


def test_csv_and_shards(spark, tmp_path):
    a, b = tmp_path / "a.csv", tmp_path / "b.csv"
    a.write_text("stem,v\nx,1\ny,1\n")
    b.write_text("stem,v\ny,2\nz," + "9" * 10001 + "\n")
    assert readers.csv(spark, str(a), str(b)).count() == 3
    import os

    os.utime(a, (1, 1))
    got = readers.base_and_shards(spark, str(a), str(b), schema="stem string, v string").where("stem <> 'z'").collect()
    assert sorted(map(tuple, got)) == [("x", "1"), ("y", "2")]


def test_geojson_metadata_zip(spark, tmp_path):
    (tmp_path / "g.json").write_text(json.dumps({"type": "FeatureCollection", "features": [{"type": "Feature", "geometry": {"type": "Point", "coordinates": [-97.5, 35.5]}, "properties": {"stem": "s1"}}]}))
    assert tuple(readers.geojson(spark, str(tmp_path / "g.json")).select("stem", "lon", "lat").first()) == ("s1", -97.5, 35.5)
    (tmp_path / "m" / "s1").mkdir(parents=True)
    (tmp_path / "m" / "s1" / "metadata.json").write_text(json.dumps({"source": {"stem": "s1"}, "stages": {"grid": {"status": "done", "confidence": 88.0}}}))
    r = readers.metadata(spark, str(tmp_path / "m")).first()
    assert (r.stem, r.grid_status, r.grid_confidence, r.dot_status) == ("s1", "done", 88.0, None)
    with zipfile.ZipFile(tmp_path / "z.zip", "w") as z:
        z.writestr("top/1911/05/f.pdf", "abc")
    assert tuple(readers.zip_members(spark, str(tmp_path)).select("year", "month", "name", "size").first()) == ("1911", "05", "f.pdf", 3)


def test_sinks(spark, tmp_path):
    placed = spark.createDataFrame([("a", 35.0, -97.0, ["f", "g"]), ("b", None, None, [])], "stem string, lat double, lon double, flags array<string>")
    writers.write_geojson(placed, str(tmp_path / "g"))
    line = spark.read.text(str(tmp_path / "g")).first().value
    assert json.loads(line)["geometry"]["coordinates"] == [-97.0, 35.0]
    writers.write_csv(placed, str(tmp_path / "c"))
    assert spark.read.option("header", "true").csv(str(tmp_path / "c")).where("stem = 'a'").first().flags == "f; g"


def test_detections(spark):
    box = lambda stem, page, d, w, h, q: (stem, page, d, "mid", 0, 0, w, h, q, 1000, 1000)
    c = spark.createDataFrame(
        [box("a", 1, "otsu", 400, 400, 0.5), box("a", 1, "canny", 300, 300, 0.5), box("a", 1, "hough", 990, 990, 0.9), box("a", 0, "otsu", 10, 10, 0.9), box("b", 2, "otsu", 400, 400, 0.1)],
        "stem string, page int, detector string, tier string, x int, y int, w int, h int, density double, page_w int, page_h int",
    )
    assert [tuple(r) for r in detections.best_grids(c).select("stem", "detector", "confidence").collect()] == [("a", "canny", 50)]
    peaks = spark.createDataFrame([("a", "modern", 0.1, 0.2, 9, 0.3), ("a", "modern", 0.5, 0.5, 9, 0.27), ("b", "early", 0.1, 0.1, 9, 0.3)], "stem string, tier string, x double, y double, area int, strength double")
    assert [tuple(r) for r in detections.dots(peaks).collect()] == [("a", 0.3, 0.1, 0.2)]


def test_recognition_cache(spark):
    pages = spark.createDataFrame([(bytearray(b"one"),), (bytearray(b"one"),), (bytearray(b"two"),)], "content binary")
    first = detections.recognised(pages, spark.createDataFrame([], "hash string, text string"), detections.stub)
    assert sorted(r.text for r in first.collect()) == ["one", "two"]
    assert detections.recognised(pages, first, detections.stub).count() == 0


def test_upsert_stream_is_idempotent(spark, tmp_path):
    src, store = str(tmp_path / "src"), {}
    log = spark.createDataFrame([(1, "pending", 1), (1, "done", 3), (2, "failed", 2)], "key long, status string, version long").withColumn("ts", F.current_timestamp())
    log.coalesce(1).write.parquet(src)
    read = lambda: spark.createDataFrame(store["rows"], "key long, status string, version long") if store else None
    write = lambda df, epoch: store.update(rows=[tuple(r) for r in df.select("key", "status", "version").collect()])
    for i in range(2):
        streams.upsert(streams.stream(spark, src), read, write, str(tmp_path / f"c{i}")).awaitTermination()
    assert sorted(store["rows"]) == [(1, "done", 3), (2, "failed", 2)]


def test_streams_over_files_out_of_order(spark, tmp_path):
    """Several files that don't follow time, with repeats: the same results as the SQL over all rows."""
    rows = [(i, 1_700_000_000 + i * 1800, i % 7, ("signup", "error", "error", "signup", "view", "purchase")[(i * 5 + i // 7) % 6]) for i in range(120)]
    columns = "event_id long, s long, user_id long, event_type string"
    for name, part in (("c", rows[80:]), ("a", rows[40:80]), ("b", rows[:40] + rows[60:70])):
        df = spark.createDataFrame(part, columns).withColumn("ts", F.timestamp_seconds("s")).drop("s")
        df.coalesce(1).write.mode("append").parquet(str(tmp_path / "events.parquet"))
    con = duckdb.connect()
    con.sql(f"create view events as select distinct * from '{tmp_path}/events.parquet/*.parquet'")
    for name in ("q_stream_fsm", "q_stream_dedup", "q_stream_status"):
        want = con.sql(catalog.ORACLES[name])
        got = catalog.QUERIES[name](spark, str(tmp_path)).select(*want.columns)
        assert sorted(map(tuple, got.collect())) == sorted(want.fetchall()), name


def test_ladder_and_authorisation(spark):
    c = spark.createDataFrame([("d", 1, 1, "5", None, None), ("d", 2, 2, "7", "2N", None), ("d", 2, 1, None, "3N", None)], "doc_id string, page int, rank int, section string, township string, range string")
    r = tokens.ladder(c).first()
    assert (r.page, r.section, r.township, r.range, r.confidence) == (2, "7", "3N", None, 66)
    issues = spark.createDataFrame([("Correction: a", "OWNER"), ("correction: b", "NONE"), ("other", "OWNER")], "title string, association string")
    ok, rest = reconcile.authorised(issues)
    assert (ok.count(), rest.count()) == (1, 1)


def test_trend_and_markdown(spark):
    h = spark.createDataFrame([(i, "grid", "failed", "x", 10) for i in range(5)] + [(i, "grid", "done", None, 2) for i in range(5)], "run int, stage string, status string, error_type string, n int")
    r = reports.trend(h).first()
    assert (r.stage, r.runs, r.dominant_error) == ("grid", 5, "x")
    assert "| grid |" in reports.markdown(reports.trend(h), "T")


def test_split_is_a_partition(spark):
    from landgrid.plans.views import view

    rows = view(spark, "/root/testdata/sf0.001", "status")
    good, bad = status.split(rows)
    assert good.count() + bad.count() == rows.count() and not set(r.stem for r in good.collect()) & set(r.stem for r in bad.collect())


def test_csv_columns_are_united_by_name(spark, tmp_path):
    (tmp_path / "a.csv").write_text("stem,v,w\nx,1,2\n")
    (tmp_path / "b.csv").write_text('v,stem,z\n7,y,"9, or more"\n')
    (tmp_path / "empty.csv").write_text("")
    got = readers.slices(spark, str(tmp_path / "*.csv"))
    assert sorted(tuple(r[c] or "" for c in ("stem", "v", "w", "z")) for r in got.collect()) == [("x", "1", "2", ""), ("y", "7", "", "9, or more")]
    shards = readers.base_and_shards(spark, str(tmp_path / "a.csv"), str(tmp_path / "b.csv"), schema="stem string, v int, w string")
    assert sorted(tuple(r) for r in shards.fillna({"w": ""}).collect()) == [("x", 1, "2"), ("y", 7, "")]


def test_two_writers_lose_nothing(spark, tmp_path):
    from concurrent.futures import ThreadPoolExecutor

    root = str(tmp_path / "store")
    rows = lambda *x: spark.createDataFrame(list(x), "stem string, n int")
    writers.save_store(rows(("base", 0)), root)
    with ThreadPoolExecutor(3) as pool:
        saved = list(pool.map(lambda k: writers.save_store(rows((f"w{k}", k)), root), range(3)))
    assert sorted(saved) == [1, 2, 3]
    assert sorted(r.stem for r in writers.read_store(spark, root).collect()) == ["base", "w0", "w1", "w2"]


def test_a_dead_writer_is_passed_over(spark, tmp_path):
    root = str(tmp_path / "store")
    rows = lambda *x: spark.createDataFrame(list(x), "stem string, n int")
    assert writers.save_store(rows(("a", 1)), root) == 0
    assert writers._claimed(spark, root, 1) and not writers._claimed(spark, root, 1)
    assert writers.save_store(rows(("b", 2)), root, wait=0.1) == 2
    assert sorted(r.stem for r in writers.read_store(spark, root).collect()) == ["a", "b"]


def test_reports_keep_every_row(spark, tmp_path):
    df = spark.range(250).selectExpr("id", "concat('é|', id) as name")
    assert reports.markdown(df, "T").count("\n") == 254
    path = str(tmp_path / "w.csv")
    assert writers.excel_csv(df, path) == 250
    with open(path, "rb") as f:
        raw = f.read()
    assert raw.startswith(b"\xef\xbb\xbfid,name") and raw.count(b"\r\n") == 251
    policy = spark.createDataFrame([("grid", f"e{i}", "a") for i in range(1500)], "stage string, error_type string, action string")
    wide = spark.createDataFrame([("s", *["failed", 0, "e1499"] * 5)], "stem string, " + ", ".join(f"{s}_status string, {s}_confidence int, {s}_error_type string" for s in status.STAGES))
    assert {r.action for r in status.retry_plan(wide, policy).collect() if r.stage == "grid"} == {"a"}


def test_collection_and_exports(spark, tmp_path):
    placed = spark.createDataFrame([("a", 35.0, -97.0, 1, 2, 0.5, 0.5, "exact", ["f"]), ("b", None, None, None, None, None, None, "rds_miss", [])], "stem string, lat double, lon double, dot_row int, dot_col int, x_norm double, y_norm double, source string, flags array<string>")
    path = str(tmp_path / "map.json")
    assert writers.write_collection(placed, path) == 1
    with open(path) as f:
        assert [x["properties"]["stem"] for x in json.load(f)["features"]] == ["a"]
    writers.exports(placed, str(tmp_path / "out"))
    count = lambda name: spark.read.option("header", "true").csv(str(tmp_path / "out" / name)).count()
    assert (count("dots"), count("latlong"), count("failures"), count("log")) == (1, 1, 1, 2)


def test_slices_and_text_layer(spark, tmp_path):
    for i in range(7):
        (tmp_path / f"{i}.pdf").write_bytes(b"one\x0ctwo")
    listed = readers.files(spark, str(tmp_path))
    assert tuple(readers.slice_plan(listed, 3).first()) == (7, 3)
    raw = spark.read.format("binaryFile").load(str(tmp_path))
    pages = readers.text_layer(raw, lambda b: b.decode().split("\x0c"))
    assert pages.count() == 14 and {r.text for r in pages.where("page = 2").collect()} == {"two"}
    assert {r.text for r in readers.text_layer(raw, lambda b: b.decode().split("\x0c"), pages=False).collect()} == {"one\ntwo"}


def test_zones_crops_pages_and_corners(spark):
    from landgrid.functions import geometry

    one = lambda c: spark.range(1).select(c.alias("x")).first().x
    lit = F.lit
    grid = [lit(v) for v in (100, 300, 200, 150)]
    assert tuple(one(geometry.zone_region(lit("right_of_grid"), lit(1000), lit(800), *grid))) == (260, 110, 1000, 490)
    assert tuple(one(geometry.zone_region(lit("left_of_grid"), lit(1000), lit(800)))) == (0, 0, 550, 800)
    assert tuple(one(geometry.zone_region(lit("top_header"), lit(1000), lit(800)))) == (0, 0, 1000, 336)
    assert one(geometry.zone_region(lit("any"), lit(1000), lit(800))) is None
    assert one(geometry.page_order(lit(12), lit(5))) == [3, 1, 2, 4, 5] and one(geometry.page_order(lit(12), lit(3))) == [1, 2, 3] and one(geometry.page_order(lit(3), lit(4))) == [1, 2, 3, 4]
    box = F.struct(lit(500).alias("x0"), lit(500).alias("y0"), lit(600).alias("x1"), lit(520).alias("y1"))
    assert tuple(one(geometry.crop_around(box, lit("late"), lit(1000), lit(800)))) == (300, 120, 800, 550)
    points = F.transform(F.sequence(lit(0), lit(10)), lambda i: F.struct((i * 10).alias("x"), (i * 6).alias("y")))
    assert tuple(one(geometry.corners_box(points, lit(700), lit(700)))) == (0, 0, 100, 60)
    assert one(geometry.corners_box(points, lit(701), lit(700))) is None and one(geometry.corners_box(F.slice(points, 1, 9), lit(70), lit(70))) is None
    assert one(geometry.line_density(lit(0.01), lit(0.02), lit(50), lit(50))) == 0.6 and one(geometry.line_density(lit(0.1), lit(0.2), lit(9), lit(50))) == 0.0


def test_values_by_keyword_and_anchor(spark):
    words = "Section: 14 of it Twp. 5 N then RGE 9W County Garfield well".split()
    page = spark.createDataFrame([(1, 1, i, w, i * 60.0, 0.0, i * 60.0 + 50, 20.0) for i, w in enumerate(words)], "doc_id long, page int, pos int, t string, x0 double, y0 double, x1 double, y1 double")
    boxes = tokens.keyword_boxes(page)
    assert tuple(tokens.first_values(page, boxes).select("section", "township", "range").first()) == ("14", "5N", "9W")
    side = tokens.by_anchor(tokens.beside(page, "county", right=1))
    assert tuple(side.select("side", "county", "score").first()) == ("right", "Garfield", 100)


def test_no_join_by_page_alone(spark):
    """A page of many labels on many lines: labels meet tokens of their own lines only."""
    n = 6000
    page = spark.range(n).selectExpr("1 as doc_id", "1 as page", "id as pos", "case when id % 23 = 0 then 'Section:' when id % 29 = 0 then 'Twp.' when id % 31 = 0 then 'RGE' else 'w' end as t", "(id % 20) * 60.0 as x0", "(id div 20) * 40.0 as y0", "(id % 20) * 60.0 + 50 as x1", "(id div 20) * 40.0 + 20 as y1")
    assert tokens.beside(page, "rge").count() == sum(i % 31 == 0 and i % 23 and i % 29 != 0 for i in range(n))
    for df in (tokens.paired(tokens.keyword_boxes(page)), tokens.text_in(page, tokens.keyword_boxes(page)), tokens.value_below(page, "section")):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "_band" in plan and "Cartesian" not in plan and "NestedLoop" not in plan


def test_other_text_fields(spark):
    from landgrid.functions import fields

    one = lambda f, *t: spark.createDataFrame([t], ", ".join(f"c{i} string" for i in range(len(t)))).select(f(*[f"c{i}" for i in range(len(t))]).alias("x")).first().x
    assert tuple(one(fields.str_of_line, "14 T5N R9W")) == ("14", "5N", "9W") and one(fields.str_of_line, "5N 9").township is None
    assert tuple(one(fields.printed_latlon, "well at 35.123 by 97.456")) == (35.123, -97.456)
    assert tuple(one(fields.form_title, "Form No. 1002A\nOKLAHOMA CORPORATION\nWELL RECORD HERE")) == ("1002A", "WELL RECORD HERE")
    assert one(fields.modern_text, "SEC 14 T5N R9W", "35003_X 1_2").county == "Alfalfa"
    assert one(fields.text_signals, "Section 14 Township 5N Range 9W Garfield").free_win is True
    assert one(fields.text_scan, "Garfield County, NE NW\n" + "x " * 50).county_at_top is True
    rows = spark.createDataFrame([(" S 14", "T 5 n", "zz")], "section string, township string, county string")
    assert tuple(fields.norm_row(rows).first()) == ("14", "5N", "Zz")


def test_scratch_without_a_checkpoint_folder(tmp_path):
    """In a session that names no folder: a folder of this machine on this machine alone, and nothing is set."""
    import os
    import subprocess
    import sys

    (tmp_path / "conf").mkdir()
    code = """
from pyspark.sql import SparkSession
spark = SparkSession.builder.master("local[1]").config("spark.ui.enabled", "false").getOrCreate()
from landgrid.session import release, scratch_mark, shared_dir, written
assert not spark.conf.get("spark.checkpoint.dir", None)
a = written(spark.range(5).toDF("id"), "a")
mark = scratch_mark()
b = written(a, "b")
assert b.count() == 5 and release(spark, mark) == 1 and a.count() == 5 and release(spark) == 1
spark.sparkContext.setCheckpointDir(%r)
assert "checkpoints" in shared_dir(spark)
""" % str(tmp_path / "checkpoints")
    subprocess.run([sys.executable, "-c", code], check=True, cwd=os.path.dirname(os.path.dirname(os.path.abspath(__file__))), timeout=200, env=os.environ | {"SPARK_CONF_DIR": str(tmp_path / "conf")})


def test_counts_of_the_last_seconds_without_keys(spark):
    from landgrid.operators import sampling

    rows = [(i, (i * i * 7) % 400) for i in range(200)]
    df = spark.createDataFrame(rows, "id long, s long").withColumn("ts", F.timestamp_seconds("s"))
    got = {r.id: r.in_window for r in sampling.windowed_count(df, "ts", 5).collect()}
    assert got == {i: sum(t - 5 <= u <= t for _, u in rows) for i, t in rows}


@pytest.mark.parametrize("zone", ["UTC", "America/New_York"])
def test_rate_window_rounds_times_as_its_sql(spark, tmp_path, zone):
    """Halves of seconds at the window's edge, before 1970 too, no time, no user, a change of clocks: as the SQL counts them."""
    times = ["2024-01-01 00:00:00.5", "2024-01-01 01:00:00.5", "2024-01-01 01:00:01.499999", "2024-01-01 01:00:01.5", "1969-12-31 22:59:58.5", "1969-12-31 23:59:58.6", "2024-03-10 01:30:00", "2024-03-10 02:29:00", "2024-03-10 03:29:00", None, None]
    con = duckdb.connect()
    con.execute("create table events (event_id bigint, ts timestamp, user_id bigint)")
    con.executemany("insert into events values (?, ?, ?)", [(100 * u + i, t, u or None) for u in range(3) for i, t in enumerate(times[u:])])
    con.execute(f"copy events to '{tmp_path}/events.parquet' (format parquet)")
    want = dict(con.execute(catalog.ORACLES["q_rate_window"]).fetchall())
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        got = {r.event_id: r.in_window for r in catalog.QUERIES["q_rate_window"](spark, str(tmp_path)).collect()}
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    assert got == want and len(want) == 30


def test_str_extract_knows_edges_spaces_and_letters_as_its_sql(spark, tmp_path):
    """Words after letters with marks, the long s, the vertical tab and spaces of no ASCII, in texts put together at random."""
    rng = random.Random(5)
    parts = ["für", "ät", "R", "r", "T", "twp.", "town\u017fhip", "Range", "\u017fection", "a\u017fect", "Sec", "\u017fec", "of", "ħof", "N", "\u017f", "E", "w", "W\u0308", "_", "ä", "é", "12", "404", "7", "036", "5", "\u0663"]
    gaps = ["", " ", " ", " ", ". ", "-", "\n", "\x0b", "\x0c", "\xa0", "\u2028", "\x85", "\r"]
    texts = [None, "", "für 404 ", "T 5\u017f R 9w", *("".join(rng.choice(parts) + rng.choice(gaps) for _ in range(rng.randint(1, 14))) for _ in range(6000))]
    con = duckdb.connect()
    con.execute("create table documents (doc_id bigint, text varchar)")
    con.execute("insert into documents select unnest(?::bigint[]), unnest(?::varchar[])", [list(range(len(texts))), texts])
    con.execute(f"copy documents to '{tmp_path}/documents.parquet' (format parquet)")
    want = {r[0]: r[1:] for r in con.execute(catalog.ORACLES["q_str_extract"]).fetchall()}
    got = {r[0]: tuple(r[1:]) for r in catalog.QUERIES["q_str_extract"](spark, str(tmp_path)).collect()}
    assert {i: (got[i], want[i], texts[i]) for i in want if got[i] != want[i]} == {} and got.keys() == want.keys()


def test_corrections_place_anew(spark):
    """An override wins, half an override takes the row's other half, moved rows are resolved, the unplaced are marked."""
    rows = spark.createDataFrame(
        [(s, 1, 5, "N", 3, "W", "NE", "Kay", 35.0, -97.0, "exact_county") for s in "abcdefgh"] + [("i", 1, 5, "N", 3, "W", "NE", "Kay", None, None, None)],
        "stem string, section int, twp int, ns string, rng int, ew string, quad string, county string, lat double, lon double, resolution string",
    )
    log = [("a", "section", "9", 1), ("a", "section", "2", 2), ("b", "section", "99", 1), ("c", "county", "Alfalfa", 1), ("d", "section", "1", 1), ("e", "lat", "35.5", 1), ("e", "lon", "-97.5", 1)]
    log += [("e", "section", "2", 9), ("f", "lon", "-98.25", 1), ("g", "section", "two", 1), ("i", "lat", "35.5", 1)]
    seen = []

    def resolve(moved):
        seen.extend(r.stem for r in moved.collect())
        return moved.select("stem", F.when(F.col("section") <= 36, 36.0).alias("lat"), F.lit(-99.0).alias("lon"), F.lit("quadrant_direct").alias("source"))

    got = {r.stem: r for r in reconcile.reapplied(rows, spark.createDataFrame(log, "stem string, field string, new string, issue int"), resolve).collect()}
    assert sorted(seen) == ["a", "b"]
    view = {k: (r.section, r.lat, r.lon, r.resolution, r.note, r.corrected) for k, r in got.items()}
    assert view == {
        "a": (2, 36.0, -99.0, "quadrant_direct", "reresolved", True),
        "b": (99, 35.0, -97.0, "exact_county+needs-coord-rerun", "needs_rerun", True),
        "c": (1, 35.0, -97.0, "exact_county", "fields_updated", True),
        "d": (1, 35.0, -97.0, "exact_county", "no_change", False),
        "e": (2, 35.5, -97.5, "human_latlong", "human_latlong", True),
        "f": (1, 35.0, -98.25, "human_latlong", "human_latlong", True),
        "g": (1, 35.0, -97.0, "exact_county", "no_change", False),
        "h": (1, 35.0, -97.0, "exact_county", None, False),
        "i": (1, None, None, None, "latlong_incomplete", False),
    }
    assert got["c"].county == "Alfalfa"


def test_structures(spark, tmp_path):
    """41 columns; boxes of both conventions; blanks, other collections and broken files."""
    made = {
        "Box_3/s1": {"source": {"pdf_stem": "s1", "year": "1911"}, "stages": {"grid": {"detected": True, "bbox": [10, 20, 110, 70], "page": 1, "method": "", "_elapsed": 1.26}, "location": {"section": " 4 ", "range": " ", "raw_text": "abc"}, "dot": {"row": 3}}},
        "Box_3/s2": {"source": {"pdf_stem": "s2"}, "stages": {"grid": {"bbox": [300, 400, 100, 50]}, "county": None}},
        "Box_4/s3": {"source": {"pdf_stem": "s3"}},
    }
    for name, content in made.items():
        (tmp_path / name).mkdir(parents=True)
        (tmp_path / name / "metadata.json").write_text(json.dumps(content))
    (tmp_path / "Box_3" / "metadata.json").write_text('{"source": {"pdf_')
    df = readers.structures(spark, str(tmp_path))
    assert len(df.columns) == len(set(df.columns)) == 41
    got = {r.pdf_stem: r for r in df.collect()}
    assert sorted(got) == ["s1", "s2", "s3"]
    r = got["s1"]
    assert (r.grid_w, r.grid_h, r.grid_ar, r.grid_method, r.grid_s, r.has_section, r.has_range, r.loc_raw_len, r.dot_row, r.county_name) == (100, 50, 2.0, None, 1.3, True, False, 3, 3, None)
    assert (got["s2"].grid_x, got["s2"].grid_w, got["s2"].grid_h, got["s2"].grid_ar) == (300, 100, 50, 2.0)
    assert (got["s3"].grid_ar, got["s3"].loc_raw_len, got["s3"].dot_s) == (None, 0, 0.0)
    assert {r.pdf_stem for r in readers.structures(spark, str(tmp_path), "3").collect()} == {"s1", "s2"}


def test_rotated_grids_and_cache_age(spark):
    found = spark.createDataFrame(
        [("a", 1, 2400.0, 900.0, 900.0, 0, 0, 9, 9), ("a", 1, 2500.0, 100.0, 50.0, 5, 6, 110, 60), ("a", 1, 2600.0, 99.0, 50.0, 1, 1, 120, 70), ("a", 1, 9000.0, 900.0, 10.0, 2, 2, 900, 10), ("b", 1, 10.0, 99.0, 99.0, 0, 0, 9, 9)],
        "stem string, page int, area double, rect_w double, rect_h double, x int, y int, w int, h int",
    )
    assert [(r.stem, *r.box) for r in detections.rotated_grids(found).collect()] == [("a", 5, 6, 110, 60)]
    cache = spark.sql("select * from values ('a', timestamp'2024-03-01'), ('b', timestamp'2024-01-01'), ('c', timestamp'2023-12-31 23:59:59'), ('d', null) as t(hash, used_at)")
    assert sorted(r.hash for r in detections.evicted(cache, 60, F.lit("2024-03-01").cast("timestamp")).collect()) == ["a", "b"]
