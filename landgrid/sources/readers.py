"""Readers: listings, CSV shards, JSON metadata, GeoJSON, archives, databases. All by Spark's own sources."""

from __future__ import annotations

import csv as python_csv
import io
import zipfile
from collections.abc import Iterator
from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from landgrid.functions.fields import collection_number, slug

INDEX = T.StructType(
    [T.StructField(n, t) for n, t in (
        ("stem", T.StringType()), ("path", T.StringType()), ("collection", T.StringType()), ("collection_num", T.IntegerType()), ("year", T.StringType()), ("month", T.StringType()),
        ("collection_safe", T.StringType()), ("month_safe", T.StringType()), ("file_size_bytes", T.LongType()), ("scan_timestamp", T.TimestampType()),
    )]
)
MAX_FIELD = 10_000


def files(spark: SparkSession, root: str, pattern: str = "*.pdf") -> DataFrame:
    """path, modificationTime, length of every file below root; contents are never read."""
    return spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", pattern).load(root).select("path", "modificationTime", "length")


def scan_collections(listed: DataFrame) -> DataFrame:
    """Records of ".../Collection (N)/year/month/stem.pdf" paths."""
    part = lambda i: F.regexp_extract("path", r"([^/]+)/([^/]+)/([^/]+)/([^/]+)\.[A-Za-z]+$", i)
    decoded = F.replace(F.col("path"), F.lit("%20"), F.lit(" "))
    rows = listed.withColumn("path", decoded).select(
        part(4).alias("stem"), "path", part(1).alias("collection"), collection_number(part(1)).alias("collection_num"), part(2).alias("year"), part(3).alias("month"), F.col("length").alias("file_size_bytes"), F.col("modificationTime").alias("scan_timestamp")
    )
    return rows.where("stem <> ''").withColumns({"collection_safe": slug("collection"), "month_safe": slug("month")})


def scan_flat(listed: DataFrame) -> DataFrame:
    """Records of any path; the collection number from any folder above."""
    return listed.select(
        F.regexp_extract("path", r"([^/]+)\.[A-Za-z]+$", 1).alias("stem"), "path", F.regexp_extract(F.replace(F.col("path"), F.lit("%20"), F.lit(" ")), r"/[^/]*\(([0-9]+)\)[^/]*/", 1).try_cast("int").alias("collection_num"), F.col("length").alias("file_size_bytes")
    )


def csv(spark: SparkSession, *paths: str, schema: T.StructType | str | None = None) -> DataFrame:
    """CSV with a header; blank is null, and rows with an oversized field go."""
    reader = spark.read.option("header", "true").option("mode", "PERMISSIVE").option("multiLine", "true").option("maxCharsPerColumn", "2000000").option("escape", '"')
    df = (reader.schema(schema) if schema else reader).csv(list(paths))
    texts = [c for c, t in df.dtypes if t == "string"]
    small: Column = F.forall(F.array(*[F.coalesce(F.length(c), F.lit(0)) for c in texts]), lambda n: n <= MAX_FIELD) if texts else F.lit(True)
    return df.where(small)


def scoped(df: DataFrame, stems: DataFrame, key: str = "stem") -> DataFrame:
    """Only the given keys; Spark broadcasts them where they are few."""
    return df.join(stems.select(key), key, "left_semi")


def by_header(spark: SparkSession, *globs: str) -> DataFrame:
    """CSV files united by the names in their headers, all columns text; a column that a file lacks is null there.

    Files of one header are one scan. Only each file's first line is read ahead. Unreadable and empty files go.
    """
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    groups: dict[tuple[str, ...], list[str]] = {}
    for glob in globs:
        path = jvm.org.apache.hadoop.fs.Path(glob)
        fs = path.getFileSystem(conf)
        for found in fs.globStatus(path) or []:
            for f in fs.listStatus(found.getPath()) if found.isDirectory() else [found]:
                at = f.getPath()
                if f.isDirectory() or at.getName().startswith(("_", ".")):
                    continue
                stream = fs.open(at)
                try:
                    line = jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(stream, "UTF-8")).readLine()
                finally:
                    stream.close()
                names = next(python_csv.reader([line.lstrip("\ufeff")])) if line else []
                if names:
                    groups.setdefault(tuple(names), []).append(at.toString())
    parts = []
    for names, paths in groups.items():
        schema = T.StructType([T.StructField(n, T.StringType()) for n in names])
        read = spark.read.option("header", "true").option("escape", '"').option("ignoreCorruptFiles", "true").option("ignoreMissingFiles", "true")
        df = read.schema(schema).csv(paths)
        parts.append(df.select("*", F.col("_metadata.file_modification_time").alias("_t"), F.col("_metadata.file_path").alias("_f")))
    if not parts:
        return spark.createDataFrame([], "_t timestamp, _f string")
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def base_and_shards(spark: SparkSession, *paths: str, key: str = "stem", schema: str) -> DataFrame:
    """Shards by time of their file, columns by name; a later file's row replaces an earlier one's."""
    wanted = T._parse_datatype_string(schema)
    df = by_header(spark, *paths)
    cast = [(F.col(f.name) if f.name in df.columns else F.lit(None)).try_cast(f.dataType).alias(f.name) for f in wanted.fields]
    df = df.select(*cast, "_t", "_f")
    rest = [f.name for f in wanted.fields if f.name != key]
    return df.groupBy(key).agg(F.max(F.struct("_t", "_f", *rest)).alias("b")).select(key, *[F.col(f"b.{c}").alias(c) for c in rest])


def slices(spark: SparkSession, glob: str) -> DataFrame:
    """All slice files one after the other, without deduplication; columns are united by name, unreadable files skipped."""
    return by_header(spark, glob).drop("_t", "_f")


def slice_plan(listed: DataFrame, size: int, prefix: str | None = None) -> DataFrame:
    """(n, slices): files of a listing, of one prefix where it is given, and the slices of ``size`` that hold them."""
    rows = listed.where(F.col("path").contains(prefix)) if prefix else listed
    return rows.agg(F.count("*").alias("n")).withColumn("slices", F.ceil(F.col("n") / size))


def text_layer(files_: DataFrame, extract, pages: bool = True) -> DataFrame:
    """(path, page, text) of documents by ``extract(bytes) -> list of page texts``: the boundary to a renderer; pages count from 1."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = [(path, i + 1, t) for path, content in zip(pdf["path"], pdf["content"]) for i, t in enumerate(extract(bytes(content)))]
            yield pd.DataFrame(rows, columns=["path", "page", "text"])

    out = files_.select("path", "content").mapInPandas(run, "path string, page int, text string")
    return out if pages else out.groupBy("path").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("page", "text"))), lambda p: p["text"]), "\n").alias("text"))


def history(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """JSON lines; lines that don't parse go."""
    return spark.read.schema(schema).option("mode", "DROPMALFORMED").json(path)


METADATA = "source struct<stem:string,collection:string,year:string>, stages map<string,struct<status:string,confidence:double,method:string,error:string>>"


def metadata(spark: SparkSession, root: str) -> DataFrame:
    """One row a record from nested metadata.json files."""
    df = spark.read.schema(METADATA).option("multiLine", "true").option("recursiveFileLookup", "true").option("pathGlobFilter", "metadata.json").json(root)
    stage = lambda s, f: F.try_element_at("stages", F.lit(s))[f].alias(f"{s}_{f}")
    return df.select("source.*", *[stage(s, f) for s in ("latlong", "grid", "location", "county", "dot") for f in ("status", "confidence", "method")])


#: The stages of a metadata.json and the fields read of each.
STRUCTURES = """source struct<pdf_stem:string,collection:string,year:string,month:string>, stages struct<
    grid:struct<detected:boolean,method:string,form_type:string,grid_zone:string,bbox:array<double>,page:int,anchor_phrase:string,confidence:double,
        str_zone:string,county_format_hint:string,str_strategy_hint:string,_elapsed:double>,
    location:struct<detected:boolean,section:string,township:string,range:string,confidence:double,raw_text:string,error:string,_elapsed:double>,
    county:struct<detected:boolean,name:string,method:string,fuzzy_score:double,_elapsed:double>,
    dot:struct<detected:boolean,row:int,col:int,x_norm:double,y_norm:double,threshold:double,confidence:double,_elapsed:double>>"""


def structures(spark: SparkSession, root: str, collection: str | None = None) -> DataFrame:
    """Form structures, 41 columns a record, from the metadata.json files below root, or below its folders "*_<collection>*".

    Blank and absent values are null; files that hold neither source nor stages, or no JSON, go. A box is read by its
    corners, or as corner, width and height where the last two do not exceed the first.
    """
    read = spark.read.schema(STRUCTURES).option("multiLine", "true").option("recursiveFileLookup", "true").option("pathGlobFilter", "metadata.json")
    df = read.json(f"{root}/*_{collection}*" if collection else root).where("source is not null or stages is not null")
    text = lambda c: F.nullif(F.trim(c), F.lit(""))
    grid, location, county, dot = (F.col(f"stages.{s}") for s in ("grid", "location", "county", "dot"))
    at = [F.get(grid["bbox"], i) for i in range(4)]
    side = lambda low, high: F.when(high - low > 0, high - low).otherwise(high)
    width, height = F.when(at[0].isNotNull(), side(at[0], at[2])), F.when(at[1].isNotNull(), side(at[1], at[3]))
    has = lambda c: text(c).isNotNull()
    seconds = lambda s: F.round(F.coalesce(s["_elapsed"], F.lit(0.0)), 1)
    columns = {c: text(F.col(f"source.{c}")) for c in ("pdf_stem", "collection", "year", "month")}
    columns |= {"grid_detected": grid["detected"], "grid_method": text(grid["method"])} | {c: text(grid[c]) for c in ("form_type", "grid_zone")}
    columns |= {"grid_x": at[0], "grid_y": at[1], "grid_w": width, "grid_h": height}
    columns |= {"grid_ar": F.when((width != 0) & (height != 0), F.round(width / height, 3)), "grid_page": grid["page"], "anchor_phrase": text(grid["anchor_phrase"]), "grid_confidence": grid["confidence"]}
    columns |= {c: text(grid[c]) for c in ("str_zone", "county_format_hint", "str_strategy_hint")}
    columns |= {"loc_detected": location["detected"]} | {f"has_{c}": has(location[c]) for c in ("section", "township", "range")}
    columns |= {"loc_confidence": location["confidence"], "loc_raw_len": F.coalesce(F.char_length(location["raw_text"]), F.lit(0)), "loc_error": text(location["error"])}
    columns |= {"county_detected": county["detected"], "county_name": text(county["name"]), "county_method": text(county["method"]), "county_score": county["fuzzy_score"]}
    columns |= {f"dot_{c}": dot[c] for c in ("detected", "row", "col", "x_norm", "y_norm", "threshold", "confidence")}
    columns |= {"grid_s": seconds(grid), "loc_s": seconds(location), "county_s": seconds(county), "dot_s": seconds(dot)}
    return df.select(*[v.alias(k) for k, v in columns.items()])


GEOJSON = "type string, features array<struct<type:string,geometry:struct<type:string,coordinates:array<double>>,properties:map<string,string>>>"


def geojson(spark: SparkSession, path: str) -> DataFrame:
    """stem, lon, lat and properties of each feature."""
    f = spark.read.schema(GEOJSON).option("multiLine", "true").json(path).select(F.explode("features").alias("f"))
    return f.select(F.try_element_at("f.properties", F.lit("stem")).alias("stem"), F.get("f.geometry.coordinates", 0).alias("lon"), F.get("f.geometry.coordinates", 1).alias("lat"), F.col("f.properties").alias("properties"))


def zip_members(spark: SparkSession, root: str, pattern: str = "*.zip") -> DataFrame:
    """Members of archives: archive, year, month, name, size (the last three parts of the inner path)."""
    raw = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", pattern).load(root).select("path", "content")

    def listed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = []
            for path, content in zip(pdf["path"], pdf["content"]):
                try:
                    for m in zipfile.ZipFile(io.BytesIO(content)).infolist():
                        parts = ["", "", *m.filename.split("/")][-3:]
                        if not m.is_dir():
                            rows.append((path, *parts, m.file_size))
                except zipfile.BadZipFile:
                    continue
            yield pd.DataFrame(rows, columns=["archive", "year", "month", "name", "size"])

    return raw.mapInPandas(listed, "archive string, year string, month string, name string, size long")


def grid_from_database(spark: SparkSession, url: str, table: str, low: int = 1, high: int = 36, parts: int = 36, **options: str) -> DataFrame:
    """The land grid over JDBC, read in parallel by section number."""
    return spark.read.format("jdbc").options(url=url, dbtable=table, partitionColumn="sect_num", lowerBound=str(low), upperBound=str(high), numPartitions=str(parts), **options).load()


def issues(spark: SparkSession, path: str) -> DataFrame:
    """Correction issues as JSON: number, title, author_association, body."""
    schema = "number long, title string, author_association string, body string, state string"
    return spark.read.schema(schema).json(path).select(F.col("number").alias("issue"), "title", F.col("author_association").alias("association"), "body", "state")
