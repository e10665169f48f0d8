"""Sinks. Tables are versioned folders, so a reader never sees half a save; Spark's commit is the atomic step."""

from __future__ import annotations

import csv
import time

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from landgrid.functions.fields import classified
from landgrid.operators.status import STAGES, long_form, overlaid


def versions(spark: SparkSession, root: str) -> list[int]:
    """Versions of a store that were committed, in order."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(root)
    fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(path):
        return []
    sub = lambda p: spark.sparkContext._jvm.org.apache.hadoop.fs.Path(p.getPath(), "_SUCCESS")
    found = [p for p in fs.listStatus(path) if p.getPath().getName().startswith("v=") and fs.exists(sub(p))]
    return sorted(int(p.getPath().getName()[2:]) for p in found)


def read_store(spark: SparkSession, root: str, version: int | None = None) -> DataFrame | None:
    found = versions(spark, root)
    return spark.read.parquet(f"{root}/v={found[-1] if version is None else version}") if found else None


def _claimed(spark: SparkSession, root: str, version: int) -> bool:
    """Whether this writer is the first to claim a version: a file that can be created once."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{root}/_claims/{version}")
    fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    try:
        fs.create(path, False).close()
        return True
    except Py4JJavaError:
        if fs.exists(path):
            return False
        raise


def save_store(df: DataFrame, root: str, key: str = "stem", wait: float = 600.0) -> int:
    """Overlay changed rows on the last version and write the next; earlier versions stay as backups.

    A version is claimed before it is written. A writer that comes second waits until the first has
    committed and then overlays its rows on that; a claim that isn't committed within ``wait`` seconds
    is taken for a writer that died, and its version is passed over.
    """
    spark = df.sparkSession
    dead = -1
    while True:
        found = versions(spark, root)
        last = found[-1] if found else -1
        new = max(last, dead) + 1
        if _claimed(spark, root, new):
            break
        until = time.monotonic() + wait
        while new not in versions(spark, root) and time.monotonic() < until:
            time.sleep(min(0.2, wait))
        if new not in versions(spark, root):
            dead = new
    base = read_store(spark, root, last) if last >= 0 else None
    (df if base is None else overlaid(base, df, key)).write.parquet(f"{root}/v={new}")
    return new


def write_split(wide: DataFrame, root: str) -> None:
    """Success, review and failed records in one pass, by partition."""
    rows = classified(wide).withColumn("review_reasons", F.array_join("review_reasons", "; "))
    rows.write.mode("overwrite").partitionBy("final_status").option("header", "true").csv(root)


def write_failures(wide: DataFrame, root: str) -> None:
    """Failed stages, a folder for each stage, and the summary."""
    from landgrid.operators.reconcile import stage_failures

    long_form(wide, stages=STAGES).where("status = 'failed'").write.mode("overwrite").partitionBy("stage").option("header", "true").csv(f"{root}/failures")
    stage_failures(wide).coalesce(1).write.mode("overwrite").option("header", "true").csv(f"{root}/summary")


def features(placed: DataFrame, *properties: str) -> DataFrame:
    """GeoJSON features as text, one a row."""
    point = F.struct(F.lit("Point").alias("type"), F.array("lon", "lat").alias("coordinates"))
    return placed.where("lat is not null").select(F.to_json(F.struct(F.lit("Feature").alias("type"), point.alias("geometry"), F.struct("stem", *properties).alias("properties"))).alias("value"))


def write_geojson(placed: DataFrame, root: str, *properties: str) -> None:
    """Features as JSON lines in parallel, for readers that scale."""
    features(placed, *properties).write.mode("overwrite").text(root)


def write_collection(placed: DataFrame, path: str, *properties: str) -> int:
    """One FeatureCollection for map tools, written by the driver a partition at a time; returns the features."""
    n = 0
    with open(path, "w", encoding="utf-8") as out:
        out.write('{"type":"FeatureCollection","features":[')
        for row in features(placed, *properties).toLocalIterator():
            out.write((",\n" if n else "\n") + row["value"])
            n += 1
        out.write("\n]}\n")
    return n


def exports(coords: DataFrame, root: str) -> None:
    """The enrichment's outputs: dots, coordinates, failures and a log, each a projection of the resolved rows."""
    done = F.col("lat").isNotNull()
    write_csv(coords.where("dot_row is not null and dot_col is not null").select("stem", "dot_row", "dot_col", "x_norm", "y_norm"), f"{root}/dots")
    write_csv(coords.where(done).select("stem", "lat", "lon", "source"), f"{root}/latlong")
    write_csv(coords.where(~done).select("stem", F.col("source").alias("reason"), "flags"), f"{root}/failures")
    write_csv(coords.groupBy("source").agg(F.count("*").alias("n"), F.count_if(done).alias("resolved")), f"{root}/log")


def write_csv(df: DataFrame, root: str) -> None:
    """CSV with a header; null is ""; arrays are joined."""
    flat = df.select(*[F.array_join(c, "; ").alias(c) if t.startswith("array<string") else F.col(c) for c, t in df.dtypes])
    flat.write.mode("overwrite").option("header", "true").option("nullValue", "").option("emptyValue", "").csv(root)


def append(df: DataFrame, root: str) -> None:
    """Append-only logs: review queue, failed records, corrections, run history."""
    df.write.mode("append").json(root)


def excel_csv(df: DataFrame, path: str) -> int:
    """A worklist with a byte order mark for spreadsheets: every row, fetched a partition at a time; returns the rows."""
    n = 0
    with open(path, "w", encoding="utf-8-sig", newline="") as out:
        to = csv.writer(out)
        to.writerow(df.columns)
        for row in df.toLocalIterator():
            to.writerow(["" if v is None else v for v in row])
            n += 1
    return n
