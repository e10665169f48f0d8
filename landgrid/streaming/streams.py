"""Structured Streaming forms of the incremental paths."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from landgrid.operators.status import newest
from landgrid.session import shared_dir

#: What each kind of event makes of a record's stage.
EVENT_STATUS = {"signup": "pending", "view": "done", "click": "done", "purchase": "skipped", "error": "failed"}


def status_events(events: DataFrame) -> DataFrame:
    """key, status, version of an event table or stream."""
    status = F.lit("pending")
    for kind, s in EVENT_STATUS.items():
        status = F.when(F.col("event_type") == kind, s).otherwise(status)
    return events.select(F.col("user_id").alias("key"), status.alias("status"), F.col("event_id").alias("version"), F.col("ts").cast("timestamp").alias("ts"))


def stream(spark: SparkSession, path: str, files_per_trigger: int = 1) -> DataFrame:
    """A folder of Parquet, or one file, as a stream with the schema of what it holds."""
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    reader = spark.readStream.schema(spark.read.parquet(path).schema).option("maxFilesPerTrigger", files_per_trigger)
    if place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).getFileStatus(place).isDirectory():
        return reader.parquet(path)
    return reader.option("pathGlobFilter", place.getName()).parquet(place.getParent().toString())


def upsert(log: DataFrame, read: Callable[[], DataFrame | None], write: Callable[[DataFrame, int], None], checkpoint: str) -> StreamingQuery:
    """Newest-wins upsert by micro-batch: each batch is reduced, then met with the store; a replayed batch changes nothing."""

    def merge(batch: DataFrame, epoch: int) -> None:
        rows = newest(batch.drop("ts"), ["key"], "version")
        store = read()
        write(rows if store is None else newest(store.unionByName(rows), ["key"], "version"), epoch)

    return log.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def latest(log: DataFrame) -> DataFrame:
    """The latest status by key as a running aggregation, for update or complete mode."""
    return log.groupBy("key").agg(F.max(F.struct("version", "status")).alias("b")).select("key", F.col("b.status").alias("status"), F.col("b.version").alias("version"))


def deduplicated(log: DataFrame, delay: str = "1 hour") -> DataFrame:
    """Each attempt once, however often it is delivered within the delay."""
    return log.withWatermark("ts", delay).dropDuplicatesWithinWatermark(["key", "version"])


def distinct(log: DataFrame) -> DataFrame:
    """Each attempt once, however late and in whatever file it comes; the state holds every attempt, so for finite streams."""
    return log.dropDuplicates(["key", "version"])


def hourly(log: DataFrame, delay: str = "1 hour") -> DataFrame:
    """Counts by status in windows of event time; late rows beyond the delay are left out."""
    return log.withWatermark("ts", delay).groupBy(F.window("ts", "1 hour"), "status").agg(F.count("*").alias("n"))


FSM_SCHEMA = "key long, transitions long, status string, terminal boolean"
_ORDER = {"pending": 0, "failed": 1, "skipped": 2, "done": 2}


def _life(events: dict[int, str]) -> tuple[int, str, dict[int, str]]:
    """Transitions, status and the events up to the first terminal one, all that later-coming events can still change."""
    n, status, kept = 0, "pending", {}
    for v in sorted(events):
        kept[v] = events[v]
        if events[v] != status:
            n, status = n + 1, events[v]
        if _ORDER[status] == 2:
            break
    return n, status, kept


def _advance(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
    """A record's life in order of version, whatever the order of arrival: it never leaves a terminal status; failed may be retried."""
    n, status, events = _life(dict(zip(*state.get)) if state.exists else {})
    for pdf in batches:
        for v, s in zip(pdf["version"], pdf["status"]):
            events[int(v)] = min(s, events.get(int(v), s))
        n, status, events = _life(events)
    state.update((list(events), list(events.values())))
    yield pd.DataFrame({"key": [key[0]], "transitions": [n], "status": [status], "terminal": [_ORDER[status] == 2]})


def lifecycle(log: DataFrame) -> DataFrame:
    """Record state machines over a stream; one row for each record that a batch touches, the last one counts."""
    return log.groupBy("key").applyInPandasWithState(_advance, FSM_SCHEMA, "versions array<long>, statuses array<string>", "update", GroupStateTimeout.NoTimeout)


def settled(updates: DataFrame, keys: list[str]) -> DataFrame:
    """Run a finite stream in update mode and return the last row of each key."""
    spark = updates.sparkSession
    path = f"{shared_dir(spark)}/landgrid/updates-{uuid.uuid4().hex}"

    def keep(batch: DataFrame, epoch: int) -> None:
        batch.withColumn("_epoch", F.lit(epoch).cast("long")).write.mode("overwrite").parquet(f"{path}/batch{epoch}")

    empty = spark.createDataFrame([], updates.schema).withColumn("_epoch", F.lit(-1).cast("long"))
    empty.write.parquet(f"{path}/none")
    updates.writeStream.foreachBatch(keep).outputMode("update").trigger(availableNow=True).start().awaitTermination()
    rows = spark.read.schema(empty.schema).parquet(f"{path}/*")
    return newest(rows, keys, "_epoch").drop("_epoch")


def apply_corrections(changes: DataFrame, apply: Callable[[DataFrame, int], None], checkpoint: str) -> StreamingQuery:
    """Corrections as they come, each once: the highest issue of a batch wins for its field."""

    def run(batch: DataFrame, epoch: int) -> None:
        apply(newest(batch, ["stem", "field"], "issue"), epoch)

    return changes.writeStream.foreachBatch(run).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
