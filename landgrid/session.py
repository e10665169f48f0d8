"""Spark session settings that the engine expects."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

#: Settings that results depend on or that every deployment wants. Sizes of
#: partitions are left to the cluster.
BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.serializer": "org.apache.spark.serializer.KryoSerializer",
}


def local_session(cores: int | None = None, app: str = "landgrid", memory: str = "6g") -> SparkSession:
    """A session for tests and the bench: one JVM, as many shuffle partitions as cores."""
    n = cores or int(os.environ.get("BENCH_CPUS", "8"))
    builder = SparkSession.builder.master(f"local[{n}]").appName(app)
    conf = BASE_CONF | {
        "spark.sql.shuffle.partitions": str(n),
        "spark.driver.memory": memory,
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.driver.host": "127.0.0.1",
    }
    spark = builder.config(map=conf).getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder that the driver and all executors share: ``spark.checkpoint.dir``, or the context's checkpoint folder.

    Where neither is set, a session on one machine gets a temporary folder; on a cluster that is an error.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        root = os.path.join(tempfile.gettempdir(), "landgrid-local")
    return root.rstrip("/")


_scratch: list[str] = []


def written(df: DataFrame, name: str, *partition_by: str) -> DataFrame:
    """Cut the lineage: df as Parquet in the shared folder, read back.

    Compressed columns take a fraction of the space that ``checkpoint()`` would
    take, survive the loss of executors, and can be read by column.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/landgrid/{name}-{uuid.uuid4().hex}"
    writer = df.write.option("compression", "zstd")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    _scratch.append(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._scratch = path
    return out


def is_scratch(df: DataFrame) -> bool:
    """Whether df is a scratch table that hasn't been deleted."""
    return getattr(df, "_scratch", None) in _scratch


def scratch_mark() -> int:
    """How many scratch tables there are, for ``release(since=...)``."""
    return len(_scratch)


def release(spark: SparkSession, since: int = 0, keep: tuple[DataFrame, ...] = ()) -> int:
    """Delete the scratch tables that this process wrote after ``since`` but those of ``keep``; returns how many. What reads them must have been stored."""
    hadoop = spark.sparkContext._jsc.hadoopConfiguration()
    kept = {df._scratch for df in keep}
    gone = [p for p in _scratch[since:] if p not in kept]
    _scratch[since:] = [p for p in _scratch[since:] if p in kept]
    n = 0
    for path in gone:
        at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        n += bool(at.getFileSystem(hadoop).delete(at, True))
    return n
