"""What the training-data operators share: table reading, word patterns, shared scratch tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from landgrid.session import release, scratch_mark, shared_dir, written

__all__ = ["WORD", "release", "scratch_mark", "shared_dir", "table", "written"]

#: A word of the contracts that split at ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table of the data folder, by Spark's reader alone, so that any store works."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
