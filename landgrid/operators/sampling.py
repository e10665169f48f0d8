"""Samples and work plans. Order in a group is that of a hash, so samples don't depend on partitions or runs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import TimestampNTZType

#: A hash that other engines can work out too: a linear step modulo a prime.
PRIME, STEP = 1000003, 7919


def order_key(key: str, seed: int = 13) -> Column:
    return F.pmod(F.col(key) * STEP + seed * 104729, F.lit(PRIME))


def _ranked(df: DataFrame, keys: list[str], key: str, seed: int) -> DataFrame:
    w = Window.partitionBy(*keys)
    return df.withColumn("_rank", F.row_number().over(w.orderBy(order_key(key, seed), key))).withColumn("_size", F.count("*").over(w))


def per_group_percent(df: DataFrame, keys: list[str], key: str, pct: int = 1, seed: int = 13) -> DataFrame:
    """A percentage of each group, one row at least."""
    quota = F.greatest(F.lit(1), F.expr(f"(_size * {pct} + 99) div 100"))
    return _ranked(df, keys, key, seed).where(F.col("_rank") <= quota).drop("_rank", "_size")


def per_group(df: DataFrame, keys: list[str], key: str, k: int, seed: int = 13) -> DataFrame:
    """k rows of each group."""
    return _ranked(df, keys, key, seed).where(F.col("_rank") <= k).drop("_rank", "_size")


def by_density(df: DataFrame, keys: list[str], key: str, density: int, seed: int = 13) -> DataFrame:
    """size div density rows of each group; one where the size is half of it or more; else none."""
    quota = F.greatest(F.expr(f"_size div {density}"), F.when(F.col("_size") >= density // 2, 1).otherwise(0))
    return _ranked(df, keys, key, seed).where(F.col("_rank") <= quota).drop("_rank", "_size")


def first_and_last(df: DataFrame, keys: list[str], name: str) -> DataFrame:
    """First and last name of each group and its size; one row where they are the same."""
    by = df.groupBy(*keys).agg(F.min(name).alias("first"), F.max(name).alias("last"), F.count("*").alias("total"))
    ends = F.when(F.col("first") == F.col("last"), F.array(F.struct(F.lit("first").alias("position"), F.col("first").alias(name)))).otherwise(
        F.array(F.struct(F.lit("first").alias("position"), F.col("first").alias(name)), F.struct(F.lit("last").alias("position"), F.col("last").alias(name)))
    )
    return by.select(*keys, "total", F.inline(ends))


def next_chunk(index: DataFrame, done: DataFrame, order: str, n: int, key: str = "stem") -> DataFrame:
    """The first n records in order that are not done: a top-n, never a sort of all."""
    return index.join(done.select(key), key, "left_anti").orderBy(order).limit(n)


def slice_of(df: DataFrame, key: str, n: int, i: int) -> DataFrame:
    """One of n slices by hash, without ranking all rows."""
    return df.where(F.pmod(F.xxhash64(key), F.lit(n)) == i)


def exact_slices(df: DataFrame, order: str, n: int) -> DataFrame:
    """Add slice: position in order modulo n.

    Positions come from counts of ranges of the order, so only their number is
    summed in one place, never the rows.
    """
    parts = df.repartitionByRange(F.col(order)).withColumn("_part", F.spark_partition_id())
    own = F.row_number().over(Window.partitionBy("_part").orderBy(order)) - 1
    before = parts.groupBy("_part").agg(F.count("*").alias("_n"))
    before = before.withColumn("_before", F.coalesce(F.sum("_n").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    return parts.withColumn("_own", own).join(before, "_part").withColumn("slice", F.pmod(F.col("_own") + F.col("_before"), F.lit(n))).drop("_part", "_own", "_n", "_before")


def in_campaign_order(df: DataFrame, column: str, order: list[str]) -> DataFrame:
    """Add priority: the place of a value in the user's order, after all others where it has none."""
    at = F.array_position(F.array(*map(F.lit, order)), F.col(column))
    return df.withColumn("priority", F.when(at > 0, at).otherwise(len(order) + 1))


def holdout(df: DataFrame, source: str, key: str, fraction: float = 0.1, only: tuple[str, ...] = ("anchor", "new"), seed: int = 13) -> DataFrame:
    """Add split: of each of the named sources a share, one row at least, is held out."""
    w = Window.partitionBy(source)
    ranked = df.withColumn("_r", F.row_number().over(w.orderBy(order_key(key, seed), key))).withColumn("_n", F.count("*").over(w))
    out = F.col(source).isin(*only) & (F.col("_r") <= F.greatest(F.lit(1), F.floor(F.col("_n") * fraction)))
    return ranked.withColumn("split", F.when(out, "holdout").otherwise("train")).drop("_r", "_n")


def whole_seconds(df: DataFrame, ts: str) -> Column:
    """Seconds since 1970 of a column of times, rounded as SQL casts a double to a whole number: halves to the even one."""
    if isinstance(df.select(ts).schema[0].dataType, TimestampNTZType):
        since = (F.col(ts) - F.lit("1970-01-01").cast("timestamp_ntz")).cast("interval second").cast("decimal(20, 6)")
        micros = (since * 1000000).cast("long")
    else:
        micros = F.unix_micros(F.col(ts).cast("timestamp"))
    return F.rint(micros / F.lit(1e6)).cast("long")


def windowed_count(events: DataFrame, ts: str, seconds: int = 60, *keys: str) -> DataFrame:
    """Add in_window: events of the last seconds, this one included, of the same keys; without keys, of all.

    Times are rounded to whole seconds, halves to the even one; those without a time zone are read as UTC, so no change
    of clocks moves them. Events without a time count one another. Work is dealt by stretch of time besides, so neither
    one key nor none puts all rows in a task: each event is seen in its own stretch and, as a helper, in the next.
    """
    at = whole_seconds(events, ts)
    stretch = F.floor(at / (16 * seconds))
    own, helper = F.struct(stretch.alias("s"), F.lit(True).alias("own")), F.struct((stretch + 1).alias("s"), F.lit(False).alias("own"))
    seen = F.explode(F.when(at.isNull(), F.array(own)).otherwise(F.array(own, helper)))
    rows = events.select(F.struct(*events.columns).alias("_row"), at.alias("_at"), *[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)], seen.alias("_x"))
    w = Window.partitionBy(*[f"_k{i}" for i in range(len(keys))], "_x.s").orderBy("_at").rangeBetween(-seconds, 0)
    return rows.withColumn("in_window", F.count("*").over(w)).where("_x.own").select("_row.*", "in_window")


def review_pack(status: DataFrame, years: tuple[int, int], n: int, key: str, seed: int = 13) -> DataFrame:
    """Records with a grid and no location, of a span of years, in hashed order."""
    failed = status.where((F.col("grid_status") == "done") & (F.col("location_status") == "failed") & F.col("year").between(*years))
    return failed.orderBy(order_key(key, seed), key).limit(n)


def unlabelled(candidates: DataFrame, labels: DataFrame, n: int, key: str = "stem") -> DataFrame:
    return candidates.join(labels.select(key), key, "left_anti").orderBy(key).limit(n)
