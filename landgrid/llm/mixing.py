"""Mixing sources to target weights by pivotal dependent rounding.

Every source has a target in words, so each of its documents an expected number
of copies, target / size of the source. Whole copies are taken as they are; the
fractional rest of each document is rounded by pivotal steps: two documents meet,
a random transfer of word mass between their probabilities leaves its expectation
as it was and makes one of them 0 or 1, and the other goes on. The words that a
source's mix takes thus differ from its target by less than one document.

The steps run in groups of a bounded number of documents (dealt by a hash, so a
source with a third of all rows is many groups), each as one fold over an array.
A group leaves one document with a fractional rest; these residuals meet in
groups again, level by level, until each source has one, which is drawn.

DataFrame functions only. Defined results: null text counts as empty and takes
nothing; a null source is a source of its own, last in order; draws depend on
hashes of id and text alone, so reruns agree whatever the partitions; rows equal in
id, text and source take part as one: of their common expectation the whole copies
are dealt out evenly and only the rest is rounded, so however often a row repeats,
no group grows; an empty table gives no rows; other columns of docs, whatever
their names, pass through ``mix`` untouched and are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from landgrid.llm.common import WORD, table, written

WEIGHTS = (3.0, 1.0, 2.0)
#: Of all words, what the mix takes; of a source's words, what its target may reach.
SHARE, MOST = 1.5, 2.0
#: Documents that one fold sees on average.
GROUP = 256
SEED = 17


def uniform(*columns: Column) -> Column:
    """A number from 0 to 1 by hash of the columns."""
    return F.pmod(F.xxhash64(F.lit(SEED), *columns), F.lit(1 << 52)) / F.lit(float(1 << 52))


def sized(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """(doc_id, source, size, key): words of each text, and a hash that draws depend on."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    return docs.select(
        F.col(id_col).alias("doc_id"), F.col(source_col).alias("source"), F.regexp_count(text, F.lit(WORD)).cast("long").alias("size"), F.xxhash64(id_col, text).alias("key")
    )


def targets(sizes: DataFrame, weights: tuple[float, ...] = WEIGHTS, share: float = SHARE, most: float = MOST) -> DataFrame:
    """(source, source_size, n_docs, target): weights dealt in order of source, capped, the excess reshared.

    Sorted by cap / weight, the capped sources come first: a source is capped where
    its cap is no more than its part of what those before it leave. One row per source.
    """
    each = sizes.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("n_docs"))
    rank = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last()))
    weight = F.element_at(F.array(*map(F.lit, weights)), (F.pmod(rank - 1, F.lit(len(weights))) + 1).cast("int"))
    each = each.withColumn("_w", weight).withColumn("_cap", F.col("source_size") * most)
    by_ratio = Window.orderBy(F.col("_cap") / F.col("_w"), F.col("source").asc_nulls_last())
    before = by_ratio.rowsBetween(Window.unboundedPreceding, -1)
    after = by_ratio.rowsBetween(0, Window.unboundedFollowing)
    left = F.sum("source_size").over(Window.partitionBy()) * share - F.coalesce(F.sum("_cap").over(before), F.lit(0.0))
    level = F.max("_level").over(Window.partitionBy())
    each = each.withColumn("_level", left / F.sum("_w").over(after))
    return each.select("source", "source_size", "n_docs", F.least("_cap", level * F.col("_w")).alias("target"))


def _step(state: Column, item: Column) -> Column:
    """One pivotal step of a fold: the carried document meets the next."""
    a, b = state["held"], item
    down_b = F.least((1 - a["p"]) * a["size"], b["p"] * b["size"])  # a gains, b loses
    down_a = F.least(a["p"] * a["size"], (1 - b["p"]) * b["size"])
    gains = uniform(a["key"], b["key"], a["doc_id"], b["doc_id"]) * (down_a + down_b) < down_a
    a_full, b_none = gains & ((1 - a["p"]) * a["size"] <= b["p"] * b["size"]), gains
    a_none = ~gains & (a["p"] * a["size"] <= (1 - b["p"]) * b["size"])
    put = lambda x, p: F.struct(x["doc_id"].alias("doc_id"), x["key"].alias("key"), x["size"].alias("size"), p.alias("p"))
    p_a = F.when(a_full, 1.0).when(b_none, a["p"] + down_b / a["size"]).when(a_none, 0.0).otherwise(a["p"] - down_a / a["size"])
    p_b = F.when(a_full, b["p"] - down_b / b["size"]).when(b_none, 0.0).when(a_none, b["p"] + down_a / b["size"]).otherwise(1.0)
    a_done = a_full | a_none
    done, held = F.when(a_done, put(a, p_a)).otherwise(put(b, p_b)), F.when(a_done, put(b, p_b)).otherwise(put(a, p_a))
    return F.when(a["p"].isNull(), F.struct(item.alias("held"), state["done"].alias("done"))).otherwise(
        F.struct(held.alias("held"), F.concat(state["done"], F.array(done)).alias("done"))
    )


ITEM = "struct<doc_id:{0},key:bigint,size:bigint,p:double>"


def _level(items: DataFrame, level: int) -> DataFrame:
    """Fold each group of (source, _group); p is 0 or 1 after that but for one document of each group."""
    item = ITEM.format(dict(items.dtypes)["doc_id"])
    grouped = items.groupBy("source", "_group").agg(F.sort_array(F.collect_list(F.struct("key", "doc_id", "size", "p"))).alias("items"))
    ordered = F.transform("items", lambda x: F.struct(x["doc_id"].alias("doc_id"), x["key"].alias("key"), x["size"].alias("size"), x["p"].alias("p")))
    start = F.struct(F.lit(None).cast(item).alias("held"), F.array().cast(f"array<{item}>").alias("done"))
    folded = F.aggregate(ordered, start, _step, lambda s: F.concat(s["done"], F.array(s["held"])))
    out = grouped.select("source", F.inline(folded))
    return written(out, f"mix{level}")


def mix_totals(sizes: DataFrame, weights: tuple[float, ...] = WEIGHTS, share: float = SHARE, most: float = MOST, group: int = GROUP) -> DataFrame:
    """doc_id, key, source, size, rows, source_size, target, total: the copies that all rows of one id, text and source take together."""
    goal = written(targets(sizes, weights, share, most), "targets")
    each = sizes.groupBy("doc_id", "key", "source", "size").agg(F.count("*").alias("rows"))
    same = lambda a, b: F.col(f"a.{a}").eqNullSafe(F.col(f"b.{b}"))
    rows = each.alias("a").join(goal.alias("b"), same("source", "source")).select("a.*", "b.source_size", "b.target", "b.n_docs")
    mean = F.when(F.col("size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0) * F.col("rows")
    rows = rows.withColumn("_whole", F.floor(mean)).withColumn("p", mean - F.col("_whole"))
    fractional = (F.col("p") > 0) & (F.col("p") < 1)
    groups = F.ceil(F.col("n_docs") / group)
    items = rows.where(fractional).select("source", "doc_id", "key", "size", "p", F.pmod(F.xxhash64("key", F.lit(0)), groups).alias("_group"))
    largest = goal.agg(F.max("n_docs")).first()[0] or 0
    decided, level, most_groups = [], 0, -(-largest // group)
    while True:
        done = _level(items, level)
        decided.append(done.where(~fractional))
        rest = done.where(fractional)
        if most_groups <= 1:
            break
        level += 1
        most_groups = -(-most_groups // group)
        items = rest.withColumn("_group", F.pmod(F.xxhash64("key", F.lit(level)), F.lit(most_groups)))
    rounded = rest.withColumn("p", F.when(uniform(F.col("key"), F.col("doc_id")) < F.col("p"), 1.0).otherwise(0.0))
    for d in decided:
        rounded = rounded.unionByName(d)
    rounded = rounded.select("doc_id", "key", "source", F.col("p").alias("_drawn"))
    on = same("key", "key") & same("doc_id", "doc_id") & same("source", "source")
    drawn = rows.alias("a").join(rounded.alias("b"), on, "left").select("a.*", "b._drawn")
    total = (F.col("_whole") + F.coalesce("_drawn", F.lit(0.0))).cast("long").alias("total")
    return drawn.select("doc_id", "key", "source", "size", "rows", "source_size", "target", total)


def _own_copies(joined: DataFrame, *by: str) -> DataFrame:
    """Add _copies: the total of equal rows, dealt as evenly as whole numbers go."""
    nth = F.row_number().over(Window.partitionBy(*by).orderBy(by[0]))
    own = F.expr("total div rows") + F.when(nth <= F.col("total") % F.col("rows"), 1).otherwise(0)
    return joined.withColumn("_copies", own)


def mix_sizes(sizes: DataFrame, weights: tuple[float, ...] = WEIGHTS, share: float = SHARE, most: float = MOST, group: int = GROUP) -> DataFrame:
    """doc_id, key, source, size, source_size, target, copies of each row of sizes."""
    totals = mix_totals(sizes, weights, share, most, group).alias("b")
    same = lambda c: F.col(f"a.{c}").eqNullSafe(F.col(f"b.{c}"))
    joined = sizes.alias("a").join(totals, same("key") & same("doc_id") & same("source")).select("a.*", "b.rows", "b.source_size", "b.target", "b.total")
    dealt = _own_copies(joined, "key", "doc_id", "source")
    return dealt.select("doc_id", "key", "source", "size", "source_size", "target", F.col("_copies").alias("copies"))


def mix(docs: DataFrame, weights: tuple[float, ...] = WEIGHTS, share: float = SHARE, most: float = MOST) -> DataFrame:
    """The mix itself: the rows of docs, each as often as it is taken, with all their columns."""
    totals = mix_totals(written(sized(docs), "sizes"), weights, share, most).select("doc_id", "key", "source", "rows", "total").alias("b")
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row")
    keyed = docs.select(row, F.xxhash64("doc_id", F.coalesce(F.col("text"), F.lit(""))).alias("key"), "doc_id", "source").alias("a")
    same = lambda c: F.col(f"a.{c}").eqNullSafe(F.col(f"b.{c}"))
    joined = keyed.join(totals, same("key") & same("doc_id") & same("source")).select("a._row", "a.key", "a.doc_id", "a.source", "b.rows", "b.total").where("total > 0")
    dealt = _own_copies(joined, "key", "doc_id", "source").where("_copies > 0")
    return dealt.select("_row", F.explode(F.sequence(F.lit(1), F.col("_copies").cast("int")))).select("_row.*")


def op2_mixing(spark, sf_dir: str) -> DataFrame:
    """What the mix of all sources takes of every row of ``documents``."""
    sizes = written(sized(table(spark, sf_dir, "documents")), "sizes")
    return mix_sizes(sizes).select("doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"))
