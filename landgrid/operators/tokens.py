"""Queries over recognised tokens and their boxes.

A token table has doc_id, page, pos, t and a box x0, y0, x1, y1. Pages are the
unit of meaning, but no join is by page alone: labels meet tokens by page and band
of height, so a long page is many small groups; labels are filtered before they meet
values.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from landgrid.functions.fields import fuzzy_county, token
from landgrid.functions.geometry import overlap

PAGE = ["doc_id", "page"]
#: Labels of the three survey fields.
LABELS = {"section": ("section", "sec", "sect"), "township": ("township", "twp", "twn"), "range": ("range", "rge", "rng")}
ILLEGIBLE_BELOW = 15
#: Least vertical overlap of labels on one line.
LINE_OVERLAP = 0.35
#: Height of the bands that joins deal pages by.
BAND = 120.0


def bands(df: DataFrame, low, high) -> DataFrame:
    """df once for each band of height from low to high."""
    at = lambda y: F.floor(y / BAND).cast("long")
    return df.withColumn("_band", F.explode(F.sequence(at(low), at(high))))


def banded(df: DataFrame, y) -> DataFrame:
    return df.withColumn("_band", F.floor(y / BAND).cast("long"))


NEAR = [*PAGE, "_band"]


def illegible(tokens: DataFrame, least: int = ILLEGIBLE_BELOW) -> DataFrame:
    """Pages with too few tokens to read."""
    return tokens.groupBy(*PAGE).agg(F.count("*").alias("n_tokens")).where(F.col("n_tokens") < least)


def in_region(tokens: DataFrame, x0: float, y0: float, x1: float, y1: float, or_all: bool = False) -> DataFrame:
    """Tokens whose centre lies in a box; with or_all, all tokens of pages that have none there."""
    inside = ((F.col("x0") + F.col("x1")) / 2).between(x0, x1) & ((F.col("y0") + F.col("y1")) / 2).between(y0, y1)
    if not or_all:
        return tokens.where(inside)
    any_ = F.max(inside).over(Window.partitionBy(*PAGE))
    return tokens.withColumn("_in", inside).withColumn("_any", any_).where("_in or not _any").drop("_in", "_any")


def keyword_boxes(tokens: DataFrame, labels: dict = LABELS, right: float = 400, pad: float = 50) -> DataFrame:
    """Tokens that are a label exactly, with kind and the box in which a value may stand."""
    kind = F.lit(None).cast("string")
    for name, words in reversed(labels.items()):
        kind = F.when(token("t").isin(*words), name).otherwise(kind)
    found = tokens.withColumn("kind", kind).where("kind is not null")
    return found.select(*PAGE, "pos", "kind", F.col("x0").alias("bx0"), (F.col("y0") - pad).alias("by0"), (F.col("x1") + right).alias("bx1"), (F.col("y1") + pad).alias("by1"))


def paired(boxes: DataFrame, least: float = LINE_OVERLAP) -> DataFrame:
    """For each page the first section label with the first township and range to its right on its line."""
    spread = bands(boxes, F.col("by0"), F.col("by1"))
    sections = spread.where("kind = 'section'").select(*NEAR, F.col("pos").alias("sec_pos"), *[F.col(c).alias(f"s_{c}") for c in ("bx0", "by0", "by1")])

    def beside(kind: str) -> DataFrame:
        met = sections.join(spread.where(F.col("kind") == kind), NEAR).where((F.col("bx0") > F.col("s_bx0")) & (overlap("s_by0", "s_by1", "by0", "by1") >= least))
        return met.groupBy(*PAGE, "sec_pos").agg(F.min("pos").alias(f"{kind}_pos"))

    both = beside("township").join(beside("range"), [*PAGE, "sec_pos"])
    return both.groupBy(*PAGE).agg(F.min(F.struct("sec_pos", "township_pos", "range_pos")).alias("b")).select(*PAGE, "b.*")


def keyword_region(boxes: DataFrame, least: float = LINE_OVERLAP, right: float = 200) -> DataFrame:
    """For each page with labels the box to read: around the first triplet and ``right`` beyond it; else around all
    townships and ranges; else around the first section and a township right of it on its line."""
    box = ["bx0", "by0", "bx1", "by1"]
    least_of = {"bx0": F.min, "by0": F.min, "bx1": F.max, "by1": F.max}
    triplet = paired(boxes, least)
    each = triplet.select(*PAGE, F.explode(F.array("sec_pos", "township_pos", "range_pos")).alias("pos")).join(boxes.select(*PAGE, "pos", *box), [*PAGE, "pos"])
    first = each.groupBy(*PAGE).agg(*[f(c).alias(c) for c, f in least_of.items()]).withColumn("bx1", F.col("bx1") + right).withColumn("how", F.lit("triplet"))
    both = boxes.where("kind <> 'section'").groupBy(*PAGE).agg(F.countDistinct("kind").alias("_k"), *[f(c).alias(c) for c, f in least_of.items()]).where("_k = 2")
    second = both.select(*PAGE, F.col("bx0") - 300, F.col("by0") - 80, F.col("bx1") + 180, F.col("by1") + 80, F.lit("township_range")).toDF(*PAGE, *box, "how")
    spread = bands(boxes, F.col("by0"), F.col("by1"))
    s = spread.where("kind = 'section'").select(*NEAR, F.col("pos").alias("s_pos"), *[F.col(c).alias(f"s_{c}") for c in box])
    met = s.join(spread.where("kind = 'township'"), NEAR).where((F.col("bx0") > F.col("s_bx0")) & (overlap("s_by0", "s_by1", "by0", "by1") >= least))
    made = F.struct("s_pos", "pos", (F.col("s_bx0") - 100).alias("bx0"), (F.least("s_by0", "by0") - 80).alias("by0"), (F.col("bx1") + 500).alias("bx1"), (F.greatest("s_by1", "by1") + 80).alias("by1"))
    third = met.groupBy(*PAGE).agg(F.min(made).alias("b")).select(*PAGE, *[f"b.{c}" for c in box], F.lit("section_township").alias("how"))
    columns = [*PAGE, *box, "how"]
    ranked = first.select(columns).withColumn("_r", F.lit(0)).unionByName(second.withColumn("_r", F.lit(1))).unionByName(third.withColumn("_r", F.lit(2)))
    return ranked.groupBy(*PAGE).agg(F.min(F.struct("_r", *box, "how")).alias("b")).select(*PAGE, *[f"b.{c}" for c in box], "b.how")


def text_in(tokens: DataFrame, boxes: DataFrame, key: str = "pos") -> DataFrame:
    """Text of the tokens whose centre lies in each box, in token order."""
    cy = (F.col("y0") + F.col("y1")) / 2
    own = bands(boxes.select(*PAGE, F.col(key).alias("box_pos"), "kind", "bx0", "by0", "bx1", "by1"), F.col("by0"), F.col("by1"))
    met = own.join(banded(tokens, cy), NEAR).where(((F.col("x0") + F.col("x1")) / 2).between(F.col("bx0"), F.col("bx1")) & cy.between(F.col("by0"), F.col("by1")))
    words = F.array_sort(F.collect_list(F.struct("pos", "t")))
    return met.groupBy(*PAGE, "box_pos", "kind").agg(F.array_join(F.transform(words, lambda w: w["t"]), " ").alias("text"))


def first_values(tokens: DataFrame, boxes: DataFrame) -> DataFrame:
    """(doc_id, page, section, township, range): the first number after each kind's first label, where pairing finds none."""
    first = boxes.groupBy(*PAGE, "kind").agg(F.min(F.struct("pos", "bx0", "by0", "bx1", "by1")).alias("b")).select(*PAGE, "kind", "b.*")
    said = F.trim(F.regexp_replace("text", r"^\s*\S+\s*", ""))
    letters = F.when(F.col("kind") == "township", "NS").when(F.col("kind") == "range", "EW")
    number = F.regexp_extract(said, r"([0-9]{1,3})\s*([NSEWnsew]?)", 1)
    direction = F.upper(F.regexp_extract(said, r"([0-9]{1,3})\s*([NSEWnsew]?)", 2))
    n = number.try_cast("int")
    value = F.when((F.col("kind") == "section") & n.between(1, 36), n.cast("string")).when(
        (F.col("kind") != "section") & n.between(1, 50), F.concat(n.cast("string"), F.when(F.contains(letters, direction), direction).otherwise(""))
    )
    found = text_in(tokens, first).withColumn("v", value)
    return found.groupBy(*PAGE).agg(*[F.max(F.when(F.col("kind") == k, F.col("v"))).alias(k) for k in LABELS])


def value_below(tokens: DataFrame, label: str, dx: float = 55, dy: tuple[float, float] = (10, 160)) -> DataFrame:
    """The nearest token below each label token: least distance, then least text."""
    at = lambda p: (F.col(f"{p}x0") + F.col(f"{p}x1")) / 2
    labels = tokens.where(token("t") == label).select(*PAGE, F.col("pos").alias("label_pos"), *[F.col(c).alias(f"l_{c}") for c in ("x0", "x1", "y0")])
    labels = bands(labels, F.col("l_y0") + dy[0], F.col("l_y0") + dy[1])
    met = labels.join(banded(tokens.where(token("t") != label), F.col("y0")), NEAR).withColumn("dy", F.col("y0") - F.col("l_y0"))
    met = met.where((F.abs(at("l_") - at("")) <= dx) & F.col("dy").between(*dy))
    return met.groupBy(*PAGE, "label_pos").agg(F.min(F.struct("dy", "t")).alias("m")).select(*PAGE, "label_pos", F.col("m.t").alias("value"), F.col("m.dy").alias("dy"))


def beside(tokens: DataFrame, label: str, line: float = 35, left: int = 4, right: int = 4, below: int = 2) -> DataFrame:
    """For each label token: the last tokens left of it, the first right of it on its line, and the first below; empty where there are none."""
    labels = tokens.where(token("t") == label).select(*PAGE, F.col("pos").alias("label_pos"), F.col("x0").alias("lx"), F.col("y0").alias("ly"))
    labels = bands(labels, F.col("ly") - line, F.col("ly") + 120)
    met = labels.join(banded(tokens, F.col("y0")), NEAR, "left")
    dx, dy = F.col("x0") - F.col("lx"), F.col("y0") - F.col("ly")
    same, other = F.abs(dy) <= line, F.col("pos") != F.col("label_pos")
    item = lambda *keys: F.struct(*keys, "pos", "t")
    sorted_ = met.groupBy(*PAGE, "label_pos").agg(
        F.array_sort(F.collect_list(F.when(other & same & (dx < 0), item(dx.alias("k"))))).alias("l"),
        F.array_sort(F.collect_list(F.when(other & same & (dx > 0), item(dx.alias("k"))))).alias("r"),
        F.array_sort(F.collect_list(F.when(other & (F.abs(dx) <= 80) & dy.between(5, 120), item(dy.alias("k"))))).alias("b"),
    )
    words = lambda a: F.array_join(F.transform(a, lambda w: w["t"]), " ")
    last = F.slice(F.col("l"), F.greatest(F.size("l") - left + 1, F.lit(1)), left)
    return sorted_.select(*PAGE, "label_pos", words(last).alias("left_text"), words(F.slice("r", 1, right)).alias("right_text"), words(F.slice("b", 1, below)).alias("below_text"))


def by_anchor(sides: DataFrame, order: tuple[str, ...] = ("right", "below", "left"), enough: int = 95) -> DataFrame:
    """The county beside an anchor: sides in the hint's order, the first that scores ``enough``, else the best (the earlier on ties)."""
    each = F.array(*[F.struct(F.lit(-i).alias("i"), F.lit(s).alias("side"), fuzzy_county(F.col(f"{s}_text")).alias("m")) for i, s in enumerate(order)])
    rows = sides.select(*PAGE, "label_pos", F.filter(each, lambda x: x["m"].isNotNull()).alias("e"))
    first = F.get(F.filter("e", lambda x: x["m"]["score"] >= enough), 0)
    best = F.array_max(F.transform("e", lambda x: F.struct(x["m"]["score"].alias("s"), x["i"].alias("i"), x.alias("x"))))["x"]
    return rows.withColumn("b", F.coalesce(first, best)).where("b is not null").select(*PAGE, "label_pos", F.col("b.side").alias("side"), F.col("b.m.county").alias("county"), F.col("b.m.score").alias("score"))


def phrases(tokens: DataFrame, words: list[str]) -> DataFrame:
    """Runs of neighbouring tokens that hold the words, and the box around each."""
    own = Window.partitionBy(*PAGE).orderBy("pos")
    nth = lambda c, i: F.lead(c, i).over(own)
    found = tokens.withColumns({f"_t{i}": token(nth("t", i)) for i in range(len(words))})
    n = len(words)
    found = found.withColumns(
        {
            "px0": F.least(*[nth("x0", i) for i in range(n)]) if n > 1 else F.col("x0"),
            "py0": F.least(*[nth("y0", i) for i in range(n)]) if n > 1 else F.col("y0"),
            "px1": F.greatest(*[nth("x1", i) for i in range(n)]) if n > 1 else F.col("x1"),
            "py1": F.greatest(*[nth("y1", i) for i in range(n)]) if n > 1 else F.col("y1"),
        }
    )
    for i, w in enumerate(words):
        found = found.where(F.col(f"_t{i}").contains(w))
    return found.select(*PAGE, "pos", "px0", "py0", "px1", "py1")


def ladder(candidates: DataFrame, least: int = 2) -> DataFrame:
    """Fill fields by strategies in order of rank, page by page; the first page with ``least`` fields wins.

    candidates: doc_id, page, rank, section, township, range; confidence is a third for each field.
    """
    fields = ["section", "township", "range"]
    pages = candidates.groupBy(*PAGE).agg(*[F.min_by(c, F.when(F.col(c).isNotNull(), F.col("rank"))).alias(c) for c in fields])
    n = sum(F.col(c).isNotNull().cast("int") for c in fields)
    scored = pages.withColumn("n_found", n).withColumn("confidence", F.floor(n * 100 / 3).cast("int")).where(F.col("n_found") >= least)
    return scored.withColumn("_first", F.row_number().over(Window.partitionBy("doc_id").orderBy("page"))).where("_first = 1").drop("_first")
