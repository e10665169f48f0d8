"""License scans by ordered signature rules.

Whole texts pass a keyword gate; those that hold a keyword are normalised to
words, and every rule whose own keyword occurs gives its places. A detection
that lies within one of a rule of the same or a greater level is suppressed;
what is left gives labels and a score. All of it happens in the row, so a source
with a third of all rows or one very common license line moves nothing.

DataFrame functions only. Defined results: null text counts as empty: no words,
no labels (""), null first and last word, score 0; places of one phrase don't
overlap; repeated rows get equal results; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from landgrid.llm.common import table
from landgrid.llm.license_rules import BASE, GATE, RULES, regex

#: What stands between words, in texts whose A-Z are lower case.
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
SCANNED_WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
LEVELS = 4
PLACES = "array<struct<s:int,e:int>>"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body(value) with value worked out once."""
    return F.transform(F.array(value), body)[0]


def normalised(text: Column) -> Column:
    """The words of a text, each as ' word ', one after the other."""
    lower = F.translate(text, UPPER, LOWER)
    inner = F.regexp_replace(F.regexp_replace(lower, f"^{SEPARATORS}", ""), f"{SEPARATORS}$", "")
    return F.concat(F.lit(" "), F.regexp_replace(inner, SEPARATORS, "  "), F.lit(" "))


def _words(piece: Column) -> Column:
    return ((F.char_length(piece) - F.char_length(F.replace(piece, F.lit(" "), F.lit("")))) / 2).cast("int")


def places(norm: Column, pattern: Column) -> Column:
    """Start and end, in words, of each match: the words of the pieces around matches add up to positions."""

    def add(state: Column, pair: Column) -> Column:
        start = state["at"] + _words(pair["0"])
        return let(start, lambda s: let(s + _words(pair["1"]), lambda e: F.struct(e.alias("at"), F.concat(state["found"], F.array(F.struct(s.alias("s"), e.alias("e")))).alias("found"))))

    found = F.regexp_extract_all(norm, pattern, F.lit(0))
    pairs = let(found, lambda m: F.arrays_zip(F.slice(F.split(norm, pattern, F.lit(-1)), F.lit(1), F.size(m)).alias("0"), m.alias("1")))
    start = F.struct(F.lit(0).alias("at"), F.array().cast(PLACES).alias("found"))
    return F.aggregate(F.transform(pairs, lambda p: F.struct(p["0"].alias("0"), p["1"].alias("1"))), start, add, lambda s: s["found"])


def detections(norm: Column) -> Column:
    """Of each rule whose keyword occurs its places, as structs sorted so that what holds another comes first."""
    rules = F.array(
        *[
            F.struct(F.lit(i).alias("rule"), F.lit(r.label).alias("label"), F.lit(r.level).alias("level"), F.lit(r.score).alias("score"), F.lit(r.keyword).alias("keyword"), F.lit(regex(r.pattern)).alias("regex"))
            for i, r in enumerate(RULES)
        ]
    )

    def of(rule: Column) -> Column:
        return F.transform(
            places(norm, rule["regex"]),
            lambda p: F.struct(p["s"].alias("s"), (-p["e"]).alias("minus_e"), (-rule["level"]).alias("minus_level"), rule["rule"].alias("rule"), rule["label"].alias("label"), rule["score"].alias("score")),
        )

    return F.sort_array(F.flatten(F.transform(F.filter(rules, lambda r: F.contains(norm, r["keyword"])), of)))


def kept(found: Column) -> Column:
    """Labels and the greatest score of the detections that no other of at least their level contains.

    Before a detection in the order stand all that can contain it; they do if one
    of them, of its level or more, ends no earlier.
    """

    def add(state: Column, d: Column) -> Column:
        end, level = -d["minus_e"], -d["minus_level"]
        covered = F.greatest(*[F.when(level <= i, state[f"end{i}"]).otherwise(-1) for i in range(1, LEVELS + 1)]) >= end
        ends = [F.when(level == i, F.greatest(state[f"end{i}"], end)).otherwise(state[f"end{i}"]).alias(f"end{i}") for i in range(1, LEVELS + 1)]
        labels = F.when(covered, state["labels"]).otherwise(F.array_union(state["labels"], F.array(d["label"])))
        return F.struct(*ends, labels.alias("labels"), F.when(covered, state["score"]).otherwise(F.greatest(state["score"], d["score"])).alias("score"))

    start = F.struct(*[F.lit(-1).alias(f"end{i}") for i in range(1, LEVELS + 1)], F.array().cast("array<string>").alias("labels"), F.lit(0.0).alias("score"))
    return F.aggregate(found, start, add, lambda s: F.struct(s["labels"].alias("labels"), s["score"].alias("score")))


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_words, n_base, first_word, last_word, base_labels, labels, score) of each row."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    base = F.array(*[F.struct(F.lit(label).alias("label"), F.lit(regex(phrase)).alias("regex")) for label, phrase in BASE])

    def digest(norm: Column) -> Column:
        at = F.transform(base, lambda b: F.struct(b["label"].alias("label"), F.transform(places(norm, b["regex"]), lambda p: p["s"]).alias("starts")))

        def result(b: Column, k: Column) -> Column:
            starts = F.flatten(F.transform(b, lambda x: x["starts"]))
            own = F.transform(F.filter(b, lambda x: F.size(x["starts"]) > 0), lambda x: x["label"])
            return F.struct(starts.alias("starts"), own.alias("base"), k["labels"].alias("labels"), k["score"].alias("score"))

        return let(at, lambda b: let(kept(detections(norm)), lambda k: result(b, k)))

    found = F.when(text.rlike(GATE), let(normalised(text), digest))
    rows = docs.select(F.col(id_col), F.regexp_count(text, F.lit(SCANNED_WORD)).cast("long").alias("n_words"), found.alias("_f"))
    joined = lambda labels: F.coalesce(F.array_join(F.array_sort(F.array_distinct(labels)), ","), F.lit(""))
    return rows.select(
        id_col,
        "n_words",
        F.when(F.col("_f").isNull(), 0).otherwise(F.size("_f.starts")).cast("long").alias("n_base"),
        F.array_min("_f.starts").cast("long").alias("first_word"),
        F.array_max("_f.starts").cast("long").alias("last_word"),
        joined(F.col("_f.base")).alias("base_labels"),
        joined(F.concat(F.col("_f.base"), F.col("_f.labels"))).alias("labels"),
        F.coalesce(F.col("_f.score"), F.lit(0.0)).alias("score"),
    )


def op3_licenses(spark, sf_dir: str) -> DataFrame:
    """License detections in every row of ``documents``."""
    return scan(table(spark, sf_dir, "documents"))


def oracle() -> str:
    """The same as SQL over word lists and joins."""
    quote = lambda x: "'" + x.replace("'", "''") + "'"
    rules = ",\n".join(f"({i}, {quote(r.label)}, {r.level}, {r.score}, {quote(r.keyword)}, {quote(regex(r.pattern))})" for i, r in enumerate(RULES))
    bases = " union all ".join(
        f"select doc_id, {quote(label)} label, i - 1 w from (select doc_id, ws, unnest(range(1, len(ws) + 1)) i from hit) where "
        + " and ".join(f"ws[i + {k}] = {quote(w)}" for k, w in enumerate(phrase.split()))
        for label, phrase in BASE
    )
    return rf"""
with words as (
  select doc_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') ws from documents
), hit as (
  select * from words where len(list_filter(ws, lambda w: regexp_matches(w, 'licen|copyright|reserved|domain|commons|spdx|hereby|redist|unencumbered|permission|provided|proprietary|gpl|gfdl|mpl|epl|eupl|cddl|ofl|odbl|lppl|psf|wtfpl|bsd|^cc'))) > 0
), base as ({bases}),
b as (
  select doc_id, count(*) n_base, min(w) first_word, max(w) last_word, string_agg(distinct label, ',' order by label) base_labels from base group by doc_id
), rules(rule, label, level, score, keyword, regex) as (values {rules}),
norm as (select doc_id, ' ' || array_to_string(ws, '  ') || ' ' t from hit),
cut as (
  select doc_id, rule, label, level, score, regexp_extract_all(t, regex) m, string_split_regex(t, regex) p from norm join rules on contains(t, keyword) where regexp_matches(t, regex)
), each as (
  select doc_id, rule, label, level, score, unnest(range(1, len(m) + 1)) k,
    list_transform(p, lambda x: (length(x) - length(replace(x, ' ', ''))) // 2) pw, list_transform(m, lambda x: (length(x) - length(replace(x, ' ', ''))) // 2) mw from cut
), det as (
  select doc_id, rule, label, level, score, list_sum(pw[1:k]) + coalesce(list_sum(mw[1:k - 1]), 0) s, list_sum(pw[1:k]) + list_sum(mw[1:k]) e from each
), left_over as (
  select * from det d where not exists (
    select 1 from det o where o.doc_id = d.doc_id and o.s <= d.s and o.e >= d.e and o.level >= d.level
      and (o.s < d.s or o.e > d.e or o.level > d.level or o.rule < d.rule))
), l as (
  select doc_id, string_agg(distinct label, ',' order by label) labels from (select doc_id, label from left_over union all select doc_id, label from base) group by doc_id
), s as (select doc_id, max(score)::double score from left_over group by doc_id)
select w.doc_id, len(ws)::bigint n_words, coalesce(n_base, 0)::bigint n_base, first_word::bigint first_word, last_word::bigint last_word,
  coalesce(base_labels, '') base_labels, coalesce(labels, '') labels, coalesce(score, 0.0)::double score
from words w left join b using (doc_id) left join l using (doc_id) left join s using (doc_id)
"""
