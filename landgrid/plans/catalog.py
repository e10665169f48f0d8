"""The registered queries of the land-record engine and their oracle SQL.

A query is a name, its output columns with types, a Spark function over the
engine's views, and independent SQL over the same views where SQL can say it.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from landgrid.functions import fields, geometry
from landgrid.operators import cascade, detections, enrichment, mining, reconcile, reports, sampling, status, tokens
from landgrid.plans.views import view, with_views
from landgrid.session import shared_dir, written
from landgrid.streaming import streams

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}
TYPES = {"s": ("string", "varchar"), "l": ("bigint", "bigint"), "d": ("double", "double"), "b": ("boolean", "boolean")}


def query(name: str, columns: str, views: str = "", sql: str | None = None):
    """Register a function of views; columns are "name:type" with s, l, d or b. Doubles are rounded to 6 places."""
    spec = [c.split(":") for c in columns.split()]

    def register(f: Callable) -> Callable:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            own = [view(spark, sf_dir, v) for v in views.split()]
            df = f(*own) if views else f(spark, sf_dir)
            cast = lambda n, t: F.round(F.col(n).cast("double"), 6) if t == "d" else F.col(n).cast(TYPES[t][0])
            return df.select(*[cast(n, t).alias(n) for n, t in spec])

        run.__doc__ = f.__doc__
        QUERIES[name] = run
        if sql is not None:
            body = with_views(sql, *views.split()) if views else sql
            cast = lambda n, t: f"round({n}::double, 6)" if t == "d" else f"{n}::{TYPES[t][1]}"
            ORACLES[name] = f"select {', '.join(f'{cast(n, t)} as {n}' for n, t in spec)} from ({body}) q"
        return f

    return register


def sql_list(values: tuple[str, ...]) -> str:
    return "[" + ", ".join("'" + v.replace("'", "''").replace("\n", "' || chr(10) || '") + "'" for v in values) + "]"


def with_form(spark: SparkSession, sf_dir: str, forms: tuple[str, ...]) -> DataFrame:
    """(doc_id, t): the whole text of each document and below it the form block that its id names."""
    form = F.get(F.array(*map(F.lit, forms)), F.pmod("doc_id", F.lit(len(forms))).cast("int"))
    return parquet(spark, sf_dir, "documents").select("doc_id", F.concat(F.coalesce("text", F.lit("")), F.lit("\n"), form).alias("t"))


def with_form_sql(forms: tuple[str, ...]) -> str:
    return f"forms as (select doc_id, coalesce(text, '') || chr(10) || ({sql_list(forms)})[doc_id % {len(forms)} + 1] t from documents)"


def parquet(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


# --- fields and geometry -----------------------------------------------------


@query("q_index_summary", "n:l mb:d collections:l min_year:l max_year:l", "records", "select count(*) n, sum(file_size_bytes) / 1048576e0 mb, count(distinct collection_num) collections, min(year) min_year, max(year) max_year from records")
def _(records):
    """Size and span of an index."""
    return reports.index_summary(records)


DIRTY = """
select rec_id,
  case rec_id % 7 when 0 then concat(' S ', section) when 1 then concat(section, '.0') when 2 then concat('T', section) when 3 then 'x' when 4 then '99' when 5 then '' else cast(section as {s}) end as d_section,
  case rec_id % 6 when 0 then concat('T ', twp, ' n') when 1 then concat('0', twp, 'N') when 2 then concat(twp, '.0') when 3 then 'S' when 4 then concat('township ', twp, ' S') else cast(twp as {s}) end as d_township,
  case rec_id % 5 when 0 then 'not detected.' when 1 then concat(' ', lower(county), ' ') when 2 then concat(upper(county), '.,') when 3 then '---' else county end as d_county,
  case rec_id % 5 when 0 then 'ne nw se' when 1 then 'NE/NW_SW' when 2 then 'NE-NW' when 3 then 'NE-NW-XX' else 'sw-se-ne' end as d_quadrant
from records
"""


@query(
    "q_norm_fields", "rec_id:l section:s township:s county:s quadrant:s", "records",
    f"""--cte dirty as ({DIRTY.format(s='varchar')}), p as (
      select *, try_cast(try_cast(regexp_replace(trim(d_section), '^[TRStrs]\\s*', '') as double) as int) sn,
        regexp_replace(regexp_replace(upper(trim(d_township)), '^[TR]\\s*', ''), '\\.0+$', '') tw,
        regexp_replace(trim(d_county), '[.,;]+$', '') co, upper(regexp_replace(trim(d_quadrant), '[\\s_/]+', '-', 'g')) qu from dirty)
    select rec_id, case when sn between 1 and 36 then sn::varchar end section,
      case when try_cast(nullif(regexp_extract(tw, '([0-9]+)', 1), '') as int) between 1 and 99 then regexp_extract(tw, '([0-9]+)', 1) || regexp_extract(tw, '([NS])', 1) end township,
      case when co = '' or regexp_matches(lower(co), '^(not\\s+detected\\.?|none|n/?a|\\.+|unknown|-+)$') then null
        else array_to_string(list_transform(string_split(lower(co), ' '), lambda w: upper(w[1]) || w[2:]), ' ') end county,
      case when regexp_matches(qu, '^(NE|NW|SE|SW)-(NE|NW|SE|SW)-(NE|NW|SE|SW)$') then qu end quadrant from p""",
)
def _(records):
    """Dirty survey fields to canonical ones."""
    dirty = records.sparkSession.sql(DIRTY.format(s="string").replace("from records", "from {records}"), records=records)
    return dirty.select("rec_id", fields.norm_section("d_section").alias("section"), fields.norm_township("d_township").alias("township"), fields.norm_county("d_county").alias("county"), fields.norm_quadrant("d_quadrant").alias("quadrant"))


@query(
    "q_parse_bounds", "rec_id:l reason:s", "records",
    """--cte r as (select rec_id, section + case when rec_id % 10 = 1 then 36 else 0 end s, twp + case when rec_id % 10 = 2 then 28 else 0 end t, ns, rng + case when rec_id % 10 = 3 then 27 else 0 end r, ew from records)
    select rec_id, case when s not between 1 and 36 then 'section_invalid:' || s when t is null or t < 1 then 'township_invalid:' || coalesce(t::varchar, 'None')
      when ns = 'N' and t > 29 then 'township_N_too_high:' || t || '>29' when ns = 'S' and t > 8 then 'township_S_too_high:' || t || '>8' when ns is null and t > 29 then 'township_too_high:' || t
      when r is null or r < 1 then 'range_invalid:' || coalesce(r::varchar, 'None') when ew = 'E' and r > 26 then 'range_E_too_high:' || r || '>26' when ew = 'W' and r > 28 then 'range_W_too_high:' || r || '>28'
      when ew is null and r > 28 then 'range_too_high:' || r else 'ok' end reason from r""",
)
def _(records):
    """The first bound that a record's survey fields break."""
    moved = lambda c, k, by: (F.col(c) + F.when(F.col("rec_id") % 10 == k, by).otherwise(0))
    return records.select("rec_id", fields.bounds_reason(moved("section", 1, 36), moved("twp", 2, 28), F.col("ns"), moved("rng", 3, 27), F.col("ew")).alias("reason"))


@query(
    "q_quadrant_roundtrip", "label:s row:l col:l back:s", "",
    """select a || '-' || b || '-' || c label, 1 + ra * 4 + rb * 2 + rc as row, 1 + ca * 4 + cb * 2 + cc col, a || '-' || b || '-' || c back
    from (values ('NW', 0, 0), ('NE', 0, 1), ('SW', 1, 0), ('SE', 1, 1)) x(a, ra, ca), (values ('NW', 0, 0), ('NE', 0, 1), ('SW', 1, 0), ('SE', 1, 1)) y(b, rb, cb), (values ('NW', 0, 0), ('NE', 0, 1), ('SW', 1, 0), ('SE', 1, 1)) z(c, rc, cc)""",
)
def _(spark, sf_dir):
    """All 64 quadrant labels to cells and back."""
    q = geometry.quadrants(spark).withColumn("_c", geometry.label_to_cell("label"))
    return q.select("label", F.col("_c.row").alias("row"), F.col("_c.col").alias("col"), geometry.cell_to_label("_c.row", "_c.col").alias("back"))


FORMS = ("well in NW SW NE of the lease", "NE/SW/NW 1/4 of sec", "located SE-NW only", "5W NE NW 1/4 noted", "no quadrant here")


_Q, _OF = "(?:NW|NE|SW|SE|5W|5E)", "(?:[\\s\\-/,]+(?:of\\s+|the\\s+)?|(?:of|the)\\s+)+"
_THREE, _TWO = f"(?i)({_Q}){_OF}({_Q}){_OF}({_Q})", f"(?i)({_Q}){_OF}({_Q})"


@query(
    "q_extract_quadrant", "doc_id:l db_label:s levels:l confidence:l", "",
    f"""with {with_form_sql(FORMS)}, clean as (
      select doc_id, t, regexp_replace(regexp_replace(regexp_replace(t, '[¼¾½]', ' 1/4 ', 'g'), '(?i)\\b1/4(?:th)?\\b', ' ', 'g'), '[ \\t\\n\\r\\f\\v]+', ' ', 'g') s from forms
    ), found as (
      select *, regexp_extract(s, '{_THREE}', 0) w3, list_transform([3, 2, 1], lambda i: regexp_replace(upper(case i when 1 then regexp_extract(s, '{_THREE}', 1) when 2 then regexp_extract(s, '{_THREE}', 2) else regexp_extract(s, '{_THREE}', 3) end), '^5', 'S')) p3,
        regexp_extract(s, '{_TWO}', 0) w2, list_transform([2, 1], lambda i: regexp_replace(upper(case i when 1 then regexp_extract(s, '{_TWO}', 1) else regexp_extract(s, '{_TWO}', 2) end), '^5', 'S')) p2 from clean
    ) select doc_id, case when w3 <> '' then array_to_string(p3, '-') when w2 <> '' then array_to_string(p2, '-') end db_label, case when w3 <> '' then 3 when w2 <> '' then 2 end levels,
      case when w3 = '' and w2 <> '' then 45 when w3 <> '' then least(98, (case when regexp_matches(w3, '[/\\-]') then 93 else 85 end) + case when regexp_matches(t, '1/4|¼') then 5 else 0 end) end confidence from found""",
)
def _(spark, sf_dir):
    """Printed quadrants, fine to coarse, to labels."""
    return with_form(spark, sf_dir, FORMS).select("doc_id", fields.quadrant_of_text("t").alias("q")).select("doc_id", "q.db_label", "q.levels", "q.confidence")


COORDINATES = (
    "Latitude: 36.123456 Longitude: -97.654321", "Lat 36 30 15.5 N Long 97 45 30 W", "at 35.12345 and -98.76543 found", "-98.76543 then 35.12345", "Location: lat 35.5000 lon -97.2500", "lat 99.12345 lon -97.1234", "36 10 20 and nothing",
)


_DMS = "(?i)([0-9]{1,3})[°ºo*''`´\"”‘\\s,\\-]+([0-9]{1,2})[°ºo*''`´\"”‘\\s,\\-]+([0-9]{1,2}(?:[.,][0-9]+)?)[°ºo*''`´\"”‘\\s,]*([NSEW])?"
_LAT, _LON = "between 32 and 37", "between -104 and -94"


def _pair_sql(values: str) -> str:
    """The first neighbours in a list of which one can be a latitude and the other a longitude."""
    return f"list_filter(list_transform(range(1, len({values})), lambda i: {{'a': {values}[i], 'b': {values}[i + 1]}}), lambda p: (p.a {_LAT} and p.b {_LON}) or (p.b {_LAT} and p.a {_LON}))[1]"


@query(
    "q_latlon", "doc_id:l lat:d lon:d confidence:l method:s", "",
    f"""with {with_form_sql(COORDINATES)}, labelled as (
      select doc_id, t, try_cast(nullif(regexp_extract(t, '(?i)\\blat(?:itude)?\\s*[=:.]?\\s*(-?[0-9]{{1,2}}\\.[0-9]{{4,}})', 1), '') as double) la, try_cast(nullif(regexp_extract(t, '(?i)\\blon(?:gitude|g)?\\s*[=:.]?\\s*(-?[0-9]{{1,3}}\\.[0-9]{{4,}})', 1), '') as double) lo,
        regexp_extract_all(t, '{_DMS}', 1) d, regexp_extract_all(t, '{_DMS}', 2) m, regexp_extract_all(t, '{_DMS}', 3) s, regexp_extract_all(t, '{_DMS}', 4) h,
        list_transform(regexp_extract_all(t, '-?[0-9]{{1,3}}\\.[0-9]{{4,}}'), lambda x: x::double) u from forms
    ), angles as (
      select *, list_filter(list_transform(range(1, len(d) + 1), lambda i: {{'v': case when d[i]::int <= 180 and m[i]::int < 60 and replace(s[i], ',', '.')::double < 60
        then (case when upper(h[i]) in ('S', 'W') then -1e0 else 1e0 end) * (d[i]::int + m[i]::int / 60e0 + replace(s[i], ',', '.')::double / 3600e0) end, 'h': upper(h[i])}}), lambda x: x.v is not null) z from labelled
    ), named as (
      select *, list_filter(z, lambda x: x.h in ('N', 'S'))[1].v na, list_filter(z, lambda x: x.h in ('E', 'W'))[1].v no, list_transform(z, lambda x: x.v) zv from angles
    ), pairs as (select *, {_pair_sql('zv')} zp, {_pair_sql('u')} up from named),
    kinds as (
      select *, case when la {_LAT} and lo {_LON} then 'labeled' when len(z) >= 2 and na {_LAT} and no {_LON} then 'named' when len(z) >= 2 and zp is not null then 'dms' when up is not null then 'unlabeled' end k,
        case when la {_LAT} and lo {_LON} then null when len(z) >= 2 and zp is not null then zp else up end p from pairs
    ) select doc_id, case k when 'labeled' then la when 'named' then na else case when p.a {_LAT} and p.b {_LON} then p.a else p.b end end lat, case k when 'labeled' then lo when 'named' then no else case when p.a {_LAT} and p.b {_LON} then p.b else p.a end end lon,
      case k when 'labeled' then case when regexp_matches(t, '(?i)(?:Location\\s*[:]\\s*|Locate\\s+Well\\b)') then 97 else 95 end when 'named' then 90 when 'dms' then case when p.a {_LAT} and p.b {_LON} then 70 else 65 end when 'unlabeled' then case when p.a {_LAT} and p.b {_LON} then 75 else 70 end end confidence,
      case k when 'named' then 'dms' else k end as method from kinds""",
)
def _(spark, sf_dir):
    """Printed coordinates: labels, degrees-minutes-seconds, bare decimals."""
    return with_form(spark, sf_dir, COORDINATES).select("doc_id", fields.latlon("t").alias("x")).select("doc_id", "x.lat", "x.lon", "x.confidence", "x.method")


BLOCKS = (
    "Form 1002A\nLocation:\nALFALFA 36 28N 11W\nC SW SW\n660 FSL 660 FWL of 1/4 SEC", "Locate Well Correctly\nSEC 14 T5N R9W\nNW NE NW\n330 FNL\n330 F.E.L of SEC", "no block at all", "Location: ROGER MILLS\nNE\n2640 FSL",
)


_LINE = "(?im)^([A-Z][A-Z\\s]{2,24}?)\\s+([0-9]{1,2})\\s+([0-9]{1,2}\\s*[NS])\\s+([0-9]{1,2}\\s*[EW])\\s*$"
_LABELLED = "(?i)SEC\\s*([0-9]{1,2})\\s+T\\s*([0-9]{1,2}\\s*[NS])\\s+R\\s*([0-9]{1,2}\\s*[EW])"
_RUN = "(?im)^(C\\b\\s*)?([NS][EW])\\s+([NS][EW])(?:\\s+([NS][EW]))?"


def _feet(k: str) -> str:
    return f"try_cast(regexp_extract_all(s, '(?i)([0-9]{{1,5}})\\s+F\\.?{k}\\.?L', 1)[-1] as int)"


@query(
    "q_location_block", "doc_id:l county:s section:s township:s range:s quadrant:s x:d y:d", "",
    f"""with {with_form_sql(BLOCKS)}, block as (select doc_id, substr(nullif(regexp_extract(t, '(?is)((?:Location\\s*[:]\\s*|Locate\\s+Well\\b).*)', 1), ''), 1, 800) s from forms),
    parts as (
      select doc_id, s, regexp_extract(s, '{_LINE}', ['c', 's', 't', 'r']) l, regexp_extract(s, '{_LABELLED}', ['s', 't', 'r']) b, regexp_extract(s, '{_RUN}', ['a', 'b', 'c', 'd']) q, regexp_extract(s, '(?im)^([NS][EW])\\s*$', 1) one,
        {_feet('S')} fsl, {_feet('N')} fnl, {_feet('W')} fwl, {_feet('E')} fel, case when regexp_matches(s, '(?i)of\\s+1/16\\s*SEC') then 1320e0 when regexp_matches(s, '(?i)of\\s+1/4\\s*SEC') then 2640e0 else 5280e0 end unit from block
    ) select doc_id, nullif(array_to_string(list_transform(regexp_split_to_array(lower(trim(l.c)), ' '), lambda w: upper(w[1]) || w[2:]), ' '), '') county, coalesce(nullif(l.s, ''), nullif(b.s, '')) section,
      upper(regexp_replace(coalesce(nullif(l.t, ''), nullif(b.t, '')), '\\s+', '', 'g')) township, upper(regexp_replace(coalesce(nullif(l.r, ''), nullif(b.r, '')), '\\s+', '', 'g')) as range,
      upper(coalesce(nullif(concat_ws(' ', case when q.a <> '' then 'C' end, nullif(q.b, ''), nullif(q.c, ''), nullif(q.d, '')), ''), nullif(one, ''))) quadrant,
      case when coalesce(fwl, fel) is not null then least(1, greatest(0, coalesce(fwl / unit, 1 - fel / unit))) end x, case when coalesce(fsl, fnl) is not null then least(1, greatest(0, coalesce(1 - fsl / unit, fnl / unit))) end y from parts""",
)
def _(spark, sf_dir):
    """Location blocks and feet from section lines."""
    b = with_form(spark, sf_dir, BLOCKS).select("doc_id", fields.location_block("t").alias("b")).select("doc_id", "b.*")
    rel = geometry.feet_to_rel("feet_fsl", "feet_fnl", "feet_fwl", "feet_fel", "feet_ref")
    return b.select("doc_id", "county", "section", "township", "range", "quadrant", rel["x"].alias("x"), rel["y"].alias("y"))


STR_TEXTS = ("Section 19 Township 18N Range 12W", "SECTION SW/4 of 13 TOWNSHIP 18 RANGE 11", "Sec. 18 Twp. 18 Range 7", "SEC - 12  T - 23N  R - 10W", "Sec 5 Twp. 17 N then 9 E", "Section 77 Township 99 Range 60")


_TOWN = "\\b(?:township|twn|tvp|twp|t)[.\\-\\s]+([0-9]{1,3}(?:[.\\-\\s]*[NS])?)"


def _packed_sql(x: str, letters: str) -> str:
    s = f"upper(regexp_replace({x}, '[.\\-\\s]', '', 'g'))"
    n = f"try_cast(nullif(regexp_extract({s}, '^([0-9]{{1,3}})', 1), '') as int)"
    return f"case when {n} between 1 and 50 then {n} || regexp_extract({s}, '([{letters}]?)$', 1) end"


@query(
    "q_str_extract", "doc_id:l section:s township:s range:s", "",
    f"""with {with_form_sql(STR_TEXTS)}, raw as (
      select doc_id, regexp_extract(t, '(?i)\\b(?:section|sect|sec)[.\\-\\s]*([0-9]{{1,2}})\\b', 1) a, case when regexp_matches(t, '(?i)\\b(?:section|sec)\\b') then regexp_extract(t, '(?i)\\bof\\s+([0-9]{{1,2}})\\b', 1) end b,
        regexp_extract(t, '(?i){_TOWN}', 1) tw, regexp_extract(t, '(?i)\\b(?:range|rge|r)[.\\-\\s]+([0-9]{{1,3}}(?:[.\\-\\s]*[EW])?)', 1) rg, regexp_extract(regexp_extract(t, '(?is){_TOWN}(.*)$', 2), '(?i)\\b[0-9]{{1,3}}\\s*[EW]\\b', 0) late from forms
    ), made as (
      select doc_id, case when try_cast(a as int) between 1 and 36 then a when try_cast(b as int) between 1 and 36 then b end section, {_packed_sql('tw', 'NS')} township, {_packed_sql('rg', 'EW')} rg, {_packed_sql('late', 'EW')} late from raw
    ) select doc_id, section, township, coalesce(rg, case when section is not null and township is not null then late end) as range from made""",
)
def _(spark, sf_dir):
    """Survey fields of labelled free text."""
    return with_form(spark, sf_dir, STR_TEXTS).select("doc_id", fields.str_of_text("t").alias("x")).select("doc_id", "x.section", "x.township", "x.range")


@query(
    "q_api_county", "stem:s county:s", "records",
    "select stem, (string_split('" + "|".join(fields.COUNTIES) + "', '|'))[(stem[3:5]::int - 1) // 2 + 1] county from records",
)
def _(records):
    """County of the API number in front of a stem."""
    return records.select("stem", fields.api_county("stem").alias("county"))


@query("q_well_names", "stem:s well:s lease:s map_name:s", "records", "select stem, regexp_extract(stem, '^[^_]*_(.*)_[^_]*$', 1) well, regexp_replace(regexp_extract(stem, '^[^_]+_(.+)_[0-9]+$', 1), '\\s+[0-9]+$', '') lease, string_split(stem, '_')[2] map_name from records")
def _(records):
    """Well and lease names of stems."""
    return records.select("stem", fields.well_name("stem").alias("well"), fields.lease_name("stem").alias("lease"), fields.well_name_for_map("stem").alias("map_name"))


MESSAGES = ("HTTP 503 from service", "unet checkpoint missing", "grid_image_not_found", "keyword_not_found: x", "GEMINI_DISABLED", "no grid on page", "file not_found", "invalid_crop box", "no_change", "boom", "")


def _kinds_sql(message: str) -> str:
    rules = " ".join("when " + " or ".join(f"contains(lower({message}), '{p}')" for p in parts) + f" then '{kind}'" for parts, kind in fields.ERROR_RULES)
    return f"case when trim({message}) = '' then 'unknown' {rules} when lower({message}) = 'no_change' then 'not_detected' else 'exception' end"


@query(
    "q_error_classify", "event_id:l kind:s", "",
    f"with m as (select event_id, case event_id % 11 when 8 then 'no_change' when 10 then '' else event_type || ' ' || props || ': ' || ({sql_list(MESSAGES)})[event_id % 11 + 1] end e from events) select event_id, {_kinds_sql('e')} kind from m",
)
def _(spark, sf_dir):
    """Free-text errors to kinds: what an event says and a message."""
    i = (F.col("event_id") % len(MESSAGES)).cast("int")
    said = F.when(i.isin(8, 10), F.lit("")).otherwise(F.concat("event_type", F.lit(" "), "props", F.lit(": ")))
    return parquet(spark, sf_dir, "events").select("event_id", fields.error_kind(F.concat(said, F.get(F.array(*map(F.lit, MESSAGES)), i))).alias("kind"))


@query("q_eras", "rec_id:l tier:s decade:s prior:d slug:s", "records", "select rec_id, case when collection_num <= 6 then 'early' when collection_num <= 8 then 'transition' when collection_num <= 10 then 'mid' when collection_num <= 12 then 'late' else 'modern' end tier, (year // 10 * 10) || 's' as decade, case when collection_num in (9, 10) then 0.01e0 when collection_num = 11 then 0.03e0 when collection_num = 12 then 0.29e0 when collection_num >= 13 then 0.77e0 else 0e0 end prior, regexp_replace(county, '[^A-Za-z0-9]+', '_', 'g') slug from records")
def _(records):
    """Era, decade, prior of printed coordinates and safe names."""
    return records.select("rec_id", fields.tier("collection_num").alias("tier"), fields.decade("year").alias("decade"), fields.latlong_prior("collection_num").alias("prior"), fields.slug("county").alias("slug"))


@query(
    "q_fuzzy_county", "r_id:l county:s score:l", "",
    "with c as (select unnest(string_split('" + "|".join(c.lower() for c in fields.COUNTIES) + """', '|')) n), t as (
      select c_custkey r_id, c_custkey % 4 k, (string_split('"""
    + "|".join(c.lower() for c in fields.COUNTIES)
    + """', '|'))[c_custkey % 77 + 1] base from customer), s as (
      select r_id, case k when 0 then base when 1 then 'in ' || base when 2 then base[2:] else 'zz' end x from t), best as (
      select r_id, max({'score': floor(100 - 100 * levenshtein(x, n) / greatest(length(x), length(n), 1))::int, 'n': n}) b, any_value(x) x,
        max(case when contains(x, n) then {'l': length(n), 'n': n} end) h, bool_or(x = n) e from s, c group by r_id)
    select r_id, case when length(x) < 3 then null when e then x when h is not null then h.n when b.score >= 72 then b.n end c0,
      array_to_string(list_transform(string_split(c0, ' '), lambda w: upper(w[1]) || w[2:]), ' ') county, case when length(x) < 3 then null when e then 100 when h is not null then 95 when b.score >= 72 then b.score end score from best""",
)
def _(spark, sf_dir):
    """Noisy county names against the dictionary."""
    names = F.array(*[F.lit(c.lower()) for c in fields.COUNTIES])
    base = F.get(names, (F.col("c_custkey") % 77).cast("int"))
    k = F.col("c_custkey") % 4
    noisy = F.when(k == 0, base).when(k == 1, F.concat(F.lit("in "), base)).when(k == 2, F.expr("substring(base, 2)")).otherwise("zz")
    rows = parquet(spark, sf_dir, "customer").select(F.col("c_custkey").alias("r_id"), base.alias("base"), "c_custkey").withColumn("x", noisy)
    return rows.select("r_id", fields.fuzzy_county("x").alias("f")).select("r_id", "f.county", "f.score")


# --- status ------------------------------------------------------------------

LONG = "select stem, collection_num, year, s stage, coalesce(nullif(st, ''), 'pending') status, cf confidence, er error_type from (" + " union all ".join(
    f"select stem, collection_num, year, '{s}' s, {s}_status st, {s}_confidence cf, {s}_error_type er from status" for s in status.STAGES
) + ")"


@query("q_status_counts", "stage:s status:s n:l", "status", f"--cte long as ({LONG}) select stage, status, count(*) n from long group by all")
def _(s):
    """Records of each status in each stage."""
    return status.tally(s)


@query("q_stage_rollup", "collection_num:l stage:s n:l done:l failed:l level:l done_pct:l", "status", f"--cte long as ({LONG}) select collection_num, stage, count(*) n, count(*) filter (status = 'done') done, count(*) filter (status = 'failed') failed, grouping(collection_num, stage) as level, count(*) filter (status = 'done') * 100 // count(*) done_pct from long group by rollup (collection_num, stage)")
def _(s):
    """Counts by collection and stage with totals."""
    return reports.stage_rollup(s)


@query("q_stage_quality", "stage:s done:l avg_confidence:d", "status", f"--cte long as ({LONG}) select stage, count(*) filter (status = 'done') done, avg(confidence) filter (status = 'done') avg_confidence from long group by all")
def _(s):
    """Done records and mean confidence of each stage."""
    return reports.stage_quality(s)


@query("q_confidence_bins", "stage:s bin:l n:l", "status", f"--cte long as ({LONG}) select stage, confidence // 10 * 10 bin, count(*) n from long where status = 'done' group by all")
def _(s):
    """Done stages by tens of confidence."""
    return reports.confidence_bins(s)


@query(
    "q_record_classify", "stem:s final_status:s reasons:s", "status",
    """select stem, case when not good then 'failed' when reasons <> '' then 'review' else 'success' end final_status, case when good then reasons else '' end reasons from (
      select stem, county_status = 'done' and (latlong_lat <> '' or (grid_status = 'done' and location_status = 'done')) good,
        array_to_string(list_filter([case when county_score < 86 then 'county_score=' || county_score || '<86' end, case when grid_status = 'done' and grid_confidence < 80 then 'grid_conf=' || grid_confidence || '<80' end,
          case when location_status = 'done' and location_confidence < 100 then 'location_conf=' || location_confidence || '<100' end, case when latlong_lat <> '' and latlong_confidence between 1 and 79 then 'latlong_conf=' || latlong_confidence || '<80' end,
          case when dot_status = 'done' and dot_confidence < 70 then 'dot_conf=' || dot_confidence || '<70' end], lambda x: x is not null), ';') reasons from status)""",
)
def _(s):
    """Success, review or failed, and why."""
    return fields.classified(s).select("stem", "final_status", F.array_join("review_reasons", ";").alias("reasons"))


@query(
    "q_failure_analysis", "stage:s error_type:s tier:s n:l min_year:l max_year:l examples:s", "status",
    f"""--cte long as ({LONG}), f as (select *, case when collection_num <= 6 then 'early' when collection_num <= 8 then 'transition' when collection_num <= 10 then 'mid' when collection_num <= 12 then 'late' else 'modern' end tier,
      row_number() over (partition by stage, error_type, tier order by stem) k from long where status = 'failed')
    select stage, error_type, tier, count(*) n, min(year) min_year, max(year) max_year, string_agg(stem, ',' order by stem) filter (k <= 5) examples from f group by all""",
)
def _(s):
    """Failures by stage, error and era with examples."""
    return reports.failure_analysis(s).withColumn("examples", F.array_join("examples", ","))


@query("q_insights_clusters", "collection_num:l stage:s error_type:s decade:s n:l", "status", f"--cte long as ({LONG}) select collection_num, stage, error_type, (year // 10 * 10) || 's' as decade, count(*) n from long where status = 'failed' group by all order by n desc, collection_num, stage, error_type, decade limit 15")
def _(s):
    """The largest groups of failures."""
    return reports.clusters(s)


@query("q_collection_rates", "collection_num:l n:l latlong_pct:l grid_pct:l location_pct:l county_pct:l dot_pct:l", "status", "select collection_num, count(*) n, " + ", ".join(f"count(*) filter ({s}_status = 'done') * 100 // count(*) {s}_pct" for s in status.STAGES) + " from status group by all")
def _(s):
    """Share of done by collection and stage."""
    return reports.rates(s)


@query("q_flip_delta", "collection_num:l stage:s n:l", "status baseline", f"--cte now as ({LONG}), old as ({LONG.replace('from status', 'from baseline')}) select n.collection_num, n.stage, count(*) n from now n join old o using (stem, stage) where o.status = 'failed' and n.status = 'done' group by all")
def _(s, b):
    """Stages that failed in the baseline and are done now."""
    return reports.flips(b, s)


@query("q_gates", "stem:s run_latlong:b run_grid:b run_location:b run_county:b run_dot:b", "status", "select stem, latlong_status in ('pending', 'failed') and collection_num >= 12 run_latlong, grid_status in ('pending', 'failed') and latlong_status <> 'done' run_grid, location_status in ('pending', 'failed') and latlong_status <> 'done' run_location, county_status in ('', 'failed', 'pending') run_county, dot_status in ('pending', 'failed') and grid_status = 'done' run_dot from status")
def _(s):
    """Stages that are to run for each record."""
    return status.gates(s)


@query("q_newest_wins", "key:l status:s version:l", "", "select user_id as key, arg_max(case event_type when 'signup' then 'pending' when 'purchase' then 'skipped' when 'error' then 'failed' else 'done' end, event_id) status, max(event_id) as version from events group by all")
def _(spark, sf_dir):
    """The latest status of each key of a log."""
    return status.newest(streams.status_events(parquet(spark, sf_dir, "events")).drop("ts"), ["key"], "version")


@query("q_safe_merge", "stem:s location_status:s location_confidence:l origin:s", "status baseline", "select stem, case when b.location_confidence >= s.location_confidence then b.location_status else s.location_status end location_status, greatest(b.location_confidence, s.location_confidence) location_confidence, case when b.location_confidence >= s.location_confidence then 'base' else 'shard' end origin from status s join baseline b using (stem)")
def _(s, b):
    """The better row of base and shard; the base wins ties."""
    return status.ranked_merge([b.withColumn("origin", F.lit("base")), s.withColumn("origin", F.lit("shard"))], "stem", F.col("location_confidence"))


@query("q_store_overlay", "stem:s location_status:s n:l", "status baseline", "select stem, case when rec_id % 3 = 0 then s.location_status else b.location_status end location_status, 1 n from status s join baseline b using (stem, rec_id)")
def _(s, b):
    """The store after a save of changed rows."""
    columns = ["stem", "rec_id", "location_status"]
    return status.overlaid(b.select(columns), s.where("rec_id % 3 = 0").select(columns)).withColumn("n", F.lit(1))


@query("q_reset_skipped", "stem:s location_status:s", "status", "select stem, case when location_status = 'skipped' and latlong_lat = '' then 'pending' else location_status end location_status from status")
def _(s):
    """Locations that were skipped without coordinates run again."""
    return status.reset_skipped_location(s)


@query("q_finished", "n:l", "status", "select count(*) n from status where latlong_status in ('done', 'skipped', 'failed') and grid_status in ('done', 'skipped', 'failed') and location_status in ('done', 'skipped', 'failed') and county_status in ('done', 'skipped', 'failed') and dot_status in ('done', 'skipped', 'failed')")
def _(s):
    """Records of which nothing is left to do on a resume."""
    return status.finished(s, resume=True).agg(F.count("*").alias("n"))


@query("q_stage_failures", "stage:s error_type:s n:l total:l", "status", f"--cte long as ({LONG}) select *, sum(n) over (partition by stage) total from (select stage, error_type, count(*) n from long where status = 'failed' group by all)")
def _(s):
    """Failures by error, with each stage's total."""
    return reconcile.stage_failures(s)


@query("q_retry_plan", "stem:s stage:s action:s", "status", f"--cte long as ({LONG}) select stem, stage, case when stage = 'grid' and error_type = 'not_found' then 'relax_band' when stage = 'location' and error_type = 'no_match' then 'wider_crop' else 'plain' end as action from long where status = 'failed'")
def _(s):
    """What to try next for each failed stage."""
    policy = s.sparkSession.createDataFrame([("grid", "not_found", "relax_band"), ("location", "no_match", "wider_crop")], "stage string, error_type string, action string")
    return status.retry_plan(s, policy)


@query("q_cost", "collection_num:l pending:l cost:d", "status", "select collection_num, count(*) filter (location_status = 'pending') pending, count(*) filter (location_status = 'pending') / 1000e0 * 2.824e0 as cost from status group by all")
def _(s):
    """Cost of what waits."""
    return reports.cost(s)


# --- grid and cascade --------------------------------------------------------


@query("q_direction_stats", "county:s ns:s ew:s", "grid", """--cte a as (select county, ns, count(*) n from grid group by all), b as (select county, ew, count(*) n from grid group by all)
    select x.county, ns, ew from (select county, string_agg(ns, ',' order by n desc, ns) ns from a group by all) x join (select county, string_agg(ew, ',' order by n desc, ew desc) ew from b group by all) y using (county)""")
def _(grid):
    """Directions of each county, most cells first."""
    return mining.direction_stats(grid).select("county", F.array_join("ns_order", ",").alias("ns"), F.array_join("ew_order", ",").alias("ew"))


@query("q_county_constraints", "county:s min_twp:l max_twp:l ns:s min_rng:l max_rng:l ew:s n_sections:l", "grid", "select county, min(twp) min_twp, max(twp) max_twp, string_agg(distinct ns, ',' order by ns) ns, min(rng) min_rng, max(rng) max_rng, string_agg(distinct ew, ',' order by ew) ew, count(distinct (sect, twp, ns, rng, ew)) n_sections from grid group by all")
def _(grid):
    """Limits of each county."""
    return mining.county_constraints(grid).select("*", F.array_join("ns_values", ",").alias("ns"), F.array_join("ew_values", ",").alias("ew"))


@query("q_section_box", "sect:l twp:l ns:s rng:l ew:s minx:d miny:d maxx:d maxy:d n_cells:l", "grid", "select sect, twp, ns, rng, ew, min(minx) minx, min(miny) miny, max(maxx) maxx, max(maxy) maxy, count(*) n_cells from grid group by all")
def _(grid):
    """Box of each section."""
    return mining.section_boxes(grid)


PASS1 = """
 prepared{tag} as (
  select r.*, case when ns is null then ns_order when len(ns_order) = 1 and ns_order[1] <> ns then [ns_order[1], ns] else [ns] end nt, case when ew is null then ew_order when len(ew_order) = 1 and ew_order[1] <> ew then [ew_order[1], ew] else [ew] end et from {rows} r left join (
    select county, list(ns order by n desc, ns) ns_order from (select county, ns, count(*) n from grid group by all) group by county) a using (county) left join (
    select county, list(ew order by n desc, ew desc) ew_order from (select county, ew, count(*) n from grid group by all) group by county) b using (county)
), tries{tag} as (
  select *, unnest(range(1, len(nt) + 1)) i from (select * replace (coalesce(nt, ['N', 'S']) as nt, coalesce(et, ['W', 'E']) as et) from prepared{tag})
), cand{tag} as (select stem, section, twp, rng, nt[i] tn, et[j] te, i * 2 + j k, dot_row, dot_col, x_norm, y_norm, county, ns, ew from (select *, unnest(range(1, len(et) + 1)) j from tries{tag})),
 parts{tag} as (select *, (case when (dot_row - 1) // 4 % 2 = 0 then 'N' else 'S' end) || (case when (dot_col - 1) // 4 % 2 = 0 then 'W' else 'E' end) || '-' || (case when (dot_row - 1) // 2 % 2 = 0 then 'N' else 'S' end) || (case when (dot_col - 1) // 2 % 2 = 0 then 'W' else 'E' end)
   || '-' || (case when (dot_row - 1) % 2 = 0 then 'N' else 'S' end) || (case when (dot_col - 1) % 2 = 0 then 'W' else 'E' end) q,
   case when x_norm * 8 - (dot_col - 1) between 0 and 1 and y_norm * 8 - (dot_row - 1) between 0 and 1 then x_norm * 8 - (dot_col - 1) else 0.5e0 end rx,
   case when x_norm * 8 - (dot_col - 1) between 0 and 1 and y_norm * 8 - (dot_row - 1) between 0 and 1 then y_norm * 8 - (dot_row - 1) else 0.5e0 end ry from cand{tag}),
 cellhit{tag} as (select stem, k, minx x0, miny y0, maxx x1, maxy y1, rx, ry from parts{tag} join grid g on g.sect = section and g.twp = parts{tag}.twp and g.rng = parts{tag}.rng and g.ns = tn and g.ew = te and g.quad = q
   qualify row_number() over (partition by stem order by k) = 1),
 secbox{tag} as (select sect, twp, ns, rng, ew, min(minx) a, min(miny) b, max(maxx) c, max(maxy) d from grid group by all),
 sechit{tag} as (select stem, k, a + (dot_col - 1) * (c - a) / 8 x0, d - dot_row * (d - b) / 8 y0, a + dot_col * (c - a) / 8 x1, d - (dot_row - 1) * (d - b) / 8 y1, rx, ry, coalesce(tn = p.ns and te = p.ew, false) exact from parts{tag} p join secbox{tag} g on g.sect = section and g.twp = p.twp and g.rng = p.rng and g.ns = tn and g.ew = te
   qualify row_number() over (partition by stem order by coalesce(tn = p.ns and te = p.ew, false) desc, k) = 1),
 p1{tag} as (select r.stem, case when r.twp is null or r.rng is null then 'bounds_invalid' when c.stem is not null then 'quadrant_direct' when s.stem is null then 'rds_miss' when exact then 'exact_county' when ns is not null and ew is not null then 'county_constrained'
    when ns is not null then 'ew_fallback' when ew is not null then 'ns_fallback' else 'ns_ew_fallback' end source,
    round(coalesce(c.y1 + (c.y0 - c.y1) * c.ry, s.y1 + (s.y0 - s.y1) * s.ry), 7) lat, round(coalesce(c.x0 + (c.x1 - c.x0) * c.rx, s.x0 + (s.x1 - s.x0) * s.rx), 7) lon
  from {rows} r left join cellhit{tag} c using (stem) left join sechit{tag} s using (stem))
"""


def p1_sql(rows: str = "records", tag: str = "", directions: str = "") -> str:
    """Pass 1 over a table with the columns of records; ``directions`` replaces the statistics of the grid."""
    text = PASS1
    if directions:
        at, end = text.index(" prepared{tag} as"), text.index(", tries{tag} as")
        text = " " + directions + text[end:]
    return text.replace("{rows}", rows).replace("{tag}", tag)


P1 = p1_sql()


@query("q_resolve_p1", "stem:s source:s lat:d lon:d", "records grid", f"--cte {P1} select stem, source, lat, lon from p1")
def _(records, grid):
    """Pass 1 of the cascade: cell, then section."""
    return first_pass(records, grid)


def first_pass(records: DataFrame, grid: DataFrame) -> DataFrame:
    stats = written(mining.direction_stats(grid), "stats")
    ready = cascade.prepared(records.drop("centroid"), stats)
    return cascade.pass1(ready, *(written(g, "grid") for g in cascade.grid_maps(grid)))


P2 = """
 m0 as (select r.stem, r.section, r.twp, r.rng, r.dot_row, r.dot_col, split_part(lower(trim(r.county)), ' ', 1) pat, case when r.ns is not null then [r.ns] else list_concat(t.nt, list_filter(['N', 'S'], lambda v: not list_contains(t.nt, v))) end nn,
    case when r.ew is not null then [r.ew] else list_concat(t.et, list_filter(['W', 'E'], lambda v: not list_contains(t.et, v))) end ee
  from records r join (select distinct stem, nt, et from tries) t using (stem) join p1 using (stem) where p1.source = 'rds_miss'),
 m1 as (select *, unnest(range(len(nn))) i from m0), m2 as (select *, unnest(range(len(ee))) j from m1),
 m3 as (select *, nn[i + 1] d1, ee[j + 1] d2, i * len(ee) + j k from m2),
 pos as (select distinct stem, q, rx, ry from parts),
 csec as (select sect, twp, ns, rng, ew, county, min(minx) a, min(miny) b, max(maxx) c, max(maxy) d from grid group by all),
 incell as (select m3.stem, k as rank, 'direction_inferred_p2_' || d1 || d2 source, minx x0, miny y0, maxx x1, maxy y1 from m3 join pos using (stem) join grid g on g.sect = section and g.twp = m3.twp and g.rng = m3.rng and g.ns = d1 and g.ew = d2 and g.quad = q and contains(lower(g.county), pat)),
 near as (select m3.stem, dot_row, dot_col, case when delta = 0 then 100 + k else 200 + k * 4 + base end as rank, case when delta = 0 then 'direction_inferred_p2_' || d1 || d2 else 'sect_adj_p2_' || (section + delta) || '_' || d1 || d2 end source, min(a) a, min(b) b, max(c) c, max(d) d
  from m3, (values (0, 0), (-1, 0), (1, 1), (-2, 2), (2, 3)) s(delta, base) join csec g on g.sect = section + delta and g.twp = m3.twp and g.rng = m3.rng and g.ns = d1 and g.ew = d2 and contains(lower(g.county), pat) group by all),
 tried2 as (from incell union all select stem, rank, source, a + (dot_col - 1) * (c - a) / 8, d - dot_row * (d - b) / 8, a + dot_col * (c - a) / 8, d - (dot_row - 1) * (d - b) / 8 from near),
 p2 as (select stem, source, round(y1 + (y0 - y1) * ry, 7) lat, round(x0 + (x1 - x0) * rx, 7) lon from tried2 join pos using (stem)
  where y1 + (y0 - y1) * ry between 33.6 and 37.1 and x0 + (x1 - x0) * rx between -103.1 and -94.4 qualify row_number() over (partition by stem order by rank, source, lat, lon) = 1)
"""
P3 = """
 inv as (select r.*, t.nt, t.et, lower(trim(r.county)) cl from records r join (select distinct stem, nt, et from tries) t using (stem) join p1 using (stem) where p1.source = 'bounds_invalid'),
 pats as (select *, list_distinct([cl, trim(regexp_replace(cl, '\\s+county\\.?$', '')), split_part(cl, ' ', 1)]) u from inv),
 pt as (select *, unnest(list_sort(u, 'DESC')) pat from pats),
 t1 as (select *, unnest(range(len(et))) i from pt where twp is null and rng is not null), g1 as (select sect, rng, ew, county, twp, ns, count(*) n from grid group by all),
 c1 as (select t1.stem, i, pat, et[i + 1] dd, g.twp v, g.ns vd, sum(n) n from t1 join g1 g on g.sect = section and g.rng = t1.rng and g.ew = et[i + 1] and contains(lower(g.county), pat) group by all),
 d1 as (select *, lead(n) over w nx, row_number() over w k from c1 window w as (partition by stem, i, pat order by n desc, v, vd)),
 f1 as (select stem, v twp, vd ns, dd ew from d1 where k = 1 and (nx is null or n >= 4 * nx) qualify row_number() over (partition by stem order by i, pat desc) = 1),
 t2 as (select *, unnest(range(len(nt))) i from pt where rng is null and twp is not null), g2 as (select sect, twp, ns, county, rng, ew, count(*) n from grid group by all),
 c2 as (select t2.stem, i, pat, nt[i + 1] dd, g.rng v, g.ew vd, sum(n) n from t2 join g2 g on g.sect = section and g.twp = t2.twp and g.ns = nt[i + 1] and contains(lower(g.county), pat) group by all),
 d2 as (select *, lead(n) over w nx, row_number() over w k from c2 window w as (partition by stem, i, pat order by n desc, v, vd)),
 f2 as (select stem, dd ns, v rng, vd ew from d2 where k = 1 and (nx is null or n >= 4 * nx) qualify row_number() over (partition by stem order by i, pat desc) = 1),
 p3 as (select stem, f1.twp, f1.ns, r.rng, f1.ew, 'twp' missing from f1 join records r using (stem) union all select stem, r.twp, f2.ns, f2.rng, f2.ew, 'rng' from f2 join records r using (stem))
"""


@query("q_resolve_p2", "stem:s source:s lat:d lon:d", "records grid", f"--cte {P1}, {P2} select stem, source, lat, lon from p2")
def _(records, grid):
    """Pass 2: misses by directions, then by neighbouring sections of their county."""
    stats = written(mining.direction_stats(grid), "stats")
    return cascade.pass2(written(first_pass(records, grid).where("source = 'rds_miss'"), "misses"), grid, stats)


@query("q_resolve_p3", "stem:s twp:l ns:s rng:l ew:s missing:s", "records grid", f"--cte {P1}, {P3} select stem, twp, ns, rng, ew, missing from p3")
def _(records, grid):
    """Pass 3: a missing township or range by its county's grid."""
    return cascade.pass3(written(first_pass(records, grid).where("source = 'bounds_invalid'"), "invalid"), grid)


@query(
    "q_resolve_p5", "stem:s lat:d lon:d", "records grid",
    f"""--cte {P1}, best as (select stem, (b + d) / 2 lat, (a + c) / 2 lon from parts p join secbox g on g.sect = section and g.twp = p.twp and g.rng = p.rng and g.ns = tn and g.ew = te qualify row_number() over (partition by stem order by k) = 1)
    select stem, lat, lon from best join records using (stem) where centroid""",
)
def _(records, grid):
    """Pass 5: section centres."""
    ready = cascade.prepared(records.where("centroid").drop("centroid"), mining.direction_stats(grid))
    return cascade.centroids(ready, cascade.grid_maps(grid)[0])


_LEASE = "regexp_replace(regexp_extract(stem, '^[^_]+_(.+)_[0-9]+$', 1), '\\s+[0-9]+$', '')"
_FLAG = "case when x_norm is null or y_norm is null then 'cell_centre_used' else '' end"
_KEEP = "section, county, dot_row, dot_col, x_norm, y_norm"
ASLEEP = """union all select r.* from records r where not centroid and skipped and dot_row is not null and dot_col is not null and dot_confidence > 0 and (section is null or twp is null or rng is null)"""


def all_sql(skipped: bool = False) -> str:
    """The whole cascade; with skipped rows, of which only the fourth pass takes those that it can complete."""
    awake = " and not skipped" if skipped else ""
    return (
    f"open as (select * from records where not centroid{awake}), {p1_sql('open')}, {P2.replace('from records r', 'from open r')}, {P3.replace('records r', 'open r')}, "
    + f"rows3 as (select stem, {_KEEP}, p3.twp, coalesce(p3.ns, r.ns) ns, p3.rng, coalesce(p3.ew, r.ew) ew, missing from p3 join open r using (stem)), {p1_sql('rows3', '_3')}, "
    + f"""sofar as (
      select r.stem, p1.source, p1.lat, p1.lon, {_FLAG} flags, r.twp, r.ns, r.rng, r.ew, county from p1 join open r using (stem) where p1.lat is not null
      union all select r.stem, p2.source, p2.lat, p2.lon, p2.source, r.twp, r.ns, r.rng, r.ew, county from p2 join open r using (stem)
      union all select r.stem, 'p3_' || missing || '_' || p.source, p.lat, p.lon, {_FLAG}, r.twp, r.ns, r.rng, r.ew, county from p1_3 p join rows3 r using (stem) where p.lat is not null
    ), lease as (select upper({_LEASE}) lease, county, min(twp || coalesce(ns, '')) t, max(twp || coalesce(ns, '')) t2, min(rng || coalesce(ew, '')) g, max(rng || coalesce(ew, '')) g2, min(section::varchar) s, max(section::varchar) s2 from sofar join (select stem, section from records) using (stem) group by all),
    needy as (select r.* from open r join p1 using (stem) where p1.source = 'bounds_invalid' and stem not in (select stem from sofar) {ASLEEP if skipped else ''}),
    rows4 as (select stem, coalesce(r.section, s::int) section, r.county, dot_row, dot_col, x_norm, y_norm, case when r.twp is null and t = t2 then regexp_extract(t, '^([0-9]+)', 1)::int else r.twp end twp, case when r.twp is null and t = t2 then coalesce(nullif(regexp_extract(t, '([NS])$', 1), ''), ns) else ns end ns,
      case when r.rng is null and g = g2 then regexp_extract(g, '^([0-9]+)', 1)::int else r.rng end rng, case when r.rng is null and g = g2 then coalesce(nullif(regexp_extract(g, '([EW])$', 1), ''), ew) else ew end ew,
      concat_ws('; ', case when r.section is null then 'p4_sect_inferred:' || s end, case when r.twp is null then 'p4_twp_inferred:' || t end, case when r.rng is null then 'p4_rng_inferred:' || g end) tags
      from needy r join lease l on l.lease = upper({_LEASE}) and l.county = r.county where (r.section is not null or s = s2) and (r.twp is not null or t = t2) and (r.rng is not null or g = g2)), {p1_sql('rows4', '_4')}, """
    + f"cen as (select * from records where centroid), {p1_sql('cen', '_5')}, "
    + f"""five as (select r.stem, (b + d) / 2 lat, (a + c) / 2 lon, tn || te dir from parts_5 r join secbox_5 g on g.sect = section and g.twp = r.twp and g.rng = r.rng and g.ns = tn and g.ew = te qualify row_number() over (partition by stem order by k) = 1),
    placed as (
      select stem, source, lat, lon, flags from sofar union all select stem, 'p4_' || p.source, p.lat, p.lon, tags || case when {_FLAG} = '' then '' else '; ' || {_FLAG} end from p1_4 p join rows4 using (stem) where p.lat is not null
      union all select stem, 'section_centroid', round(lat, 7), round(lon, 7), 'approx_section_center; direction:' || dir from five
    ), everything as (
      from placed union all select stem, source, null, null, case when source = 'rds_miss' then '' when r.twp is null then 'township_invalid:None' else 'range_invalid:None' end from p1 join open r using (stem) where stem not in (select stem from placed)
      union all select stem, 'centroid_miss', null, null, '' from cen where stem not in (select stem from placed))
    """
)


ALL = "--cte " + all_sql()


@query("q_resolve_all", "stem:s source:s lat:d lon:d flags:s", "records grid", ALL + " select * from everything")
def _(records, grid):
    """All passes of the cascade."""
    return cascade.resolve(records, grid).withColumn("flags", F.array_join("flags", "; "))


@query(
    "q_method_families", "family:s n:l", "records grid",
    ALL + " select case when source like 'p3%' then 'pass3' when source like 'p4%' then 'pass4' when contains(source, '_p2_') then 'pass2' when source = 'section_centroid' then 'centroid' else source end family, count(*) n from everything where lat is not null group by all",
)
def _(records, grid):
    """Resolved records by the pass that placed them."""
    return reports.method_families(cascade.resolve(records, grid).where("lat is not null"))


#: Directions by the limits of the county that its name, or the first in order that begins with its first word, has.
CONSTRAINED = """prepared{tag} as (
  with lim as (select county cn, trim(regexp_replace(lower(trim(county)), '\\s+county\\.?$', '')) base, list(distinct ns order by ns) nv, list(distinct ew order by ew) ev, max(twp) mt, max(rng) mr from grid group by county),
  own as (select distinct county, trim(regexp_replace(lower(trim(county)), '\\s+county\\.?$', '')) base from {rows}),
  met as (select own.county, coalesce((select min(l.base) from lim l where l.base = own.base), (select min(l.base) from lim l where starts_with(l.base, own.base)), (select min(l.base) from lim l where starts_with(l.base, split_part(own.base, ' ', 1)))) base from own)
  select r.*, case when ns is not null then [ns] when nv is null then ['N', 'S'] when len(nv) = 1 then nv when r.twp <= mt and list_contains(nv, 'N') then ['N'] else nv end nt,
    case when ew is not null then [ew] when ev is null then ['W', 'E'] when len(ev) = 1 then ev when r.rng is null or len(list_filter(ev, lambda e: r.rng <= case when e = 'W' then mr else 26 end)) = 0 then ev else list_filter(ev, lambda e: r.rng <= case when e = 'W' then mr else 26 end) end et
  from {rows} r left join met using (county) left join lim on lim.base = met.base
)"""


@query("q_directions_constraints", "stem:s ns:s ew:s", "records grid", "--cte " + CONSTRAINED.replace("{tag}", "").replace("{rows}", "records") + " select stem, array_to_string(nt, ',') ns, array_to_string(et, ',') ew from prepared")
def _(records, grid):
    """Directions to try by the limits of each record's county."""
    tried = cascade.constrained(records, mining.county_constraints(grid))
    return tried.select("stem", F.array_join("ns_try", ",").alias("ns"), F.array_join("ew_try", ",").alias("ew"))


@query("q_resolve_constraints", "stem:s source:s lat:d lon:d", "records grid", f"--cte {p1_sql(directions=CONSTRAINED)} select stem, source, lat, lon from p1")
def _(records, grid):
    """Pass 1 of the cascade with directions by the counties' limits."""
    ready = cascade.prepared(records.drop("centroid"), None, mining.county_constraints(grid))
    return cascade.pass1(ready, *(written(g, "grid") for g in cascade.grid_maps(grid)))


SLEEPY = "records as (select stem, case when location_status = 'skipped' and rec_id % 2 = 0 then null else section end section, twp, ns, rng, ew, county, dot_row, dot_col, x_norm, y_norm, centroid, location_status = 'skipped' skipped, dot_confidence from status)"


@query("q_resolve_p4", "stem:s source:s lat:d lon:d flags:s", "status grid", f"--cte {SLEEPY}, {all_sql(True)} select * from everything where source like 'p4%'")
def _(s, grid):
    """Pass 4: what records lack, sections of skipped ones too, by their lease's other records."""
    asleep = F.col("location_status") == "skipped"
    rows = s.select("stem", F.when(~(asleep & (F.col("rec_id") % 2 == 0)), F.col("section")).alias("section"), "twp", "ns", "rng", "ew", "county", "dot_row", "dot_col", "x_norm", "y_norm", "centroid", asleep.alias("skipped"), "dot_confidence")
    return cascade.resolve(rows, grid).where("source like 'p4%'").withColumn("flags", F.array_join("flags", "; "))


LEASED = "(select *, regexp_replace(regexp_extract(stem, '^[^_]+_(.+)_[0-9]+$', 1), '\\s+[0-9]+$', '') lease from records)"


@query("q_lease_consensus", "lease:s county:s twp:l rng:l", "records", f"select lease, county, case when min(twp) = max(twp) then min(twp) end twp, case when min(rng) = max(rng) then min(rng) end rng from {LEASED} group by all")
def _(records):
    """Values on which all records of a lease agree."""
    return mining.consensus(records.withColumn("lease", fields.lease_name("stem")), ["lease", "county"], ["twp", "rng"])


@query("q_county_consistency", "verdict:s n:l", "records grid", "--cte g as (select sect, twp, ns, rng, ew, list(distinct county) cs from grid group by all) select case when cs is null then 'no_section' when list_contains(cs, county) and len(cs) = 1 then 'agree' when list_contains(cs, county) then 'border' else 'mismatch' end verdict, count(*) n from records r left join g on g.sect = section and g.twp = r.twp and g.ns = r.ns and g.rng = r.rng and g.ew = r.ew group by all")
def _(records, grid):
    """Extracted county against the counties of the section."""
    return mining.county_consistency(records, grid).groupBy("verdict").agg(F.count("*").alias("n"))


@query("q_top_mismatches", "county:s grid_counties:s n:l", "records grid", "--cte g as (select sect, twp, ns, rng, ew, string_agg(distinct county, '|' order by county) cs from grid group by all) select r.county, cs grid_counties, count(*) n from records r join g on g.sect = section and g.twp = r.twp and g.ns = r.ns and g.rng = r.rng and g.ew = r.ew where not list_contains(string_split(cs, '|'), county) group by all order by n desc, county, grid_counties limit 8")
def _(records, grid):
    """The commonest disagreements of county and section."""
    return reports.top_mismatches(mining.county_consistency(records, grid))


@query("q_county_pinned", "stem:s ns:s ew:s", "records grid", "--cte c as (select distinct county, sect, twp, rng, ns gn, ew ge from grid) select stem, min(gn) ns, min(ge) ew from records r join c on c.county = r.county and sect = section and c.twp = r.twp and c.rng = r.rng and (ns is null or ns = gn) and (ew is null or ew = ge) group by stem having count(*) = 1")
def _(records, grid):
    """Directions that only one choice in the county allows."""
    return mining.pinned(records, grid)


@query("q_dominance_infer", "sect:l rng:l ew:s county:s twp:l ns:s n:l", "grid", "--cte c as (select sect, rng, ew, county, twp, ns, count(*) n from grid group by all), r as (select *, lead(n) over w nx, row_number() over w k from c window w as (partition by sect, rng, ew, county order by n desc, twp, ns)) select * from r where k = 1 and (nx is null or n >= 4 * nx)")
def _(grid):
    """Townships that a county's grid leaves no doubt about."""
    counts = grid.groupBy("sect", "rng", "ew", "county", "twp", "ns").agg(F.count("*").alias("n"))
    return mining.dominant(counts, ["sect", "rng", "ew", "county"], ["twp", "ns"])


# --- reconcile ---------------------------------------------------------------

SITE = "(select stem, rec_id, rec_id % 4 = 0 verified, rec_id % 40 = 0 corrected from records where rec_id % 3 = 0)"
COORDS = "(select stem, case when section % 5 > 1 then section * 1e0 end lat from records where rec_id % 5 > 0)"


def _site(records):
    return records.where("rec_id % 3 = 0").select("stem", "rec_id", (F.col("rec_id") % 4 == 0).alias("verified"), (F.col("rec_id") % 40 == 0).alias("corrected"))


def _coords(records):
    return records.where("rec_id % 5 > 0").select("stem", F.when(F.col("section") % 5 > 1, F.col("section").cast("double")).alias("lat"))


@query(
    "q_reconcile_ledger", "stem:s state:s failed_stage:s", "records status",
    f"""--cte st as (select * from status where rec_id % 7 > 0)
    select r.stem, case when m.stem is not null then 'mapped' when c.lat is not null then 'resolved' when f is not null then 'failed' when s.stem is not null then 'processed' else 'untouched' end state, f failed_stage
    from records r left join (select stem, case when latlong_status = 'failed' then 'latlong' when grid_status = 'failed' then 'grid' when location_status = 'failed' then 'location' when county_status = 'failed' then 'county' when dot_status = 'failed' then 'dot' end f from st) s using (stem)
      left join {COORDS} c using (stem) left join {SITE} m using (stem)""",
)
def _(records, s):
    """State of every record of the index."""
    return reconcile.ledger(records.select("stem"), s.where("rec_id % 7 > 0"), _coords(records), _site(records))


@query("q_orphans", "stem:s kind:s", "records status", f"--cte i as (select stem from records where rec_id % 11 > 0) select stem, 'status_not_in_index' kind from status where stem not in (select stem from i) union all select stem, 'site_not_in_index' from {SITE} where stem not in (select stem from i) union all select stem, 'site_not_in_coords' from {SITE} where stem not in (select stem from {COORDS})")
def _(records, s):
    """Stems that one table has and another lacks."""
    return reconcile.orphans(records.where("rec_id % 11 > 0"), s, _coords(records), _site(records))


@query("q_monotonic_publish", "stem:s verified:b corrected:b carried:b", "records", f"--cte n as (select stem from records where rec_id % 2 = 0), p as (select * from {SITE}) select stem, coalesce(verified, false) verified, coalesce(corrected, false) corrected, false carried from n left join p using (stem) union all select stem, verified, corrected, true from p where stem not in (select stem from n)")
def _(records):
    """A build that keeps prior features and human marks."""
    return reconcile.published(records.where("rec_id % 2 = 0").select("stem"), _site(records))


@query("q_backfill", "stem:s collection_num:l year:l", "records", "select stem, case when rec_id % 6 = 5 then null else collection_num end collection_num, case when rec_id % 6 = 5 then null else year end as year from records")
def _(records):
    """Missing metadata from the first complete source."""
    rows = records.select("stem", F.when(F.col("rec_id") % 3 == 0, F.col("collection_num")).alias("collection_num"), F.when(F.col("rec_id") % 3 == 0, F.col("year")).alias("year"))
    return reconcile.backfilled(rows, records.where("rec_id % 3 = 1"), records.where("rec_id % 6 = 2"), columns=("collection_num", "year"))


@query("q_completed_groups", "collection_num:l year:l month:l n:l", "status", "--cte f as (select stem from status where latlong_status in ('done', 'skipped', 'failed') and location_status in ('done', 'skipped', 'failed') and grid_status in ('done', 'skipped', 'failed') and county_status in ('done', 'skipped', 'failed') and dot_status in ('done', 'skipped', 'failed')) select collection_num, year, month, count(*) n from status left join f using (stem) group by all having count(f.stem) >= count(*) and month % 6 > 0")
def _(s):
    """Groups that are finished and not published."""
    done = s.where("month % 6 = 0").select("collection_num", "year", "month").distinct()
    return reconcile.completed_groups(s.select("stem", "collection_num", "year", "month"), s, done, ["collection_num", "year", "month"])


@query("q_failed_export", "stem:s failed_stages:s", "records status", "select stem, array_to_string(list_filter([case when latlong_status = 'failed' then 'latlong' end, case when grid_status = 'failed' then 'grid' end, case when location_status = 'failed' then 'location' end, case when county_status = 'failed' then 'county' end, case when dot_status = 'failed' then 'dot' end], lambda x: x is not null), ',') failed_stages from status where 'failed' in (latlong_status, grid_status, location_status, county_status, dot_status)")
def _(records, s):
    """Failed records with their failed stages."""
    return reconcile.failed_export(records.select("stem"), s)


@query("q_review_queue", "category:s n:l", "status", f"--cte o as (select * from status where stem not in (select stem from {COORDS.replace('from records', 'from status')} where lat is not null)), c as (select case when dot_status = 'done' and (twp is null or rng is null) then 'dot_without_survey' when twp is not null and rng is not null and dot_status <> 'done' then 'survey_without_dot' else 'partial_survey' end category from o) select category, count(*) n from c group by all")
def _(s):
    """Worklists of what unresolved records lack."""
    return reconcile.worklists(s, _coords(s)).groupBy("category").agg(F.count("*").alias("n"))


CHANGES = "(select stem, 'twp' field, (rec_id % 7 + 1)::varchar as new, rec_id as issue from records where rec_id % 50 = 0 union all select stem, 'twp', (rec_id % 4 + 1)::varchar, rec_id + 1 from records where rec_id % 100 = 0 union all select stem, 'rng', '9', rec_id from records where rec_id % 70 = 0)"


def _changes(records):
    change = lambda k, field, new, by=0: records.where(F.col("rec_id") % k == 0).select("stem", F.lit(field).alias("field"), new.cast("string").alias("new"), (F.col("rec_id") + by).alias("issue"))
    return change(50, "twp", F.col("rec_id") % 7 + 1).unionByName(change(100, "twp", F.col("rec_id") % 4 + 1, 1)).unionByName(change(70, "rng", F.lit(9)))


@query("q_corrections_apply", "stem:s twp:l rng:l", "records", f"--cte l as (select stem, field, arg_max(new, issue) as new from {CHANGES} group by all) select r.stem, coalesce(a.new::int, twp) twp, coalesce(b.new::int, rng) rng from records r left join l a on a.stem = r.stem and a.field = 'twp' left join l b on b.stem = r.stem and b.field = 'rng'")
def _(records):
    """Records after the corrections."""
    return reconcile.corrected(records.select("stem", "twp", "rng"), _changes(records), ["twp", "rng"])


@query("q_corrections_log", "stem:s field:s old:s new:s issue:l", "records", f"--cte l as (select stem, field, arg_max(new, issue) as new, max(issue) issue from {CHANGES} group by all) select stem, field, (case field when 'twp' then twp else rng end)::varchar old, l.new, issue from l join records using (stem) where old is distinct from l.new")
def _(records):
    """What the corrections change."""
    return reconcile.change_log(records.select("stem", "twp", "rng"), _changes(records), ["twp", "rng"])


PLACED = "select stem, field, new, issue from " + CHANGES + " union all select stem, 'lat', '35.25', rec_id + 2 from records where rec_id % 150 = 0 union all select stem, 'lon', '-97.5', rec_id + 2 from records where rec_id % 210 = 0"


@query(
    "q_corrections_resolve", "stem:s twp:l rng:l lat:d lon:d resolution:s note:s corrected:b", "records grid",
    f"""--cte log as ({PLACED}), l as (select stem, max_by(new, issue) filter (field = 'twp')::int t, max_by(new, issue) filter (field = 'rng')::int g, max(new) filter (field = 'lat')::double la, max(new) filter (field = 'lon')::double lo from log group by stem),
    now as (select r.* replace (coalesce(t, twp) as twp, coalesce(g, rng) as rng), la, lo, l.stem is not null named, coalesce(t is distinct from twp and t is not null, false) or coalesce(g is distinct from rng and g is not null, false) moved,
      case when rec_id % 3 > 0 then 35.0e0 end olat, case when rec_id % 3 > 0 then -97.0e0 end olon, coalesce(la, olat) nlat, coalesce(lo, olon) nlon, la is not null or lo is not null given from records r left join l using (stem)),
    movers as (select * exclude (la, lo, named, moved, olat, olon, nlat, nlon, given) from now where moved and not given),
    {p1_sql("movers", "c")}, x as (select now.*, p.lat plat, p.lon plon, p.source, case when given and nlat is not null and nlon is not null then 'human_latlong' when given then 'latlong_incomplete' when moved and p.lat is not null then 'reresolved' when moved then 'needs_rerun' when named then 'no_change' end note from now left join p1c p using (stem))
    select stem, twp, rng, case note when 'human_latlong' then nlat when 'reresolved' then plat else olat end lat, case note when 'human_latlong' then nlon when 'reresolved' then plon else olon end lon,
      case note when 'human_latlong' then note when 'reresolved' then source when 'needs_rerun' then 'map+needs-coord-rerun' else 'map' end resolution, note, moved or coalesce(note = 'human_latlong', false) corrected from x""",
)
def _(records, grid):
    """Corrected records with the coordinates of their new fields or of the override."""
    extra = lambda field, k, new: records.where(F.col("rec_id") % k == 0).select("stem", F.lit(field).alias("field"), F.lit(new).alias("new"), (F.col("rec_id") + 2).alias("issue"))
    log = _changes(records).unionByName(extra("lat", 150, "35.25")).unionByName(extra("lon", 210, "-97.5"))
    known = lambda v: F.when(F.col("rec_id") % 3 > 0, F.lit(v))
    rows = records.withColumns({"lat": known(35.0), "lon": known(-97.0), "resolution": F.lit("map")})
    return reconcile.reapplied(rows, log, lambda moved: first_pass(moved.drop("lat", "lon", "resolution"), grid))


@query("q_missing_objects", "stem:s key:s", "records", "select stem, concat_ws('/', 'pdf', collection_num, year, stem || '.pdf') as key from records where rec_id % 9 = 0")
def _(records):
    """Records without a stored object and their keys."""
    return reconcile.missing_objects(records, records.where("rec_id % 9 > 0"), "pdf")


@query("q_agreement", "field:s n:l agree:l agree_pct:l", "records", "--cte v as (select stem, twp % 3 + 1 twp, rng from records where rec_id % 2 = 0), m as (select r.twp a, v.twp b, r.rng c, v.rng d from records r join v using (stem)) select 'twp' field, count(*) filter (a is not null and b is not null) n, count(*) filter (a = b) agree, count(*) filter (a = b) * 100 // count(*) filter (a is not null and b is not null) agree_pct from m union all select 'rng', count(*) filter (c is not null and d is not null), count(*) filter (c = d), count(*) filter (c = d) * 100 // count(*) filter (c is not null and d is not null) from m")
def _(records):
    """Agreement of a candidate extraction with verified values."""
    verified = records.where("rec_id % 2 = 0").select("stem", (F.col("twp") % 3 + 1).alias("twp"), "rng")
    return reports.agreement(records, verified, ["twp", "rng"])


@query("q_upper_median", "collection_num:l median:l", "records", "select collection_num, (list(file_size_bytes order by file_size_bytes))[count(*) // 2 + 1] median from records group by all")
def _(records):
    """The upper middle size of each collection."""
    return reports.upper_median(records, "collection_num", "file_size_bytes")


@query("q_top_per_group", "year:l county:s n:l rank:l", "records", "--cte c as (select year, county, count(*) n from records group by all) select year, county, n, row_number() over (partition by year order by n desc, county) as rank from c qualify rank <= 3")
def _(records):
    """The commonest counties of each year."""
    return reports.top_per_group(records, "year", "county")


@query("q_cross_table", "year:l c1:l c13:l", "records", "select year, count(*) filter (collection_num = 1) c1, count(*) filter (collection_num = 13) c13 from records where collection_num in (1, 13) group by all")
def _(records):
    """Records by year and collection."""
    wide = reports.cross_table(records.where("collection_num in (1, 13)"), "year", "collection_num", [1, 13])
    return wide.select("year", F.col("1").alias("c1"), F.col("13").alias("c13"))


# --- sampling ----------------------------------------------------------------

ORDERED = "(rec_id * 7919 + 13 * 104729) % 1000003"


@query("q_sample_group", "collection_num:l year:l rec_id:l", "records", f"select collection_num, year, rec_id from records qualify row_number() over (partition by collection_num, year order by {ORDERED}, rec_id) <= greatest(1, (count(*) over (partition by collection_num, year) + 99) // 100)")
def _(records):
    """One per cent of each group, one record at least."""
    return sampling.per_group_percent(records, ["collection_num", "year"], "rec_id")


@query("q_sample_k", "collection_num:l rec_id:l", "records", f"select collection_num, rec_id from records qualify row_number() over (partition by collection_num order by {ORDERED}, rec_id) <= 5")
def _(records):
    """Five records of each collection."""
    return sampling.per_group(records, ["collection_num"], "rec_id", 5)


@query("q_sample_density", "collection_num:l year:l month:l rec_id:l", "records", f"select collection_num, year, month, rec_id from records qualify row_number() over (partition by collection_num, year, month order by {ORDERED}, rec_id) <= greatest(count(*) over (partition by collection_num, year, month) // 20, case when count(*) over (partition by collection_num, year, month) >= 10 then 1 else 0 end)")
def _(records):
    """Samples in proportion to density."""
    return sampling.by_density(records, ["collection_num", "year", "month"], "rec_id", 20)


@query("q_first_last", "collection_num:l year:l month:l total:l position:s stem:s", "records", "--cte g as (select collection_num, year, month, min(stem) a, max(stem) b, count(*) total from records group by all) select collection_num, year, month, total, 'first' as position, a stem from g union all select collection_num, year, month, total, 'last', b from g where a <> b")
def _(records):
    """First and last name of each folder."""
    return sampling.first_and_last(records, ["collection_num", "year", "month"], "stem")


@query("q_next_chunk", "rec_id:l stem:s", "records status", "select rec_id, stem from records where stem not in (select stem from status where location_status in ('done', 'skipped')) order by rec_id limit 50")
def _(records, s):
    """The next records to work on."""
    return sampling.next_chunk(records.select("stem", "rec_id"), s.where("location_status in ('done', 'skipped')"), "rec_id", 50)


@query("q_slice_mod", "rec_id:l slice:l", "records", "select rec_id, (row_number() over (order by rec_id) - 1) % 7 slice from records")
def _(records):
    """Records dealt in turn to seven slices."""
    return sampling.exact_slices(records.select("rec_id"), "rec_id", 7)


@query("q_campaign_order", "rec_id:l priority:l", "records", "select rec_id, case county when 'C3 County' then 1 when 'C1 County' then 2 else 3 end priority from records")
def _(records):
    """Records by the user's order of counties."""
    return sampling.in_campaign_order(records, "county", ["C3 County", "C1 County"])


@query("q_holdout", "collection_num:l split:s n:l", "records", f"--cte r as (select collection_num, case when row_number() over (partition by collection_num order by {ORDERED}, rec_id) <= greatest(1, floor(count(*) over (partition by collection_num) * 0.1e0)) and collection_num in (1, 2) then 'holdout' else 'train' end split from records) select collection_num, split, count(*) n from r group by all")
def _(records):
    """Held-out rows by source."""
    rows = sampling.holdout(records.withColumn("src", F.col("collection_num").cast("string")), "src", "rec_id", only=("1", "2"))
    return rows.groupBy("collection_num", "split").agg(F.count("*").alias("n"))


@query("q_rate_window", "event_id:l in_window:l", "", "select event_id, count(*) over (partition by user_id order by epoch(ts)::bigint range between 3600 preceding and current row) in_window from events")
def _(spark, sf_dir):
    """Events of each user in the hour before each event."""
    return sampling.windowed_count(parquet(spark, sf_dir, "events"), "ts", 3600, "user_id")


# --- tokens and detections ---------------------------------------------------

NORMAL = "regexp_replace(lower(t), '[.\\s,;:\\-]+$', '')"


@query(
    "q_keyword_pairing", "doc_id:l sec_pos:l township_pos:l range_pos:l", "tokens",
    f"""--cte k as (select doc_id, pos, case when {NORMAL} in ('section', 'sec', 'sect') then 's' when {NORMAL} in ('township', 'twp', 'twn') then 't' when {NORMAL} in ('range', 'rge', 'rng') then 'r' end kind, x0, y0 - 50 a, y1 + 50 b from tokens),
    m as (select s.doc_id, s.pos sec_pos, min(o.pos) filter (o.kind = 't') township_pos, min(o.pos) filter (o.kind = 'r') range_pos from k s join k o on o.doc_id = s.doc_id and o.kind in ('t', 'r') and o.x0 > s.x0
      and greatest(0, least(s.b, o.b) - greatest(s.a, o.a)) / least(s.b - s.a, o.b - o.a) >= 0.35e0 where s.kind = 's' group by all)
    select * from m where township_pos is not null and range_pos is not null qualify row_number() over (partition by doc_id order by sec_pos) = 1""",
)
def _(t):
    """Labels of section, township and range on one line."""
    return tokens.paired(tokens.keyword_boxes(t))


@query("q_value_below", "doc_id:l label_pos:l value:s", "tokens", f"--cte l as (select * from tokens where {NORMAL} = 'section') select l.doc_id, l.pos label_pos, arg_min(o.t, (o.y0 - l.y0, o.t)) as value from l join tokens o on o.doc_id = l.doc_id and {NORMAL.replace('(t)', '(o.t)')} <> 'section' and abs((l.x0 + l.x1) / 2 - (o.x0 + o.x1) / 2) <= 55 and o.y0 - l.y0 between 10 and 160 group by all")
def _(t):
    """The value under each section label."""
    return tokens.value_below(t, "section")


@query(
    "q_left_right", "doc_id:l label_pos:l left_text:s right_text:s below_text:s", "tokens",
    f"""--cte l as (select * from tokens where {NORMAL} = 'rge'), m as (select l.doc_id, l.pos label_pos, o.pos, o.t, o.x0 - l.x0 dx, o.y0 - l.y0 dy from l left join tokens o on o.doc_id = l.doc_id and o.pos <> l.pos and o.pos between l.pos - 60 and l.pos + 100),
    g as (select doc_id, label_pos, list(t order by dx, pos, t) filter (abs(dy) <= 35 and dx < 0) a, list(t order by dx, pos, t) filter (abs(dy) <= 35 and dx > 0) b, list(t order by dy, pos, t) filter (abs(dx) <= 80 and dy between 5 and 120) c from m group by all)
    select doc_id, label_pos, coalesce(array_to_string(a[-4:], ' '), '') left_text, coalesce(array_to_string(b[1:4], ' '), '') right_text, coalesce(array_to_string(c[1:2], ' '), '') below_text from g""",
)
def _(t):
    """Tokens around each range label."""
    return tokens.beside(t, "rge")


@query("q_text_in_box", "doc_id:l box_pos:l kind:s text:s", "tokens", f"--cte k as (select doc_id, pos box_pos, 'township' kind, x0 a, y0 - 50 b, x1 + 400 c, y1 + 50 d from tokens where {NORMAL} in ('township', 'twp', 'twn')) select k.doc_id, box_pos, kind, string_agg(t, ' ' order by pos) as text from k join tokens o on o.doc_id = k.doc_id and (x0 + x1) / 2 between a and c and (y0 + y1) / 2 between b and d group by all")
def _(t):
    """Text right of each township label."""
    return tokens.text_in(t, tokens.keyword_boxes(t).where("kind = 'township'"))


@query("q_illegible", "doc_id:l n_tokens:l", "tokens", "select doc_id, count(*) n_tokens from tokens group by all having count(*) < 15")
def _(t):
    """Pages with too few tokens."""
    return tokens.illegible(t)


@query(
    "q_keyword_region", "doc_id:l x0:d y0:d x1:d y1:d how:s", "tokens",
    f"""--cte k as (select doc_id, pos, case when {NORMAL} in ('section', 'sec', 'sect') then 's' when {NORMAL} in ('township', 'twp', 'twn') then 't' when {NORMAL} in ('range', 'rge', 'rng') then 'r' end kind, x0 a, y0 - 50 b, x1 + 400 c, y1 + 50 d from tokens),
    l as (select * from k where kind is not null),
    near as (select s.doc_id, s.pos sp, o.pos op, o.kind, s.a, least(s.b, o.b) b, o.c, greatest(s.d, o.d) d, s.b sb, s.d sd from l s join l o on o.doc_id = s.doc_id and o.kind in ('t', 'r') and o.a > s.a and o.pos between s.pos - 80 and s.pos + 80
      and greatest(0, least(s.d, o.d) - greatest(s.b, o.b)) / least(s.d - s.b, o.d - o.b) >= 0.35e0 where s.kind = 's'),
    m as (select doc_id, sp, min(op) filter (kind = 't') tp, min(op) filter (kind = 'r') rp from near group by all),
    one as (select * from m where tp is not null and rp is not null qualify row_number() over (partition by doc_id order by sp) = 1),
    trip as (select l.doc_id, min(a) x0, min(b) y0, max(c) + 200 x1, max(d) y1, 'triplet' how, 0 r from one join l on l.doc_id = one.doc_id and l.pos in (sp, tp, rp) group by l.doc_id),
    two as (select doc_id, min(a) - 300 x0, min(b) - 80 y0, max(c) + 180 x1, max(d) + 80 y1, 'township_range' how, 1 r from l where kind <> 's' group by doc_id having count(distinct kind) = 2),
    three as (select doc_id, a - 100 x0, b - 80 y0, c + 500 x1, d + 80 y1, 'section_township' how, 2 r from near where kind = 't' qualify row_number() over (partition by doc_id order by sp, op) = 1)
    select doc_id, x0, y0, x1, y1, how from (from trip union all from two union all from three) qualify row_number() over (partition by doc_id order by r) = 1""",
)
def _(t):
    """The box to read on each page, around its labels."""
    return tokens.keyword_region(tokens.keyword_boxes(t)).select("doc_id", *[F.col(f"b{c}").alias(c) for c in ("x0", "y0", "x1", "y1")], "how")


@query(
    "q_form_classifier", "rec_id:l form_type:s grid_zone:s str_zone:s county_format:s str_strategy:s suspect:b", "records",
    """--cte g as (select rec_id, (rec_id % 100) / 100e0 x, (rec_id * 7 % 100) / 100e0 y, (rec_id % 20) / 10e0 + 0.1e0 ar, case when rec_id % 11 = 0 then 'locate well correctly' when rec_id % 13 = 0 then 'spot well' when rec_id % 3 = 0 then 'locate well' else '' end a, collection_num <= 8 early from records),
    z as (select *, case when y > 0.5 and x < 0.45 then 'bottom_left' when y > 0.5 then 'unknown' when x < 0.3 then 'top_left' when x <= 0.58 then 'top_center' else 'top_right' end z from g),
    k as (select *, case when z = 'bottom_left' then 'T1_LARGE' when z = 'top_left' and a = '' then 'T4_NOANCHOR' when z = 'top_left' and a = 'locate well' and ar < 0.75 then 'T3_SMALL' when z = 'top_left' then 'T2_MED'
      when early or z = 'unknown' then 'UNKNOWN' when z = 'top_center' then 'MID' else 'LATE' end k from z)
    select rec_id, k form_type, z grid_zone, case k when 'T1_LARGE' then 'top_header' when 'T2_MED' then 'right_of_grid' when 'T3_SMALL' then 'upper_right' when 'T4_NOANCHOR' then 'upper_right' when 'UNKNOWN' then 'any' else 'left_of_grid' end str_zone,
      case when k in ('T1_LARGE', 'T2_MED') then 'name_county' when k = 'LATE' then 'stacked' else 'any' end county_format, case when k in ('T4_NOANCHOR', 'LATE') then 'vertical_stack' when k = 'UNKNOWN' then 'any' else 'horizontal_group' end str_strategy,
      not (x between 0.5e0 - 0.08e0 and 0.9e0 + 0.08e0 and y between 0.1e0 - 0.08e0 and 0.4e0 + 0.08e0) suspect from k""",
)
def _(records):
    """Kind of form by where its grid stands, what it means for later stages, and whether the grid is suspect."""
    cx, cy = (F.col("rec_id") % 100) / 100, (F.col("rec_id") * 7 % 100) / 100
    anchor = F.when(F.col("rec_id") % 11 == 0, "LOCATE WELL CORRECTLY").when(F.col("rec_id") % 13 == 0, "Spot Well").when(F.col("rec_id") % 3 == 0, "locate well")
    hints = geometry.form_hints(cx, cy, (F.col("rec_id") % 20) / 10 + 0.1, anchor, fields.tier("collection_num"))
    return records.select("rec_id", hints.alias("h"), geometry.suspect(cx, cy, F.lit(0.5), F.lit(0.1), F.lit(0.9), F.lit(0.4)).alias("suspect")).select("rec_id", "h.*", "suspect")


BOXES = "select rec_id stem, detector, 1 as page, 'early' tier, 100 + (rec_id * (3 + k)) % 600 w, 100 + (rec_id * (5 + k)) % 500 h, (rec_id * (7 + k)) % 100 / 100e0 density, 800 page_w, 700 page_h from records, (values ('adaptive', 1), ('otsu', 2), ('canny', 3)) d(detector, k)"


@query("q_best_grids", "stem:l detector:s confidence:l", "records", f"--cte c as ({BOXES}) select stem, detector, least(100, floor(density * 100)) confidence from c where w >= 50 and h >= 50 and w / h::double between 0.6e0 and 1.7e0 and w * h / (page_w * page_h)::double < 0.92e0 and density >= 0.15e0 and w <= 565 qualify row_number() over (partition by stem order by density desc, w * h, detector) = 1")
def _(records):
    """The densest acceptable grid candidate of each record."""
    k = F.inline(F.array(*[F.struct(F.lit(n).alias("detector"), F.lit(i).alias("k")) for n, i in (("adaptive", 1), ("otsu", 2), ("canny", 3))]))
    size = lambda base, step, by: base + (F.col("rec_id") * (step + F.col("k"))) % by
    c = records.select("rec_id", k).select(
        F.col("rec_id").alias("stem"), "detector", F.lit(1).alias("page"), F.lit("early").alias("tier"), size(100, 3, 600).alias("w"), size(100, 5, 500).alias("h"), ((F.col("rec_id") * (7 + F.col("k"))) % 100 / 100).alias("density"), F.lit(800).alias("page_w"), F.lit(700).alias("page_h")
    )
    return detections.best_grids(c)


# --- fields without a text of their own in the tables -------------------------

_CELL = "greatest(1, least(8, floor({v} * 8)::int + 1))"


@query(
    "q_cell_geometry", "rec_id:l row:l col:l tl_lon:d br_lat:d lat:d lon:d", "records",
    f"""--cte p as (select rec_id, x_norm x, y_norm y, {_CELL.format(v='y_norm')} r, {_CELL.format(v='x_norm')} c from records where x_norm is not null and y_norm is not null)
    select rec_id, r as row, c col, -98 + (c - 1) / 8e0 tl_lon, 36 - r / 8e0 br_lat, (36 - (r - 1) / 8e0) * (1 - y) + (36 - r / 8e0) * y lat, (-98 + (c - 1) / 8e0) * (1 - x) + (-98 + c / 8e0) * x lon from p""",
)
def _(records):
    """Cells of positions, their corners in a section's box, and a position between corners."""
    rows = records.where("x_norm is not null and y_norm is not null").withColumn("k", geometry.xy_to_cell("x_norm", "y_norm"))
    rows = rows.withColumn("q", geometry.cell_corners(F.lit(-98.0), F.lit(35.0), F.lit(-97.0), F.lit(36.0), "k.row", "k.col"))
    rows = rows.withColumn("p", geometry.interpolated("q", "x_norm", "y_norm"))
    return rows.select("rec_id", "k.row", "k.col", F.col("q.tl.lon").alias("tl_lon"), F.col("q.br.lat").alias("br_lat"), "p.lat", "p.lon")


NOTES = ("C SW SW", "NW NE NW", "sw se", "NE", "no quarter", "")


@query(
    "q_notation", "rec_id:l kind:s label:s", "records",
    f"""--cte n as (select rec_id, upper(trim(({sql_list(NOTES)})[rec_id % {len(NOTES)} + 1])) t from records), p as (select *, list_filter(regexp_split_to_array(t, '\\s+'), lambda x: x in ('NW', 'NE', 'SW', 'SE')) q from n)
    select rec_id, case when regexp_matches(t, '^C\\b') and len(q) > 0 then 'center' when len(q) >= 3 then 'three_level' when len(q) = 2 then 'two_level' when len(q) = 1 then 'one_level' else '' end kind,
      case when len(q) >= 3 then q[3] || '-' || q[2] || '-' || q[1] when len(q) = 2 then q[2] || '-' || q[1] || '-NW' end label from p""",
)
def _(records):
    """Printed quarters to labels."""
    text = F.get(F.array(*map(F.lit, NOTES)), (F.col("rec_id") % len(NOTES)).cast("int"))
    return records.select("rec_id", geometry.notation(text).alias("x")).select("rec_id", F.col("x.type").alias("kind"), "x.label")


WELLS = ("a salt water well", "gas well number two", "an oil  production unit", "gasoline and crude", "nothing here", "gas produced")


@query(
    "q_well_type", "doc_id:l by_text:s by_name:s", "",
    f"""with {with_form_sql(WELLS)} select doc_id, case when regexp_matches(t, '(?i)\\b(salt\\s+water|saltwater|swd|disposal|injection)\\b') then 'water/disposal' when regexp_matches(t, '(?i)\\bgas\\s+(well\\b|unit\\b|prod)') then 'gas'
      when regexp_matches(t, '(?i)\\boil\\s+(well\\b|prod)|\\bcrude\\b') then 'oil' when regexp_matches(t, '(?i)\\bgas\\b') then 'gas' when regexp_matches(t, '(?i)\\boil\\b') then 'oil' else '' end by_text,
      case doc_id % 3 when 0 then 'water/disposal' when 1 then 'gas' else 'oil' end by_name from forms""",
)
def _(spark, sf_dir):
    """Kinds of wells by their texts and by their names."""
    name = F.get(F.array(F.lit("Smith SWD 1"), F.lit("Big Gas 2"), F.lit("Oil Creek 3")), F.pmod("doc_id", F.lit(3)).cast("int"))
    return with_form(spark, sf_dir, WELLS).select("doc_id", fields.well_type("t", F.lit(None).cast("string")).alias("by_text"), fields.well_type("t", name).alias("by_name"))


@query(
    "q_small_fields", "rec_id:l ns:s ew:s tw:s base:s number:l coordinate:d site:s folder:s", "records",
    """select rec_id, ns, ew, case when twp is null then null else coalesce(ns, 'N') end tw, 'c' || (rec_id * 0 + regexp_extract(county, '([0-9]+)', 1)::int) base, collection_num number,
      case when section * 6e0 <= 180 then section * 6e0 end coordinate, 'C' || regexp_extract(county, '([0-9]+)', 1) site, '(' || collection_num || ')' folder from records""",
)
def _(records):
    """Directions, county keys, collection numbers, coordinates and names for the site."""
    folder = F.concat(F.lit("ExportedFolderContents ("), F.col("collection_num").cast("string"), F.lit(").zip"))
    return records.select(
        "rec_id", fields.norm_direction(F.lower("ns"), "NS").alias("ns"), fields.norm_direction(F.concat(F.lit(" "), "ew"), "EW").alias("ew"), fields.direction_or(F.concat(F.col("twp").cast("string"), F.coalesce("ns", F.lit(""))), "NS", "N").alias("tw"),
        fields.county_base("county").alias("base"), fields.collection_number(folder).alias("number"), fields.coordinate((F.col("section") * 6).cast("string")).alias("coordinate"), fields.site_county(F.upper("county")).alias("site"), fields.site_collection(folder).alias("folder"),
    )


ANSWERS = ("Section: 14\nTownship: 5N\nRange: 9W", "Section - 77 / Township - 05 n / Range - not found", "Township: T-7-S", "I can not read it")


@query(
    "q_model_answer", "rec_id:l section:s township:s range:s confidence:l", "records",
    "select rec_id, case rec_id % 4 when 0 then '14' end section, case rec_id % 4 when 0 then '5N' when 1 then '5N' end township, case rec_id % 4 when 0 then '9W' end as range, case rec_id % 4 when 0 then 75 when 1 then 33 else 0 end confidence from records",
)
def _(records):
    """A model's answers read, and their confidence capped."""
    x = enrichment.read_answer(F.get(F.array(*map(F.lit, ANSWERS)), (F.col("rec_id") % 4).cast("int")))
    rows = records.select("rec_id", x.alias("x")).select("rec_id", "x.*")
    n = sum(F.col(c).isNotNull().cast("int") for c in ("section", "township", "range"))
    return rows.withColumn("confidence", enrichment.capped(n, F.lit("llm")))


# --- what surrounds the stages -------------------------------------------------

ELIGIBLE = "section is not null and twp is not null and rng is not null"


@query("q_eligible", "stem:s enrichable:b centroid:b derivation:s agreement:s", "status", f"""select stem, not ({ELIGIBLE}) and dot_confidence > 0 enrichable, {ELIGIBLE} and dot_status = 'skipped' centroid,
  case when latlong_lat <> '' then 'latlong_direct' when rec_id % 3 = 0 then 'not_resolved' when rec_id % 3 = 1 then 'dot_interpolation_quad' else 'dot_interpolation' end derivation,
  case rec_id % 4 when 0 then 'agree' when 1 then 'disagree' when 2 then 'single_source' else 'none' end agreement from status""")
def _(s):
    """Who can be enriched or takes a section's centre, and where coordinates and quadrants came from."""
    k = F.col("rec_id") % 4
    quads = F.when(k < 3, "NW"), F.when(k == 0, "NW").when(k == 1, "SE")
    lat, source = F.when(F.col("rec_id") % 3 > 0, F.lit(35.0)), F.when(F.col("rec_id") % 3 == 1, "quadrant_direct").otherwise("exact_county")
    return s.select("stem", enrichment.enrichable_skip().alias("enrichable"), F.coalesce(enrichment.centroid_eligible(), F.lit(False)).alias("centroid"), enrichment.derivation(lat, source, F.col("latlong_lat") != "").alias("derivation"), enrichment.quadrant_meta(*quads)["agreement"].alias("agreement"))


@query("q_run_selection", "stem:s", "records", "select stem from records where collection_num in (3, 5) and year between 1993 and 1996 order by stem limit 40")
def _(records):
    """The records of a run: collections, years, and how many."""
    return enrichment.selected(records, [3, 5], (1993, 1996), 40)


@query("q_runs", "rec_id:l run:l", "records", "--cte m as (select rec_id, case when collection_num is distinct from lag(collection_num) over (order by rec_id) then 1 else 0 end e from records) select rec_id, sum(e) over (order by rec_id) run from m")
def _(records):
    """Stretches of neighbouring records of one collection."""
    return enrichment.runs(records.select("rec_id", "collection_num"), "rec_id", "collection_num")


@query(
    "q_slice_report", "stage:s n:l done:l failed:l skipped:l avg_confidence:d done_pct:l reasons:s", "status",
    f"""--cte long as ({LONG}), c as (select stage, error_type, count(*) k from long where status = 'failed' group by all), w as (select *, row_number() over (partition by stage order by k desc, error_type) r from c),
    t as (select stage, string_agg(error_type || '=' || k, ',' order by r) reasons from w where r <= 8 group by stage)
    select stage, count(*) n, count(*) filter (status = 'done') done, count(*) filter (status = 'failed') failed, count(*) filter (status = 'skipped') skipped, avg(confidence) filter (status = 'done') avg_confidence, count(*) filter (status = 'done') * 100 // count(*) done_pct, any_value(t.reasons) reasons from long join t using (stage) group by stage""",
)
def _(s):
    """Quality of each stage over all slices, with its commonest reasons."""
    return reports.slice_report(s)


@query(
    "q_smoke_report", "tier:s what:s n:l", "status",
    f"""--cte long as ({LONG}), t as (select *, case when collection_num <= 6 then 'early' when collection_num <= 8 then 'transition' when collection_num <= 10 then 'mid' when collection_num <= 12 then 'late' else 'modern' end tier from status), u as (select stem, tier from t)
    select tier, stage || ' ' || status what, count(*) n from long join u using (stem) group by all union all select tier, case when county_score >= 95 then 'score 95+' when county_score >= 86 then 'score 86-94' when county_score >= 72 then 'score 72-85' else 'score below 72' end, count(*) from t group by all
    union all select tier, 'fields ' || (1 + (twp is not null)::int + (rng is not null)::int), count(*) from t group by all""",
)
def _(s):
    """Stages, scores and completeness by era."""
    return reports.smoke_report(s)


@query(
    "q_audit", "section:s name:s n:l", "status",
    f"""--cte long as ({LONG}), loc as (select * from status where location_status = 'done')
    select 'rate' as section, stage as name, count(*) filter (status = 'done') * 100 // count(*) filter (status in ('done', 'failed')) n from long group by all union all select 'confidence', (location_confidence // 10 * 10)::varchar, count(*) from loc group by all
    union all select 'missing', 'twp', count(*) from loc where twp is null having count(*) > 0 union all select 'missing', 'rng', count(*) from loc where rng is null having count(*) > 0 union all select 'sane', 'good', count(*) from loc
    union all select 'error', stage || ' ' || error_type, count(*) from long where status = 'failed' group by all union all select 'score', (county_score // 10 * 10)::varchar, count(*) from status where county_status = 'done' group by all
    union all select 'year', year::varchar, count(*) filter (location_status = 'done') * 100 // count(*) filter (location_status in ('done', 'failed')) from status group by all union all select 'dot of grid', dot_status, count(*) from status where grid_status = 'done' group by all
    union all select 'whole', case when grid_status = 'done' and county_status = 'done' and dot_status = 'done' and location_status = 'done' and twp is not null and rng is not null then 'yes' else 'no' end, count(*) from status group by all""",
)
def _(s):
    """An audit of collections, section by section."""
    return reports.audit(s)


@query("q_suspect_sweep", "collection_num:l n:l suspects:l", "records", "select collection_num, count(*) n, count(*) filter (not ((rec_id % 100) / 100e0 between 0.2e0 - 0.08e0 and 0.8e0 + 0.08e0 and (rec_id * 7 % 100) / 100e0 between 0.1e0 - 0.08e0 and 0.5e0 + 0.08e0)) suspects from records group by all")
def _(records):
    """Grids outside their collection's envelope."""
    box = records.select("collection_num").distinct().select("collection_num", F.lit(0.2).alias("x0"), F.lit(0.1).alias("y0"), F.lit(0.8).alias("x1"), F.lit(0.5).alias("y1"))
    return reports.suspects(records.withColumns({"cx": (F.col("rec_id") % 100) / 100, "cy": (F.col("rec_id") * 7 % 100) / 100}), box)


@query("q_queue_delta", "stage:s before:l after:l delta:l", "status baseline", f"--cte a as ({LONG.replace('from status', 'from baseline')}), b as ({LONG}) select stage, x.n as before, y.n as after, y.n - x.n delta from (select stage, count(*) n from a where status = 'failed' group by all) x join (select stage, count(*) n from b where status = 'failed' group by all) y using (stage)")
def _(s, b):
    """Change of the failures that wait, by stage."""
    return reports.queue_delta(*(status.long_form(x).where("status = 'failed'") for x in (b, s)))


@query("q_hit_rate", "source:s n:l hit_rate:d", "records", "--cte p as (select 'c' || (collection_num % 3) source, sqrt(((rec_id % 10) / 100e0) ** 2 + ((rec_id % 7) / 100e0) ** 2) d from records) select source, count(*) n, avg((d <= 0.06e0)::int) hit_rate from p group by all")
def _(records):
    """Predictions close to the truth."""
    zero = F.lit(0.0)
    return reports.hit_rate(records.select(F.concat(F.lit("c"), (F.col("collection_num") % 3).cast("string")).alias("source"), ((F.col("rec_id") % 10) / 100).alias("x"), ((F.col("rec_id") % 7) / 100).alias("y"), zero.alias("true_x"), zero.alias("true_y")))


@query("q_reset_misclassified", "stem:s grid_status:s dot_status:s", "status", "select stem, case when h then 'pending' else grid_status end grid_status, case when h then 'pending' else dot_status end dot_status from (select *, collection_num <= 6 and rec_id % 5 = 0 h from status)")
def _(s):
    """Early records whose form was taken for a later kind run again."""
    return status.reset_misclassified(s.withColumn("form_type", F.when(F.col("rec_id") % 5 == 0, "MID").otherwise("T1_LARGE")))


@query("q_reset_short_county", "stem:s county_status:s", "status", "select stem, case when rec_id % 10 = 0 then 'pending' else county_status end county_status from status")
def _(s):
    """Counties that only short candidates gave run again."""
    said = F.when(F.col("rec_id") % 10 == 0, F.array(F.lit("ok"), F.lit("l"))).otherwise(F.array(F.lit("ok"), F.lit("logan")))
    log = s.where("rec_id % 5 = 0").select("stem", "county", F.explode(said).alias("candidate"))
    return status.reset_short_county(s, log).select("stem", F.coalesce("county_status", F.lit("")).alias("county_status"))


@query("q_upgraded", "stem:s lat:d source:s", "records", "select stem, case when rec_id % 2 = 0 and rec_id % 3 = 0 then 35.5e0 else section * 1e0 end lat, case when rec_id % 2 = 0 and rec_id % 3 = 0 then 'printed_latlon' when rec_id % 2 = 0 then 'modern_text_section_centroid' else 'exact_county' end source from records")
def _(records):
    """Section centres replaced by printed coordinates."""
    coords = records.select("stem", F.col("section").cast("double").alias("lat"), F.lit(-97.0).alias("lon"), F.when(F.col("rec_id") % 2 == 0, "modern_text_section_centroid").otherwise("exact_county").alias("source"))
    return reconcile.upgraded(coords, records.where("rec_id % 3 = 0").select("stem", F.lit(35.5).alias("lat"), F.lit(-97.5).alias("lon")))


@query("q_index_completion", "stem:s year:l", "records", "select stem, case when rec_id % 3 > 0 then year end as year from records")
def _(records):
    """An index with the listed files that it lacked."""
    return reconcile.completed_index(records.where("rec_id % 3 > 0").select("stem", "year"), records.select("stem"))


@query("q_confirmed", "stem:s last_at:l", "", "select user_id::varchar stem, max(event_id) last_at from events where event_type = 'purchase' group by all")
def _(spark, sf_dir):
    """The last confirmed decision of each record."""
    e = parquet(spark, sf_dir, "events")
    decision = F.when(F.col("event_type") == "purchase", "confirmed").otherwise("rejected")
    return reconcile.confirmed(e.select(F.col("user_id").cast("string").alias("stem"), decision.alias("decision"), F.col("event_id").alias("at"))).withColumnRenamed("at", "last_at")


_OVER = " and ".join(f"coalesce({s}_status in ('done', 'skipped', 'failed'), false)" for s in status.STAGES)


@query("q_progress", "collection_num:l n:l finished:l not_started:l", "records status", f"--cte s as (select * from status where rec_id % 4 > 0) select r.collection_num, count(*) n, count(*) filter ({_OVER}) finished, count(*) filter (s.stem is null) not_started from records r left join s using (stem) group by all")
def _(records, s):
    """Progress of each collection."""
    return reconcile.progress(records.select("stem", "collection_num"), s.where("rec_id % 4 > 0"), "collection_num")


@query("q_shard_fold", "stem:s location_status:s", "status baseline", "select stem, case when rec_id % 2 = 0 then s.location_status else b.location_status end location_status from status s join baseline b using (stem, rec_id)")
def _(s, b):
    """Shards folded into their base: later rows replace whole ones."""
    return status.merged_base_and_shards(b, [s.where("rec_id % 2 = 0")])


@query("q_phrases", "doc_id:l pos:l px1:d", "tokens", f"--cte n as (select doc_id, pos, {NORMAL} a, x1, lead({NORMAL}) over w b, lead(x1) over w x2 from tokens window w as (partition by doc_id order by pos)) select doc_id, pos, greatest(x1, x2) px1 from n where contains(a, 'twp') and contains(b, 'e')")
def _(t):
    """Neighbouring tokens that hold the words."""
    return tokens.phrases(t, ["twp", "e"])


@query("q_campaign_fold", "stem:s source:s lat:d lon:d", "records grid", f"--cte un as (select * from records where rec_id % 4 > 0 and twp is not null and rng is not null), {p1_sql('un')}, far as (select stem, (b + d) / 2 lat, (a + c) / 2 lon from parts p join secbox g on g.sect = section and g.twp = p.twp and g.rng = p.rng and g.ns = tn and g.ew = te where stem in (select stem from p1 where lat is null) qualify row_number() over (partition by stem order by k) = 1) select stem, source, lat, lon from p1 where lat is not null union all select stem, 'section_centroid', lat, lon from far")
def _(records, grid):
    """A campaign's unmapped records placed by dot or section."""
    mapped = records.where("rec_id % 4 = 0").select("stem", F.lit(35.0).alias("lat"))
    return enrichment.folded_campaign(records.drop("centroid"), mapped, grid)


@query("q_recover_sections", "stem:s source:s lat:d lon:d", "status grid", f"""--cte lost as (select stem, section, twp, coalesce(ns, 'N') ns, rng, coalesce(ew, 'W') ew from status where location_status = 'done' and twp is not null and rng is not null and rec_id % 3 = 0 and rec_id % 7 > 0),
  secbox as (select sect, twp, ns, rng, ew, min(minx) a, min(miny) b, max(maxx) c, max(maxy) d from grid group by all)
  select stem, 'recovered_section_centroid' source, (b + d) / 2 lat, (a + c) / 2 lon from lost l join secbox g on g.sect = section and g.twp = l.twp and g.ns = l.ns and g.rng = l.rng and g.ew = l.ew""")
def _(s, grid):
    """Sections read again from texts, and placed."""
    said = F.concat(F.lit("Section "), F.col("section").cast("string"), F.lit(" Township "), F.col("twp").cast("string"), F.coalesce("ns", F.lit("N")), F.lit(" Range "), F.col("rng").cast("string"), F.coalesce("ew", F.lit("W")))
    lost = s.where("rec_id % 3 = 0").withColumn("section", F.lit(None).cast("int")).withColumn("county", F.lit("nowhere"))
    return enrichment.recovered_sections(lost, s.select("stem", said.alias("text")), s.where("rec_id % 7 = 0").select("stem", F.lit(1.0).alias("lat")), grid)


# --- streaming ---------------------------------------------------------------


def _drained(df: DataFrame, name: str) -> DataFrame:
    """Run an append stream over what there is into files of the shared folder, and return them."""
    import uuid

    spark = df.sparkSession
    root = f"{shared_dir(spark)}/landgrid/{name}-{uuid.uuid4().hex}"
    run = df.writeStream.format("parquet").outputMode("append").option("path", root).option("checkpointLocation", f"{root}.checkpoint").trigger(availableNow=True).start()
    run.awaitTermination()
    return spark.read.schema(df.schema).parquet(root)


@query("q_stream_status", "key:l status:s version:l", "", ORACLES["q_newest_wins"])
def _(spark, sf_dir):
    """The latest status of each key, as a stream."""
    return streams.settled(streams.latest(streams.status_events(streams.stream(spark, f"{sf_dir}/events.parquet"))), ["key"])


@query(
    "q_stream_fsm", "key:l transitions:l status:s", "",
    """with e as (select user_id as key, event_id v, case event_type when 'signup' then 'pending' when 'purchase' then 'skipped' when 'error' then 'failed' else 'done' end s from events),
    t as (select key, min(v) filter (s in ('done', 'skipped')) tv from e group by key),
    l as (select e.*, lag(s, 1, 'pending') over (partition by key order by v) p, tv from e join t using (key) where tv is null or v <= tv)
    select key, count(*) filter (s <> p) transitions, arg_max(s, v) status from l group by key""",
)
def _(spark, sf_dir):
    """Life of each record as a state machine over a stream."""
    return streams.settled(streams.lifecycle(streams.status_events(streams.stream(spark, f"{sf_dir}/events.parquet"))), ["key"])


@query("q_stream_dedup", "n:l", "", "select count(*) n from (select distinct user_id, event_id from events)")
def _(spark, sf_dir):
    """Events once each, in whatever files and order they come."""
    log = streams.status_events(streams.stream(spark, f"{sf_dir}/events.parquet"))
    return _drained(streams.distinct(log), "dedup").agg(F.count("*").alias("n"))


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records resolved against the land grid by all passes."""
    return QUERIES["q_resolve_all"](spark, sf_dir)
