"""The engine's tables as views over the driver's: one SQL text for Spark and for the oracle."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from landgrid.session import is_scratch, written

DIALECT = {"spark": {"div": "div", "s": "string", "grid_rows": "range(276480)"}, "duckdb": {"div": "//", "s": "varchar", "grid_rows": "range(276480) g(id)"}}


def _case(*pairs: tuple[str, str], default: str) -> str:
    return "case " + " ".join(f"when {a} then {b}" for a, b in pairs) + f" else {default} end"


RECORDS = """
select cast(o_orderkey as bigint) as rec_id,
  concat('35', lpad(cast((o_custkey % 77) * 2 + 1 as {s}), 3, '0'), cast(10000 + o_orderkey % 90000 as {s}), '_LEASE ', cast(o_custkey % 40 as {s}), 'A ',
    cast(o_orderkey % 9 + 1 as {s}), '_', cast(o_orderkey as {s})) as stem,
  cast(o_orderkey % 13 + 1 as int) as collection_num,
  cast(o_orderkey % 36 + 1 as int) as section,
  cast(case when o_orderkey % 11 = 0 then null else o_custkey % 5 + 1 end as int) as twp,
  case when o_orderkey % 7 = 0 then null when o_custkey % 3 = 0 then 'S' else 'N' end as ns,
  cast(case when o_orderkey % 17 = 0 then null else o_custkey % 6 + 1 end as int) as rng,
  case when o_orderkey % 5 = 0 then null when o_custkey % 2 = 0 then 'E' else 'W' end as ew,
  concat('C', cast(o_custkey % 25 as {s}), ' County') as county,
  cast(o_orderkey % 8 + 1 as int) as dot_row, cast(o_custkey % 8 + 1 as int) as dot_col,
  case when o_orderkey % 6 = 0 then null else (o_custkey % 8 + 0.25e0) / 8e0 end as x_norm,
  case when o_orderkey % 6 = 0 then null else (o_orderkey % 8 + 0.75e0) / 8e0 end as y_norm,
  o_orderkey % 19 = 0 as centroid,
  cast(year(o_orderdate) as int) as year, cast(month(o_orderdate) as int) as month,
  cast((o_orderkey % 97) * 1024 as bigint) as file_size_bytes
from {orders}
"""

_STATUS = {
    "latlong": _case(("o_orderkey % 4 = 1", "'done'"), ("o_orderkey % 9 = 2", "'failed'"), ("o_orderkey % 10 = 3", "'pending'"), default="'skipped'"),
    "grid": _case(("o_orderkey % 6 = 1", "'failed'"), ("o_orderkey % 10 = 7", "'pending'"), default="'done'"),
    "location": _case(("o_orderkey % 4 = 0", "'failed'"), ("o_orderkey % 9 = 0", "'skipped'"), ("o_orderkey % 10 = 0", "'pending'"), default="'done'"),
    "county": _case(("o_orderkey % 7 = 0", "'failed'"), ("o_orderkey % 12 = 5", "''"), default="'done'"),
    "dot": _case(("o_orderkey % 5 = 2", "'failed'"), ("o_orderkey % 8 = 3", "'skipped'"), default="'done'"),
}
_ERROR = "case o_orderkey % 3 when 0 then 'api_error' when 1 then 'not_found' else 'no_match' end"


def _status(shift: int) -> str:
    """Status of all records; another shift gives another run of the same records."""
    swap = lambda x: x.replace("o_orderkey", f"(o_orderkey + {shift})")
    stages = ",\n  ".join(
        f"{swap(sql)} as {s}_status, cast((o_orderkey * {3 + i} + {shift}) % 101 as int) as {s}_confidence, case when {swap(sql)} = 'failed' then {_ERROR} end as {s}_error_type"
        for i, (s, sql) in enumerate(_STATUS.items())
    )
    done = swap("o_orderkey % 4 = 1")
    return (
        RECORDS.replace("from {orders}", "")
        + f""",
  {stages},
  cast((o_orderkey * 7) % 101 as int) as county_score,
  case when {done} then '35.1234' else '' end as latlong_lat, case when {done} then '-97.5432' else '' end as latlong_lon
from {{orders}}
"""
    )


def _half(row: str, column: str, step: int) -> str:
    r, c = f"(({row}) {{div}} {step}) % 2", f"(({column}) {{div}} {step}) % 2"
    return f"case when {r} = 0 and {c} = 0 then 'NW' when {r} = 0 then 'NE' when {c} = 0 then 'SW' else 'SE' end"


GRID = (
    """
select sect, twp, ns, rng, ew, quad, concat('C', cast((twp * 3 + rng * 7) % 25 as {s}), ' County') as county,
  sx + cx * 1e-1 / 48e0 as minx, sy + (7 - cy) * 1e-1 / 48e0 as miny, sx + (cx + 1) * 1e-1 / 48e0 as maxx, sy + (8 - cy) * 1e-1 / 48e0 as maxy
from (
  select *, -98e0 + (case when ew = 'E' then rng - 1 else -rng end) * 1e-1 + ((sect - 1) % 6) * 1e-1 / 6e0 as sx,
    34.9e0 + (case when ns = 'N' then twp - 1 else -twp end) * 1e-1 + (5 - (sect - 1) {div} 6) * 1e-1 / 6e0 as sy
  from (
    select cast(id {div} 64 % 36 + 1 as int) as sect, cast(id {div} 55296 + 1 as int) as twp, case when id {div} 27648 % 2 = 0 then 'N' else 'S' end as ns,
      cast(id {div} 4608 % 6 + 1 as int) as rng, case when id {div} 2304 % 2 = 0 then 'E' else 'W' end as ew,
      cast(id % 8 as int) as cx, cast(id {div} 8 % 8 as int) as cy, id % 64 as cell,
      concat("""
    + f"{_half('id {div} 8 % 8', 'id % 8', 4)}, '-', {_half('id {div} 8 % 8', 'id % 8', 2)}, '-', {_half('id {div} 8 % 8', 'id % 8', 1)}"
    + """) as quad
    from {grid_rows}
  ) a
  where not (sect % 7 = 3 and ew = 'W') and not (twp % 2 = 0 and ns = 'S' and rng % 2 = 1) and not (cell % 5 = 0 and sect % 2 = 0)
) b
"""
)

TOKENS = """
select doc_id, 1 as page, i as pos, t, (i % 20) * 60e0 as x0, (i {div} 20) * 40e0 as y0, (i % 20) * 60e0 + 50e0 as x1, (i {div} 20) * 40e0 + 20e0 as y1
from (
  select doc_id, i, case when (doc_id * 31 + i) % 23 = 0 then 'Section:' when (doc_id * 17 + i) % 29 = 0 then 'Twp.' when (doc_id * 13 + i) % 31 = 0 then 'RGE' else w end as t
  from {words}
) q
"""
WORDS = {
    "spark": "(select doc_id, cast(pos as bigint) as i, col as w from (select doc_id, posexplode(split(text, '[ \\n]')) from {documents}))",
    "duckdb": "(select doc_id, unnest(range(len(ws))) as i, unnest(ws) as w from (select doc_id, regexp_split_to_array(text, '[ \\n]') as ws from documents))",
}

VIEWS = {"records": RECORDS, "status": _status(0), "baseline": _status(5), "grid": GRID, "tokens": TOKENS}


def text(name: str, dialect: str = "duckdb") -> str:
    """SQL of a view; the oracle's names the driver's tables."""
    words = DIALECT[dialect] | {"orders": "orders" if dialect == "duckdb" else "{orders}", "words": WORDS[dialect]}
    return VIEWS[name].format(**words)


_grids: dict[str, DataFrame] = {}


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A view as a DataFrame. The land grid, a dimension of fixed size that no table holds here, is written once a session."""
    sql = text(name, "spark")
    if name == "grid":
        app = spark.sparkContext.applicationId
        if app not in _grids or not is_scratch(_grids[app]):
            _grids[app] = written(spark.sql(sql), "grid")
        return _grids[app]
    tables = {t: spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("orders", "documents") if f"{{{t}}}" in sql}
    return spark.sql(sql, **tables)


def with_views(sql: str, *names: str) -> str:
    """Oracle SQL over the named views; its own CTEs may follow in the same WITH."""
    heads = ",\n".join(f"{n} as ({text(n)})" for n in names)
    return f"with {heads}{',' if sql.lstrip().lower().startswith('--cte') else ''}\n{sql.lstrip().removeprefix('--cte')}"
