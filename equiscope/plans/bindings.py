"""Inputs for the ETL operators, derived by rule from the driver tables.

Each text below is valid in both Spark SQL and DuckDB (tables appear as
``{name}`` placeholders: bound to DataFrames on Spark, replaced by the view
names for DuckDB), so the Spark side and
the oracle start from identical inputs; the *operators* are then run through
the library on Spark and re-stated independently in the oracle SQL.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from equiscope.sources.tables import FACT_SQL, TABLES, read_table


def code_expr(bnum: str, size: str) -> str:
    return f"lpad(CAST({bnum} AS STRING), 2, '0') || '.' || lpad(CAST({size} AS STRING), 4, '0')"


# one code per (brand, size) of every part row
CODES_SQL = f"""SELECT p_partkey, p_name, p_type, p_size,
  CAST(replace(p_brand, 'Brand#', '') AS INTEGER) AS bnum,
  {code_expr("CAST(replace(p_brand, 'Brand#', '') AS INTEGER)", "p_size")} AS code
FROM {{part}}"""


def raw_modern_sql(k: int) -> str:
    """Crosswalk in the modern layout: ="code" wrappers, action column."""
    return f"""SELECT '="' || code || '"' AS origin,
  '="' || {code_expr('bnum', f'(p_size + {k}) % 50 + 1')} || '"' AS dest,
  CASE WHEN (p_size + {k}) % 4 = 0 THEN 'Moved to'
       WHEN (p_size + {k}) % 4 = 1 THEN 'MOVED TO'
       ELSE 'No substantive changes' END AS action,
  CASE WHEN p_partkey % 13 = 0 THEN p_name || ' (Deleted)'
       ELSE p_name || ' ' || code || '.' END AS title,
  p_partkey AS pos
FROM ({CODES_SQL}) c"""


def raw_legacy_sql(k: int) -> str:
    """Crosswalk in the older layout: notes in the destination column."""
    return f"""SELECT CASE WHEN p_partkey % 17 = 0 THEN NULL ELSE code END AS origin,
  CASE WHEN (p_size + {k}) % 9 = 0 THEN 'Report as ' || code
       WHEN (p_size + {k}) % 11 = 0 THEN 'Deleted'
       WHEN (p_size + {k}) % 5 = 0 THEN code
       WHEN p_partkey % 29 = 0 THEN NULL
       ELSE {code_expr('bnum', f'(p_size * 3 + {k}) % 50 + 1')} END AS dest,
  CASE WHEN p_partkey % 19 = 0 THEN 'Deleted' ELSE upper(p_name) || ' ' || code END AS title,
  p_partkey AS pos
FROM ({CODES_SQL}) c"""


# taxonomy in the published layout; codes of sizes above 40 only appear as
# "Total ..." rows, so they end up unclassified
RAW_TAXONOMY_SQL = f"""SELECT
  CASE WHEN bnum % 7 < 4 THEN 'Science and engineering' ELSE 'Non-science and engineering' END AS sci,
  CASE WHEN bnum % 5 = 0 THEN 'Life Sciences' WHEN bnum % 7 = 3 THEN 'Psychology'
       WHEN bnum % 7 = 2 THEN 'Engineering' ELSE 'FG' || CAST(bnum % 7 AS STRING) END AS fg,
  'Detail ' || CAST(bnum AS STRING) AS dfg,
  CASE WHEN p_size > 40 THEN 'Total for selected values: ' || code
       ELSE code || ' - ' || p_name || ' .' END AS cip_string,
  p_partkey AS pos
FROM ({CODES_SQL}) c"""

STEM_SQL = f"SELECT DISTINCT code FROM ({CODES_SQL}) c WHERE bnum % 7 < 3 AND p_size <= 25"

# award rows over survey years 1984..2032 (spread from order year and line
# number) so every crosswalk range is exercised
XFACT_SQL = f"""SELECT 1984 + (CAST(year(o_orderdate) AS INTEGER) - 1995) * 7 + (l_linenumber - 1) AS year,
  l_orderkey, l_linenumber, l_suppkey AS unitid,
  {code_expr("CAST(replace(p_brand, 'Brand#', '') AS INTEGER)", "p_size")} AS cipcode,
  CAST(l_quantity AS BIGINT) AS n_awards
FROM {{lineitem}} JOIN {{orders}} ON l_orderkey = o_orderkey JOIN {{part}} ON l_partkey = p_partkey"""

# institution attributes over time, NULL where an event does not report them
EVENT_ATTRS_SQL = """SELECT user_id AS unitid, ts AS metadata_vintage, event_id,
  CASE WHEN event_type = 'signup' THEN 'Institute of Technology ' || CAST(event_id AS STRING)
       WHEN event_type = 'purchase' THEN 'Health Science Center ' || CAST(event_id AS STRING) END AS institution_name,
  CASE WHEN event_type IN ('click', 'view') THEN props END AS city,
  CASE WHEN event_type = 'error' THEN value END AS score
FROM {events}"""

DICTIONARY_SQL = """SELECT 's_nationkey' AS varname, CAST(r_regionkey AS STRING) AS codevalue,
  r_name AS valuelabel FROM {region}"""

REGION_LABEL_SQL = """SELECT n_nationkey,
  CASE WHEN n_nationkey % 5 = 0 THEN 'Other US jurisdictions (AS, FM, GU, MH, MP, PR, PW, VI)'
       ELSE r_name || ',  (' || n_name || ').' END AS label
FROM {nation} JOIN {region} ON n_regionkey = r_regionkey"""

# segment / status -> measure-column code of the post-2010 layout
SEGMENT_CODE = {
    "AUTOMOBILE": "cunkn",
    "BUILDING": "cnral",
    "FURNITURE": "caian",
    "HOUSEHOLD": "casia",
    "MACHINERY": "cbkaa",
}


def wide_long_sql() -> str:
    """Award rows with the measure-column code they belong to."""
    seg = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in SEGMENT_CODE.items())
    return f"""SELECT unitid, cipcode, CAST(substr(awlevel, 1, 1) AS INTEGER) * 4 - 3 AS awlevel,
  majornum, year,
  (CASE race_ethnicity {seg} END) || (CASE gender WHEN 'men' THEN 'm' ELSE 'w' END) AS code,
  n_awards
FROM ({FACT_SQL}) f"""


def plain(text: str) -> str:
    """Placeholder text -> SQL over tables registered under their own names
    (the oracle's views)."""
    for t in TABLES:
        text = text.replace("{" + t + "}", t)
    return text


def sql_df(spark: SparkSession, sf_dir: str, text: str, tables: list[str]) -> DataFrame:
    """Run a placeholder text on Spark, binding each ``{table}`` to a
    DataFrame (no temporary views are registered in the session)."""
    return spark.sql(text, **{t: read_table(spark, sf_dir, t) for t in tables})
