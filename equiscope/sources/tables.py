"""Binding of the award data model to the driver's TPC-H-like tables.

The award fact is *derived by Spark from the given tables* (nothing is
synthesised):

=========================  ==================================================
fact column                derived from
=========================  ==================================================
year                       year(o_orderdate)
unitid                     l_suppkey                (institution = supplier)
cip2020 / cipcode          'BB.SSSS' from p_brand number and p_size
race_ethnicity             c_mktsegment
gender                     'women' if l_linestatus = 'F' else 'men'
awlevel                    o_orderpriority
majornum                   1 if l_linenumber <= 5 else 2
n_awards                   l_quantity as bigint
ncses_detailed_field_group p_brand
ncses_field_group          'FG' || (brand number mod 7)
ncses_sci_group            S&E if brand number mod 7 < 4
nsf_broad_field            by brand number mod 7
dhs_stem                   brand number mod 7 < 3 and p_size <= 25
cip_title                  'Code ' || cip2020
=========================  ==================================================

All joins are equi-joins on keys; join strategy is left to AQE (no size is
assumed for ``part`` / ``customer``: both grow with the data).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from equiscope.vocab import NCSESSciGroup, NSFBroadField

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()

FACT_COLUMNS = [
    "year",
    "unitid",
    "cipcode",
    "awlevel",
    "majornum",
    "cip2020",
    "race_ethnicity",
    "gender",
    "n_awards",
    "cip_title",
    "ncses_sci_group",
    "ncses_field_group",
    "ncses_detailed_field_group",
    "nsf_broad_field",
    "dhs_stem",
]


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def date_range(day: str, years: tuple[int, int]) -> Column:
    """The dates of a range of years, as bounds that a scan can push down
    (``year(day)`` cannot be)."""
    first, last = (F.make_date(F.lit(y), F.lit(1), F.lit(1)) for y in (years[0], years[1] + 1))
    return (F.col(day) >= first) & (F.col(day) < last)


def completions_fact(spark: SparkSession, sf_dir: str, years: tuple[int, int] | None = None) -> DataFrame:
    """The award fact (one row per line item) derived from the driver tables;
    of a range of years, if given: its dates are pushed to the scan of the orders."""
    li = read_table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_linestatus"
    )
    od = read_table(spark, sf_dir, "orders")
    if years:
        od = od.filter(date_range("o_orderdate", years))
    od = od.select("o_orderkey", "o_custkey", F.year("o_orderdate").alias("year"), "o_orderpriority")
    # the code is made per part, not per line item
    brand = F.regexp_replace("p_brand", "Brand#", "")
    code = F.concat(F.lpad(brand, 2, "0"), F.lit("."), F.lpad(F.col("p_size").cast("string"), 4, "0"))
    pt = read_table(spark, sf_dir, "part").select("p_partkey", "p_brand", "p_size", code.alias("code"))
    cu = read_table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment")

    # customers meet the orders, not the line items: where they are too many to be
    # sent to all, the line items are shuffled once less
    oc = od.join(cu, od.o_custkey == cu.c_custkey)
    j = li.join(oc, li.l_orderkey == od.o_orderkey).join(pt, li.l_partkey == pt.p_partkey)
    bmod = brand.cast("int") % 7
    cip = F.col("code")
    return j.select(
        "year",
        F.col("l_suppkey").alias("unitid"),
        cip.alias("cipcode"),
        F.col("o_orderpriority").alias("awlevel"),
        F.when(F.col("l_linenumber") <= 5, 1).otherwise(2).alias("majornum"),
        cip.alias("cip2020"),
        F.col("c_mktsegment").alias("race_ethnicity"),
        F.when(F.col("l_linestatus") == "F", "women").otherwise("men").alias("gender"),
        F.col("l_quantity").cast("bigint").alias("n_awards"),
        F.concat(F.lit("Code "), cip).alias("cip_title"),
        F.when(bmod < 4, NCSESSciGroup.sci.value)
        .otherwise(NCSESSciGroup.non_sci.value)
        .alias("ncses_sci_group"),
        F.concat(F.lit("FG"), bmod.cast("string")).alias("ncses_field_group"),
        F.col("p_brand").alias("ncses_detailed_field_group"),
        F.when(bmod == 0, NSFBroadField.math_cs.value)
        .when(bmod == 1, NSFBroadField.eng.value)
        .when(bmod == 2, NSFBroadField.phys_earth_sci.value)
        .when(bmod == 3, NSFBroadField.soc_behav_sci.value)
        .otherwise(NSFBroadField.non_stem.value)
        .alias("nsf_broad_field"),
        ((bmod < 3) & (F.col("p_size") <= 25)).alias("dhs_stem"),
    )


def institutions_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Institution dimension: one row per unit (supplier)."""
    return read_table(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").alias("unitid"), F.col("s_name").alias("institution_name")
    )


# SQL text of the same binding for the correctness oracle; tables are
# ``{name}`` placeholders (see equiscope.plans.bindings.plain).
FACT_SQL = """
SELECT CAST(year(o_orderdate) AS INTEGER) AS year, l_suppkey AS unitid,
  lpad(replace(p_brand,'Brand#',''),2,'0')||'.'||lpad(CAST(p_size AS STRING),4,'0') AS cipcode,
  o_orderpriority AS awlevel,
  CASE WHEN l_linenumber<=5 THEN 1 ELSE 2 END AS majornum,
  lpad(replace(p_brand,'Brand#',''),2,'0')||'.'||lpad(CAST(p_size AS STRING),4,'0') AS cip2020,
  c_mktsegment AS race_ethnicity,
  CASE WHEN l_linestatus='F' THEN 'women' ELSE 'men' END AS gender,
  CAST(l_quantity AS BIGINT) AS n_awards,
  'Code '||lpad(replace(p_brand,'Brand#',''),2,'0')||'.'||lpad(CAST(p_size AS STRING),4,'0') AS cip_title,
  CASE WHEN CAST(replace(p_brand,'Brand#','') AS INTEGER)%7 < 4
       THEN 'Science and engineering' ELSE 'Non-science and engineering' END AS ncses_sci_group,
  'FG'||CAST(CAST(replace(p_brand,'Brand#','') AS INTEGER)%7 AS STRING) AS ncses_field_group,
  p_brand AS ncses_detailed_field_group,
  CASE CAST(replace(p_brand,'Brand#','') AS INTEGER)%7
       WHEN 0 THEN 'Mathematical and computer sciences' WHEN 1 THEN 'Engineering'
       WHEN 2 THEN 'Physical and earth sciences' WHEN 3 THEN 'Social and behavioral sciences'
       ELSE 'Non-science and engineering' END AS nsf_broad_field,
  (CAST(replace(p_brand,'Brand#','') AS INTEGER)%7 < 3 AND p_size<=25) AS dhs_stem
FROM {lineitem} JOIN {orders} ON l_orderkey=o_orderkey
  JOIN {part} ON l_partkey=p_partkey JOIN {customer} ON o_custkey=c_custkey
"""

INSTITUTIONS_SQL = "SELECT s_suppkey AS unitid, s_name AS institution_name FROM {supplier}"
