"""Classification coverage reports and small documented query shapes."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from equiscope.functions.rates import safe_div
from equiscope.vocab import NCSESSciGroup

GENERIC_CODE = "95.0000"


def _unknown(df: DataFrame):
    return F.col("ncses_sci_group") == NCSESSciGroup.unknown.value


def unclassified_by_code(df: DataFrame, year: str = "year") -> DataFrame:
    """Awards (NULL counted as 0) with an unknown sci group, per year and
    (original code, current code)."""
    n = F.coalesce(F.col("n_awards").cast("double"), F.lit(0.0))
    return df.filter(_unknown(df)).groupBy(year, "cipcode", "cip2020").agg(F.sum(n).alias("n_awards"))


def unclassified_share(df: DataFrame, year: str = "year") -> DataFrame:
    """Per year: share of awards unclassified, and share unclassified
    excluding the generic code."""
    n = F.coalesce(F.col("n_awards").cast("double"), F.lit(0.0))
    unk = _unknown(df)
    agg = df.groupBy(year).agg(
        F.sum(n).alias("total_awards"),
        F.sum(F.when(unk, n).otherwise(0.0)).alias("unclassified_awards"),
        F.sum(F.when(unk & (F.col("cipcode") != GENERIC_CODE), n).otherwise(0.0)).alias("non_generic_awards"),
        F.count_distinct(F.when(unk, F.struct("cipcode", "cip2020"))).alias("n_unclassified_codes"),
    )
    return agg.withColumns(
        {
            "unclassified_pct": safe_div("unclassified_awards", "total_awards"),
            "non_generic_pct": safe_div("non_generic_awards", "total_awards"),
        }
    )


def unclassified_ranking(df: DataFrame) -> DataFrame:
    """All years: unclassified awards per code pair, largest first."""
    n = F.coalesce(F.col("n_awards").cast("double"), F.lit(0.0))
    return (
        df.filter(_unknown(df))
        .groupBy("cipcode", "cip2020")
        .agg(F.sum(n).alias("n_awards"))
        .orderBy(F.desc("n_awards"), "cipcode", "cip2020")
    )


def top_codes(df: DataFrame, k: int = 10, code: str = "cip2020") -> DataFrame:
    """Total awards per code, top ``k`` (ties broken by code) -- a
    TakeOrderedAndProject, no global sort."""
    return (
        df.groupBy(code)
        .agg(F.sum("n_awards").alias("total_awards"))
        .orderBy(F.desc("total_awards"), F.asc(code))
        .limit(k)
    )


def enum_domain(df: DataFrame, col: str) -> DataFrame:
    """Sorted distinct domain of a column with its size on every row."""
    size = F.count(F.lit(1)).over(Window.partitionBy(F.lit(0)))  # over the domain, a vocabulary
    return df.select(col).distinct().withColumn("domain_size", size).orderBy(F.col(col).asc_nulls_last())


def enum_domains(df: DataFrame, domains: dict[str, list[str]]) -> DataFrame:
    """(domain, value, domain_size) of several domains in one pass over the
    data; a domain is the union of its columns' values that are not NULL."""
    pairs = [
        F.struct(F.lit(name).alias("domain"), F.col(c).cast("string").alias("value"))
        for name, columns in domains.items() for c in columns
    ]
    seen = df.select(F.explode(F.array(*pairs)).alias("p")).select("p.*").filter("value is not null").distinct()
    return seen.withColumn("domain_size", F.count(F.lit(1)).over(Window.partitionBy("domain")))


def shared_domain(df: DataFrame, cols: list[str], out: str = "code") -> DataFrame:
    """Distinct union of the values of several columns."""
    parts = [df.select(F.col(c).alias(out)) for c in cols]
    u = parts[0]
    for p in parts[1:]:
        u = u.union(p)
    return u.distinct()


def count_distinct_domains(df: DataFrame, cols: list[str]) -> DataFrame:
    """Exact distinct counts per column (one row), in one pass.

    Several ``count(DISTINCT ...)`` would copy every row once per column; here
    each column's different values are a set that the map side already
    reduces.  The columns are domains: closed vocabularies and code lists, of a
    few thousand values, so the sets are small."""
    return df.agg(*[F.size(F.collect_set(F.col(c))).cast("long").alias(f"n_{c}") for c in cols])
