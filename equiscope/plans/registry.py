"""Registered queries (Spark callables) and their oracle SQL texts.

Each canned representation query is declared once as a spec; the Spark
callable and the DuckDB oracle are both derived from it.  Float columns are
rounded to 9 decimals on both sides so that last-ulp differences between
the engines' ``log2`` / ``exp`` do not decide the comparison.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType

from equiscope.functions.rates import round_half_up
from equiscope.operators.filters import QueryFilters, TaxonomyRollup
from equiscope.plans import oracle
from equiscope.plans.engine import CompletionsEngine
from equiscope.session import code_apart
from equiscope.sources.tables import completions_fact, institutions_dim

QueryFn = Callable[[SparkSession, str], DataFrame]


def presentable(df: DataFrame, digits: int = 9) -> DataFrame:
    """Round every floating column (NaN / inf pass through), p-values to
    fewer digits; -0.0 -> 0.0."""

    def shown(f):
        if not isinstance(f.dataType, (DoubleType, FloatType)):
            return F.col(f.name)
        by = round_half_up if isinstance(f.dataType, DoubleType) else F.round
        return (by(F.col(f.name), oracle.P_DIGITS if f.name.endswith("pvalue") else digits) + F.lit(0.0)).alias(f.name)

    return code_apart(df.select(*[shown(f) for f in df.schema.fields]))


def engine_for(spark: SparkSession, sf_dir: str, years: tuple[int, int] | None = None, **kw) -> CompletionsEngine:
    return CompletionsEngine(
        spark, completions_fact(spark, sf_dir, years), institutions_dim(spark, sf_dir), check_values=False, **kw
    )


# name -> (method, kwargs).  Filters use strict=False: the binding's groups
# are market segments, not the closed race vocabulary.
CANNED: dict[str, dict] = {
    "rollup_by_grouping": dict(
        method="rollup", grouping="gender", rollup=("ncses_field_group", ["FG1", "FG2"]),
        filters=dict(start_year=1984, end_year=2024), rel_rate=True,
    ),
    "rollup_race_by_year": dict(
        method="rollup", grouping="race_ethnicity",
        rollup=("ncses_sci_group", ["Science and engineering"]),
        filters=dict(start_year=1984, end_year=2024), by_year=True, rel_rate=True,
    ),
    "rollup_intersectional": dict(
        method="rollup", grouping="intersectional",
        rollup=("ncses_detailed_field_group", ["Brand#1", "Brand#2", "Brand#3"]),
        filters=dict(start_year=1995, end_year=2001),
    ),
    "rollup_missing_value": dict(
        method="rollup", grouping="gender", rollup=("ncses_field_group", ["FG3", "No such field"]),
        filters=dict(start_year=1984, end_year=2024), rel_rate=True,
    ),
    "rollup_empty_rollup": dict(
        method="rollup", grouping="gender", rollup=("ncses_field_group", ["No such field"]),
        filters=dict(start_year=1984, end_year=2024), rel_rate=True,
    ),
    "field_totals_by_grouping": dict(
        method="field", grouping="gender", taxonomy="ncses_field_group",
        filters=dict(start_year=1984, end_year=2024), rel_rate=True,
    ),
    "field_totals_intersectional_by_year": dict(
        method="field", grouping="intersectional", taxonomy="cip2020",
        filters=dict(start_year=1984, end_year=2024), by_year=True, rel_rate=True,
    ),
    "filter_taxonomy_values": dict(
        method="field", grouping="race_ethnicity", taxonomy="ncses_detailed_field_group",
        taxonomy_values=["Brand#1", "Brand#7", "Brand#20"],
        filters=dict(start_year=1984, end_year=2024), rel_rate=True,
    ),
    "filter_boolean_taxonomy": dict(
        method="field", grouping="gender", taxonomy="dhs_stem", taxonomy_values=[True],
        filters=dict(start_year=1984, end_year=2024), by_year=True, rel_rate=True,
    ),
    "filter_base": dict(
        method="field", grouping="intersectional", taxonomy="nsf_broad_field",
        filters=dict(
            start_year=1996, end_year=1999, race_ethns=["AUTOMOBILE", "BUILDING", "MACHINERY"],
            award_levels=["1-URGENT", "2-HIGH", "5-LOW"], majornums=[1],
        ),
        rel_rate=True,
    ),
    "filter_year_range_empty": dict(
        method="field", grouping="gender", taxonomy="ncses_field_group",
        filters=dict(start_year=2010, end_year=2020), rel_rate=True,
    ),
    "uni_rollup_by_grouping": dict(
        method="uni_rollup", grouping="gender",
        rollup=("ncses_sci_group", ["Science and engineering"]),
        filters=dict(start_year=1984, end_year=2024), rel_rate=True, effect_size=True,
    ),
    "uni_rollup_intersectional_by_year": dict(
        method="uni_rollup", grouping="intersectional",
        rollup=("nsf_broad_field", ["Engineering", "Mathematical and computer sciences"]),
        filters=dict(start_year=1984, end_year=2024), by_year=True, rel_rate=True, effect_size=True,
    ),
    "uni_field_totals_by_grouping": dict(
        method="uni_field", grouping="intersectional", taxonomy="cip2020",
        filters=dict(start_year=1984, end_year=2024), by_year=True, effect_size=True,
    ),
    "uni_field_race": dict(
        method="uni_field", grouping="race_ethnicity", taxonomy="ncses_field_group",
        filters=dict(start_year=1984, end_year=2024), rel_rate=True,
    ),
    "uni_field_counts_only": dict(
        method="uni_field", grouping="gender", taxonomy="ncses_detailed_field_group",
        filters=dict(start_year=1984, end_year=2024), by_year=True,
    ),
    "filter_unitids": dict(
        method="uni_field", grouping="race_ethnicity", taxonomy="ncses_field_group",
        taxonomy_values=["FG0", "FG4", "FG6"], filter_unitids=[1, 3, 5, 8, 13, 21, 34, 55, 89],
        filters=dict(start_year=1984, end_year=2024), effect_size=True,
    ),
}


def run_canned(spark: SparkSession, sf_dir: str, spec: dict) -> DataFrame:
    qf = QueryFilters(strict=False, **spec["filters"])
    eng = engine_for(spark, sf_dir, (qf.start_year, qf.end_year))
    common = dict(
        query_filters=qf, by_year=spec.get("by_year", False), rel_rate=spec.get("rel_rate", False),
        filter_unitids=spec.get("filter_unitids"),
    )
    m = spec["method"]
    if m in ("rollup", "uni_rollup"):
        ro = TaxonomyRollup(*spec["rollup"])
        if m == "rollup":
            df = eng.rollup_by_grouping(spec["grouping"], ro, **common)
        else:
            df = eng.uni_rollup_by_grouping(
                spec["grouping"], ro, effect_size=spec.get("effect_size", False), **common
            )
    else:
        tv = spec.get("taxonomy_values")
        if m == "field":
            df = eng.field_totals_by_grouping(spec["grouping"], spec["taxonomy"], taxonomy_values=tv, **common)
        else:
            df = eng.uni_field_totals_by_grouping(
                spec["grouping"], spec["taxonomy"], taxonomy_values=tv,
                effect_size=spec.get("effect_size", False), **common,
            )
    return presentable(df)


def canned_sql(spec: dict) -> str:
    m = spec["method"]
    per_unit = m.startswith("uni")
    kw = dict(
        grouping=spec["grouping"], agg_type="rollup" if "rollup" in m else "field", per_unit=per_unit,
        by_year=spec.get("by_year", False), rel_rate=spec.get("rel_rate", False),
        effect_size=spec.get("effect_size", False), unitids=spec.get("filter_unitids"),
        **{k: v for k, v in spec["filters"].items()},
    )
    if "rollup" in m:
        kw.update(field=None, taxonomy_col=spec["rollup"][0], taxonomy_values=spec["rollup"][1])
    else:
        tv = spec.get("taxonomy_values")
        kw.update(field=spec["taxonomy"], taxonomy_col=spec["taxonomy"] if tv else None, taxonomy_values=tv)
    return oracle.canned_query_sql(**kw)


def _canned_fn(spec: dict) -> QueryFn:
    return lambda spark, sf_dir: run_canned(spark, sf_dir, spec)


QUERIES: dict[str, QueryFn] = {name: _canned_fn(spec) for name, spec in CANNED.items()}
ORACLE: dict[str, str] = {name: canned_sql(spec) for name, spec in CANNED.items()}
