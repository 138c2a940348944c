"""Physical-plan guards: shuffles, scans, joins and pushdown."""

import os
import re

import pytest

from equiscope.operators.filters import QueryFilters, TaxonomyRollup
from equiscope.plans.engine import CompletionsEngine
from equiscope.sources import files as FS
from equiscope.sources.tables import completions_fact, institutions_dim

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables not present")


def executed_plan(df) -> str:
    """The AQE final plan only (the string also carries the initial plan)."""
    df.collect()
    text = df._jdf.queryExecution().executedPlan().toString()
    return text.split("== Initial Plan ==")[0]


@pytest.fixture(scope="module")
def eng(spark):
    return CompletionsEngine(spark, completions_fact(spark, SF), institutions_dim(spark, SF), check_values=False)


def test_uni_grid_plan(eng):
    df = eng.uni_field_totals_by_grouping("intersectional", "ncses_detailed_field_group",
                                          QueryFilters(1996, 2000, strict=False), by_year=True)
    plan = executed_plan(df)
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    shuffles = re.findall(r"Exchange hashpartitioning", plan)
    assert len(shuffles) <= 2, plan
    assert plan.count("FileScan parquet [l_orderkey") == 1


def test_national_plan_scans_fact_once(eng):
    df = eng.rollup_by_grouping("gender", TaxonomyRollup("ncses_field_group", ["FG1"]), QueryFilters(strict=False))
    plan = executed_plan(df)
    assert plan.count("FileScan parquet [l_orderkey") == 1
    assert "Subquery" not in plan and "CartesianProduct" not in plan


def test_stored_fact_prunes_year_partitions(spark):
    path = FS.scratch_path(spark, "plan-fact")
    FS.write_fact(completions_fact(spark, SF), path)
    eng = CompletionsEngine(spark, FS.read_fact(spark, path), None, check_values=False)
    df = eng.field_totals_by_grouping("gender", "ncses_field_group", QueryFilters(1997, 1998, strict=False))
    plan = executed_plan(df)
    assert re.search(r"PartitionFilters: \[[^\]]*year#\d+ >= 1997", plan), plan
    scan = [line for line in plan.splitlines() if "FileScan parquet" in line][0]
    assert "ReadSchema" in scan and "institution_name" not in scan and "cip_title" not in scan


def test_registered_queries_read_all_years():
    """Orders run from 1995 to 2001; only the year filter's own queries read less."""
    from equiscope.plans.registry import CANNED

    part = {n for n, s in CANNED.items() if s["filters"]["start_year"] > 1995 or s["filters"]["end_year"] < 2001}
    assert part == {"filter_base", "filter_year_range_empty"}


def test_year_range_reaches_the_orders_scan(spark):
    from equiscope.plans.registry import CANNED, run_canned

    spark.conf.set("spark.sql.maxMetadataStringLength", "4000")
    try:
        plan = run_canned(spark, "/root/testdata/sf0.001", CANNED["filter_base"])._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.maxMetadataStringLength")
    scan = next(x for x in plan.split("\n") if "o_orderdate" in x and "PushedFilters" in x)
    assert "GreaterThanOrEqual(o_orderdate,1996-01-01T00:00)" in scan and "LessThan(o_orderdate,2000-01-01T00:00)" in scan


def test_distinct_counts_do_not_copy_rows(spark):
    from equiscope.operators.reports import count_distinct_domains

    df = spark.range(100).selectExpr("id % 3 as a", "if(id % 5 = 0, null, id % 5) as b", "id as c")
    out = count_distinct_domains(df, ["a", "b", "c"])
    assert "Expand" not in out._jdf.queryExecution().executedPlan().toString()
    assert out.first().asDict() == {"n_a": 3, "n_b": 4, "n_c": 100}
