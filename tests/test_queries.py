"""Golden results of the four representation queries on the 72-row fixture."""

import warnings

import pytest

from equiscope.operators.filters import QueryFilters, TaxonomyRollup
from equiscope.vocab import AwardLevel, FieldTaxonomy, NCSESDetailedFieldGroup, NCSESSciGroup, RaceEthn

MATH = NCSESDetailedFieldGroup.math_stats.value
PSYCH = NCSESDetailedFieldGroup.psych.value
DETAILED = FieldTaxonomy.ncses_detailed_field_group.value


def rows(df, n_values=4):
    cols = df.columns
    vcols = [c for c in cols if "degrees" in c][:n_values]
    return [tuple(r[c] for c in vcols) for r in df.collect()]


def check(df, n_rows, values):
    got = rows(df)
    assert len(got) == n_rows
    assert set(got) == {tuple(values)}


@pytest.mark.parametrize(
    "grouping, values_, n, expected",
    [
        ("gender", [MATH], 2, (12, 24, 36, 72)),
        ("gender", [MATH, PSYCH], 2, (24, 48, 36, 72)),
        ("race_ethnicity", [MATH], 3, (8, 24, 24, 72)),
        ("race_ethnicity", [MATH, PSYCH], 3, (16, 48, 24, 72)),
        ("intersectional", [MATH], 6, (4, 24, 12, 72)),
    ],
)
def test_rollup(fixture_engine, all_filters, grouping, values_, n, expected):
    df = fixture_engine.rollup_by_grouping(grouping, TaxonomyRollup(DETAILED, values_), all_filters)
    check(df, n, expected)


def test_rollup_by_year_and_units(fixture_engine, all_filters):
    ro = TaxonomyRollup(DETAILED, [MATH])
    check(fixture_engine.rollup_by_grouping("gender", ro, all_filters, by_year=True), 4, (6, 12, 18, 36))
    check(fixture_engine.rollup_by_grouping("gender", ro, all_filters, by_year=True, filter_unitids=[1]), 4, (3, 6, 9, 18))


@pytest.mark.parametrize(
    "grouping, by_year, units, values_, n, expected",
    [
        ("gender", False, None, None, 6, (12, 24, 36, 72)),
        ("race_ethnicity", False, None, None, 9, (8, 24, 24, 72)),
        ("race_ethnicity", True, None, None, 18, (4, 12, 12, 36)),
        ("intersectional", False, None, None, 18, (4, 24, 12, 72)),
        ("intersectional", False, [2], None, 18, (2, 12, 6, 36)),
        ("intersectional", False, None, [MATH, PSYCH], 12, (4, 24, 12, 72)),
    ],
)
def test_field_totals(fixture_engine, all_filters, grouping, by_year, units, values_, n, expected):
    df = fixture_engine.field_totals_by_grouping(grouping, DETAILED, all_filters, taxonomy_values=values_,
                                                 by_year=by_year, filter_unitids=units)
    check(df, n, expected)


SCI = TaxonomyRollup(FieldTaxonomy.ncses_sci_group, NCSESSciGroup.sci)


@pytest.mark.parametrize(
    "grouping, by_year, units, n, expected",
    [
        ("gender", False, None, 4, (6, 12, 18, 36)),
        ("gender", True, None, 8, (3, 6, 9, 18)),
        ("race_ethnicity", False, None, 6, (4, 12, 12, 36)),
        ("intersectional", False, None, 12, (2, 12, 6, 36)),
        ("intersectional", False, [1], 6, (2, 12, 6, 36)),
    ],
)
def test_uni_rollup(fixture_engine, all_filters, grouping, by_year, units, n, expected):
    df = fixture_engine.uni_rollup_by_grouping(grouping, SCI, all_filters, by_year=by_year, filter_unitids=units)
    check(df, n, expected)
    names = {r["unitid"]: r["institution_name"] for r in df.collect()}
    assert all(names[u] == f"University {u}" for u in names)
    assert df.columns[:3] == ["institution_name", "unitid", *(["gender"] if grouping == "gender" else df.columns[2:3])]


@pytest.mark.parametrize(
    "grouping, by_year, units, values_, n, expected",
    [
        ("gender", False, None, None, 12, (6, 12, 18, 36)),
        ("gender", True, None, None, 24, (3, 6, 9, 18)),
        ("race_ethnicity", False, None, None, 18, (4, 12, 12, 36)),
        ("intersectional", False, None, None, 36, (2, 12, 6, 36)),
        ("intersectional", True, None, [MATH, PSYCH], 48, (1, 6, 3, 18)),
        ("intersectional", True, [2], None, 36, (1, 6, 3, 18)),
    ],
)
def test_uni_field_totals(fixture_engine, all_filters, grouping, by_year, units, values_, n, expected):
    df = fixture_engine.uni_field_totals_by_grouping(grouping, DETAILED, all_filters, taxonomy_values=values_,
                                                     by_year=by_year, filter_unitids=units)
    check(df, n, expected)


def test_column_order(fixture_engine, all_filters):
    df = fixture_engine.uni_field_totals_by_grouping("intersectional", DETAILED, all_filters, by_year=True, effect_size=True)
    assert df.columns[:10] == [
        "institution_name", "unitid", DETAILED, "race_ethnicity", "gender", "year",
        "field_degrees_intersectional", "field_degrees_total", "uni_degrees_intersectional", "uni_degrees_total",
    ]
    assert df.columns[-8:] == [
        "excess_degrees_from_parity", "excess_degrees_from_parity_zscore", "excess_degrees_from_parity_pvalue",
        "median_rel_rate_uni", "median_rel_rate_expected_degrees", "excess_degrees_from_median_expected",
        "excess_degrees_from_median_expected_zscore", "excess_degrees_from_median_expected_pvalue",
    ]


def test_sorted(fixture_engine, all_filters):
    df = fixture_engine.field_totals_by_grouping("intersectional", DETAILED, all_filters, sort=True)
    keys = [(r[DETAILED], r["race_ethnicity"], r["gender"]) for r in df.collect()]
    assert keys == sorted(keys)


def test_filters_to_empty(fixture_engine):
    with warnings.catch_warnings():
        warnings.simplefilter("ignore")
        masters = QueryFilters(award_levels=[AwardLevel.masters])
        years = QueryFilters(start_year=1996, end_year=2021)
        unknown = QueryFilters(race_ethns=[RaceEthn.unknown])
        major2 = QueryFilters(majornums=[2])
    for f in (masters, years, unknown, major2):
        assert fixture_engine.rollup_by_grouping("gender", SCI, f).count() == 0
        assert fixture_engine.field_totals_by_grouping("gender", "ncses_field_group", f).count() == 0
        assert fixture_engine.uni_field_totals_by_grouping("gender", "ncses_field_group", f).count() == 0


def test_rollup_with_no_matching_field_keeps_groups(fixture_engine, all_filters):
    with pytest.warns(UserWarning, match="never takes"):
        df = fixture_engine.rollup_by_grouping("gender", TaxonomyRollup(DETAILED, ["Nope"]), all_filters, rel_rate=True)
    got = df.collect()
    assert len(got) == 2
    assert all(r["rollup_degrees_within_gender"] == 0 and r["rollup_degrees_total"] == 0 for r in got)


def test_boolean_taxonomy(fixture_engine, all_filters):
    df = fixture_engine.field_totals_by_grouping("gender", "dhs_stem", all_filters, taxonomy_values=[True])
    got = df.collect()
    assert {r["dhs_stem"] for r in got} == {True}
    assert {r["field_degrees_total"] for r in got} == {48}


def test_zero_fill_sparse(spark, fixture_fact, all_filters):
    """Remove one cell: its group must come back zero-filled."""
    from pyspark.sql import functions as F

    from equiscope.plans.engine import CompletionsEngine

    sparse = fixture_fact.filter(
        ~((F.col("unitid") == 1) & (F.col("cip2020") == "27.0101") & (F.col("gender") == "women"))
    )
    eng = CompletionsEngine(spark, sparse, None, check_values=False)
    df = eng.uni_field_totals_by_grouping("gender", "cip2020", all_filters, rel_rate=True)
    r = [x for x in df.collect() if x["unitid"] == 1 and x["cip2020"] == "27.0101" and x["gender"] == "women"]
    assert len(r) == 1 and r[0]["field_degrees_within_gender"] == 0
    assert r[0]["rel_rate"] == 0.0 and r[0]["log2_rel_rate"] == float("-inf")
    assert df.count() == 12


def test_null_measure_counts_as_zero_but_keeps_group(spark, fixture_fact, all_filters):
    from pyspark.sql import functions as F

    from equiscope.plans.engine import CompletionsEngine

    nulled = fixture_fact.withColumn(
        "n_awards", F.when(F.col("race_ethnicity") == RaceEthn.asian.value, F.lit(None)).otherwise(F.col("n_awards"))
    )
    eng = CompletionsEngine(spark, nulled, None, check_values=False)
    got = eng.field_totals_by_grouping("race_ethnicity", DETAILED, all_filters).collect()
    asian = [r for r in got if r["race_ethnicity"] == RaceEthn.asian.value]
    assert len(asian) == 3 and all(r["field_degrees_within_race_ethnicity"] == 0 for r in asian)


def test_validation_errors():
    with pytest.raises(ValueError):
        QueryFilters(start_year=2000, end_year=1999)
    with pytest.raises(ValueError):
        QueryFilters(start_year=1900)
    with pytest.raises(ValueError):
        QueryFilters(race_ethns=["Martian"])
    with pytest.raises(ValueError):
        QueryFilters(majornums=[3])
    with pytest.raises(ValueError):
        TaxonomyRollup("not_a_taxonomy", ["x"])


def test_warnings():
    with pytest.warns(UserWarning, match="2010/2011"):
        QueryFilters(start_year=2005, end_year=2015)
    with pytest.warns(UserWarning, match="before 1995"):
        QueryFilters(start_year=1991, end_year=1995, race_ethns=[RaceEthn.two_or_more])
    with warnings.catch_warnings():
        warnings.simplefilter("error")
        QueryFilters(start_year=1991, end_year=1995, race_ethns=[RaceEthn.unknown])


def test_catalog(fixture_engine):
    assert fixture_engine.list_tables() == ["cip_info", "completions", "institutions"]
    assert fixture_engine.get_cip_table().count() == 3
    inst = fixture_engine.get_institutions_table("institution_name")
    assert inst.columns == ["unitid", "institution_name"]
    with pytest.raises(ValueError):
        fixture_engine.get_institutions_table(["nope"])
    df = fixture_engine.get_df_from_query(
        "SELECT count(*) AS n FROM completions WHERE array_contains(:g, gender) AND year = :y",
        {"g": ["women"], "y": 1984},
    )
    assert df.collect()[0]["n"] == 18


@pytest.mark.parametrize("by_year", [False, True])
@pytest.mark.parametrize("taxonomy", [t.value for t in FieldTaxonomy])
@pytest.mark.parametrize("grouping", ["gender", "race_ethnicity", "intersectional"])
def test_parameter_product(fixture_engine, all_filters, grouping, taxonomy, by_year):
    # effect sizes (the expensive part) on the by-year half of the product
    df = fixture_engine.uni_field_totals_by_grouping(grouping, taxonomy, all_filters, by_year=by_year,
                                                     rel_rate=True, effect_size=by_year)
    suffix = "intersectional" if grouping == "intersectional" else f"within_{grouping}"
    expected = [f"field_degrees_{suffix}", "field_pct", "rel_rate"]
    if by_year:
        expected += ["median_rel_rate_uni", "excess_degrees_from_median_expected_pvalue"]
    for c in expected:
        assert c in df.columns
    assert df.count() > 0
    nat = fixture_engine.field_totals_by_grouping(grouping, taxonomy, all_filters, by_year=by_year, rel_rate=True)
    assert nat.count() > 0 and "bounded_rel_rate" in nat.columns


def test_unitids_as_dataframe(spark, fixture_engine, all_filters):
    ids = spark.createDataFrame([(2,), (2,), (99,)], "unitid long")
    df = fixture_engine.uni_field_totals_by_grouping("intersectional", DETAILED, all_filters, by_year=True, filter_unitids=ids)
    check(df, 36, (1, 6, 3, 18))


def test_empty_lists_and_show_query(fixture_engine, all_filters, capsys):
    with warnings.catch_warnings():
        warnings.simplefilter("ignore")
        none = QueryFilters(race_ethns=[])
    assert fixture_engine.field_totals_by_grouping("gender", DETAILED, none).count() == 0
    # a falsy unit list means "no unit filter"
    assert fixture_engine.field_totals_by_grouping("gender", DETAILED, all_filters, filter_unitids=[]).count() == 6
    fixture_engine.field_totals_by_grouping("gender", DETAILED, all_filters, show_query=True)
    assert "Physical Plan" in capsys.readouterr().out


def test_engines_of_one_session_keep_their_own_tables(spark, fixture_fact):
    from equiscope.plans.engine import CompletionsEngine

    spark.range(3).createOrReplaceTempView("completions")
    one = CompletionsEngine(spark, fixture_fact, check_values=False)
    two = CompletionsEngine(spark, fixture_fact.limit(5), check_values=False)
    sql = "SELECT count(*) AS n, sum(n_awards) AS s FROM completions WHERE year > :y"
    first = one.get_df_from_query(sql, {"y": 0})
    assert [tuple(e.get_df_from_query(sql, {"y": 0}).first()) for e in (two, one)] == [(5, 5), (72, 72)]
    assert tuple(first.first()) == (72, 72)
    assert spark.table("completions").count() == 3  # the session's own view is untouched
    spark.catalog.dropTempView("completions")


def test_default_filters_drop_null_and_unknown_values(spark, fixture_fact):
    from pyspark.sql import functions as F

    from equiscope.operators.filters import apply_filters

    odd = fixture_fact.limit(3).withColumn("race_ethnicity", F.lit(None).cast("string"))
    odd = odd.unionByName(fixture_fact.limit(4).withColumn("awlevel", F.lit("No such level")))
    odd = odd.unionByName(fixture_fact.limit(5).withColumn("majornum", F.lit(None).cast("int")))
    with warnings.catch_warnings():
        warnings.simplefilter("ignore")
        assert apply_filters(fixture_fact.unionByName(odd), QueryFilters()).count() == 72
    assert apply_filters(fixture_fact, QueryFilters(strict=False), list(range(2, 5000))).count() == 36


def test_repeated_effect_sizes_leave_no_files(spark, fixture_engine, all_filters):
    import os

    from equiscope.session import ensure_checkpoint_dir

    folder = ensure_checkpoint_dir(spark).removeprefix("file:")
    before = sorted(os.listdir(folder))
    for _ in range(2):
        fixture_engine.uni_field_totals_by_grouping(
            "gender", "ncses_detailed_field_group", all_filters, effect_size=True).collect()
    assert sorted(os.listdir(folder)) == before
