"""Wide -> tidy reshape, code normalisation, institution merge, file sources."""

import os
import tempfile

import pytest
from pyspark.sql import functions as F

from equiscope.operators import institutions as I
from equiscope.operators import reshape as S
from equiscope.sources import files as FS


def test_code_set_choice():
    assert S.choose_code_set(["crace15", "crace16"]) is S.PRE_1995_GENDERONLY_CODES
    assert S.choose_code_set(list(S.PRE_2010_CODES)) is S.PRE_2010_CODES
    assert S.choose_code_set(list(S.INTERIM_CODES) + ["ctotalt"]) is S.INTERIM_CODES
    assert S.choose_code_set(list(S.POST_2010_CODES)) is S.POST_2010_CODES


def test_unpivot_keeps_null_and_drops_zero(spark):
    df = spark.createDataFrame([(1, "01.0001", "3", "0", None, "x")], "unitid long, cipcode string, crace15 string, crace16 string, crace99 string, other string")
    with pytest.raises(KeyError):
        S.unpivot_groups(df.drop("crace16"), ["unitid", "cipcode"], S.PRE_1995_GENDERONLY_CODES)
    t = S.unpivot_groups(df.select("unitid", "cipcode", "crace15", "crace16"), ["unitid", "cipcode"])
    got = sorted((r["gender"], r["n_awards"]) for r in t.collect())
    assert got == [("men", "3"), ("women", "0")]
    assert [r["n_awards"] for r in S.filter_zero(t).collect()] == ["3"]
    t2 = S.unpivot_groups(spark.createDataFrame([(1, None, "2")], "unitid long, crace15 string, crace16 string"), ["unitid"])
    assert sorted((r["gender"], r["n_awards"]) for r in S.filter_zero(t2).collect()) == [("men", None), ("women", "2")]


def test_award_levels_and_codes(spark):
    df = spark.createDataFrame([(1, "12345", 1985), (10, "123456", 1986), (11, " 12.3456 ", 1990), (99, "99.0000", 1990)],
                               "aw int, code string, year int")
    got = df.select(S.map_award_level(F.col("aw")).alias("a"), S.normalise_code(F.col("code"), F.col("year")).alias("c")).collect()
    assert [r["a"] for r in got] == ["Award of less than 1 academic year", "Doctor's degree - professional practice",
                                     "Post-master's certificates", "Unknown"]
    assert [r["c"] for r in got] == ["01.2345", "12.3456", "12.3456", "99.0000"]
    kept = S.filter_total_codes(df.withColumn("cipcode", S.normalise_code(F.col("code"), F.col("year"))))
    assert kept.count() == 3


def test_default_majornum(spark):
    df = spark.createDataFrame([(1, "01.0001", "5")], "unitid long, cipcode string, awlevel string")
    assert S.default_majornum(df).collect()[0]["majornum"] == 1


def attrs(spark):
    return spark.createDataFrame(
        [(1, 2020, 1, "A", "X"), (1, 2021, 2, "B", None), (1, 2022, 3, None, None), (2, 2020, 4, None, "Y")],
        "unitid long, metadata_vintage int, ev long, institution_name string, city string",
    )


def test_latest_non_null(spark):
    got = {r["unitid"]: r for r in I.latest_non_null(attrs(spark), "unitid", "metadata_vintage", "ev",
                                                     ["institution_name", "city"]).collect()}
    assert (got[1]["institution_name"], got[1]["city"], got[1]["metadata_vintage"]) == ("B", "X", 2022)
    assert (got[2]["institution_name"], got[2]["city"]) == (None, "Y")


def test_keep_latest_and_forward_fill(spark):
    latest = {r["unitid"]: r for r in I.keep_latest(attrs(spark), "unitid", "metadata_vintage", "ev").collect()}
    assert latest[1]["ev"] == 3 and latest[1]["institution_name"] is None
    ff = I.forward_fill(attrs(spark), "unitid", "metadata_vintage", ["institution_name", "city"], "ev")
    got = {r["ev"]: (r["institution_name"], r["city"]) for r in ff.collect()}
    assert got[3] == ("B", "X") and got[4] == (None, "Y")


def test_flags_and_region(spark):
    df = spark.createDataFrame([("Georgia Institute of Technology",), ("Health Sciences University",), ("Art College",), (None,)], "n string")
    got = df.select(I.tech_school(F.col("n")), I.health_school(F.col("n"))).collect()
    assert [tuple(r) for r in got] == [(True, False), (False, True), (False, False), (None, None)]
    r = spark.createDataFrame([("Other US jurisdictions (AS, FM, GU, MH, MP, PR, PW, VI)",), ("Far West  AK, CA.",)], "s string")
    assert [x[0] for x in r.select(I.normalise_region(F.col("s"))).collect()] == [
        "Outlying areas AS FM GU MH MP PR PW VI", "Far West AK CA"]


def test_code_labels(spark):
    df = spark.createDataFrame([(1, "1", "CA"), (2, "9", "NY")], "unitid long, CONTROL string, STABBR string")
    d = spark.createDataFrame([("CONTROL", "1", "Public"), ("STABBR", "CA", "California")], "varname string, codevalue string, valuelabel string")
    got = I.join_code_labels(df, d, ["CONTROL", "STABBR"]).orderBy("unitid").collect()
    assert [(r["CONTROL"], r["STABBR"]) for r in got] == [("Public", "CA"), (None, "NY")]
    assert [r[0] for r in I.unmapped_codes(df, d, "CONTROL").collect()] == ["9"]


def test_latest_column_names(spark):
    names = spark.createDataFrame([("ZIP", "zip", 2020), ("ZIP", "zip_code", 2022), ("INSTNM", "institution_name", 2021)],
                                  "original_colname string, mapped_colname string, metadata_vintage int")
    assert dict(tuple(r) for r in I.latest_column_names(names).collect()) == {"ZIP": "zip_code", "INSTNM": "institution_name"}


def test_prefer_revised_files(spark):
    root = tempfile.mkdtemp(prefix="eqs-raw-")
    for year, files in {"1995": {"c1995.csv": "unitid,cipcode\n1,01.0001\n"},
                        "1996": {"c1996.csv": "unitid,cipcode\n1,OLD\n", "c1996rv.csv": "unitid,cipcode\n1,NEW\n2,NEW\n"}}.items():
        os.makedirs(f"{root}/{year}")
        for name, body in files.items():
            with open(f"{root}/{year}/{name}", "w") as fh:
                fh.write(body)
    got = sorted((r["year"], r["cipcode"]) for r in FS.read_prefer_revised(spark, root).collect())
    assert got == [(1995, "01.0001"), (1996, "NEW"), (1996, "NEW")]


def test_fact_sink_refuses_overwrite(spark, fixture_fact):
    path = FS.scratch_path(spark, "test-fact")
    FS.write_fact(fixture_fact, path)
    assert FS.read_fact(spark, path).count() == 72
    with pytest.raises(Exception):
        FS.write_fact(fixture_fact, path)
    FS.write_fact(fixture_fact, path, overwrite=True)
    assert FS.read_fact(spark, path).filter("year = 1984").count() == 36


def test_forward_fill_distributed_matches_window_on_skew(spark):
    import random

    rnd = random.Random(3)
    rows = []
    for i in range(20000):
        k = 0 if i % 3 else rnd.randint(1, 40)  # key 0 holds two thirds of the rows
        rows.append((k, i, rnd.choice([None, None, None, f"v{i}"]), rnd.choice([None, float(i)])))
    df = spark.createDataFrame(rows, "k long, t long, a string, b double").repartition(7)
    got = I.forward_fill(df, "k", "t", ["a", "b"])
    ref = I.forward_fill(df, "k", "t", ["a", "b"], strategy="window")
    assert got.columns == df.columns
    assert sorted(map(tuple, got.collect()), key=str) == sorted(map(tuple, ref.collect()), key=str)


def test_database_roundtrip(spark, fixture_fact, all_filters):
    from equiscope.plans.engine import CompletionsEngine

    inst = spark.createDataFrame([(1, "University 1"), (2, "University 2")], "unitid long, institution_name string")
    root = FS.scratch_path(spark, "test-db")
    FS.write_database(fixture_fact, inst, root)
    with pytest.raises(Exception):
        FS.write_database(fixture_fact, inst, root)
    eng = CompletionsEngine.from_database(spark, root)
    assert "cip_title" not in eng.fact.columns
    assert eng.get_cip_table().count() == 3
    df = eng.uni_field_totals_by_grouping("gender", "ncses_detailed_field_group", all_filters)
    assert df.count() == 12


def test_failed_write_keeps_the_former_tables(spark, fixture_fact):
    """The institutions, written last, fail: the database is as it was."""
    inst = spark.createDataFrame([(1, "University 1")], "unitid long, institution_name string")
    root = FS.scratch_path(spark, "test-db-fail")
    with pytest.raises(FileNotFoundError):
        FS.read_database(spark, root)
    FS.write_database(fixture_fact, inst, root)
    before = {t: sorted(map(str, d.collect())) for t, d in FS.read_database(spark, root).items()}
    opened = FS.read_database(spark, root)
    broken = inst.withColumn("institution_name", F.raise_error(F.lit("broken")).cast("string"))
    with pytest.raises(Exception, match="broken"):
        FS.write_database(fixture_fact.limit(3), broken, root, overwrite=True)
    assert {t: sorted(map(str, d.collect())) for t, d in FS.read_database(spark, root).items()} == before
    FS.write_database(fixture_fact.limit(3), inst, root, overwrite=True)
    assert FS.read_database(spark, root)["completions"].count() == 3
    assert {t: sorted(map(str, d.collect())) for t, d in opened.items()} == before


def write_lines(path, *lines):
    with open(path, "w") as fh:
        fh.write("\n".join(lines) + "\n")


def test_typed_loader_checks_headers_and_values(spark):
    names = FS.FACT_SCHEMA.names
    row = {"year": "2001", "unitid": "7", "cipcode": "01.0100", "awlevel": "x", "majornum": "1", "cip2020": "01.0100",
           "race_ethnicity": "r", "gender": "g", "n_awards": "12", "cip_title": "t", "ncses_sci_group": "a",
           "ncses_field_group": "b", "ncses_detailed_field_group": "c", "nsf_broad_field": "d", "dhs_stem": "true"}
    root = tempfile.mkdtemp(prefix="eqs-typed-")
    write_lines(f"{root}/a.csv", ",".join(names), ",".join(row[n] for n in names))
    write_lines(f"{root}/b.csv", ",".join(names[::-1]), ",".join({**row, "unitid": "8"}[n] for n in names[::-1]))
    got = FS.read_fact_csv(spark, root).orderBy("unitid").collect()
    assert [r.unitid for r in got] == [7, 8] and all(r.n_awards == 12 and r.dhs_stem is True and r.cipcode == "01.0100" for r in got)
    write_lines(f"{root}/c.csv", ",".join(names), ",".join({**row, "n_awards": "twelve", "unitid": "9"}[n] for n in names))
    with pytest.raises(Exception, match="n_awards"):
        FS.read_fact_csv(spark, root).select("unitid").collect()
    good, bad = FS.read_fact_csv_with_rejects(spark, root)
    assert good.count() == 2 and [(r.unitid, r.n_awards, r.bad_values) for r in bad.collect()] == [(9, None, ["n_awards"])]
    write_lines(f"{root}/d.csv", ",".join([*names[:-1], "other"]), ",".join(row[n] for n in names))
    with pytest.raises(ValueError, match="dhs_stem.*other"):
        FS.read_fact_csv(spark, root)


def test_headers_are_read_without_scanning_the_files(spark):
    root = tempfile.mkdtemp(prefix="eqs-head-")
    write_lines(f"{root}/a b.csv", "x,y", *["1,2"] * 300_000)
    write_lines(f"{root}/b.csv", "y,x")
    open(f"{root}/empty.csv", "w").close()
    spark.conf.set("spark.sql.files.maxPartitionBytes", "64k")
    try:
        got = FS.file_headers(spark, f"{root}/*.csv")
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert [h for _, h in got] == ["x,y", "y,x"] and got[0][0].endswith("a%20b.csv")


def test_read_lookup_csv(spark):
    root = tempfile.mkdtemp(prefix="eqs-lk-")
    with open(f"{root}/freq.csv", "w") as fh:
        fh.write("VarName,CodeValue,ValueLabel\nCONTROL,1,Public\n")
    d = FS.read_lookup_csv(spark, f"{root}/freq.csv")
    assert d.columns == ["varname", "codevalue", "valuelabel"]


def test_read_institutions(spark):
    from equiscope.plans.yearly import read_institutions

    root = tempfile.mkdtemp(prefix="eqs-inst-")
    files = {
        "2020": "UNITID,INSTNM,CONTROL,STABBR\n1, Old Tech ,1,CA\n2,Art School,2,NY\n",
        "2021": "UNITID,INSTNM,CONTROL\n1,Institute of Technology,\n3,Health Science Center,9\n",
    }
    for year, body in files.items():
        os.makedirs(f"{root}/{year}")
        with open(f"{root}/{year}/hd{year}.csv", "w", encoding="latin-1") as fh:
            fh.write(body)
    d = spark.createDataFrame([("CONTROL", "1", "Public"), ("CONTROL", "2", "Private")], "varname string, codevalue string, valuelabel string")
    names = spark.createDataFrame([("INSTNM", "institution_name", 2021), ("CONTROL", "control", 2021),
                                   ("UNITID", "unitid", 2021), ("STABBR", "state", 2021)],
                                  "original_colname string, mapped_colname string, metadata_vintage int")
    got = {r["unitid"]: r for r in read_institutions(spark, root, d, names).collect()}
    assert got[1]["institution_name"] == "Institute of Technology" and got[1]["tech_school"] is True
    assert got[1]["control"] == "Public" and got[1]["state"] == "CA" and got[1]["metadata_vintage"] == 2021
    assert got[2]["control"] == "Private" and got[3]["health_school"] is True and got[3]["control"] is None


def test_tried_is_try_cast(spark):
    """The guard before the cast takes every text that the cast takes."""
    from pyspark.sql.types import BooleanType, DoubleType, IntegerType, LongType

    texts = ["1", "-1", "+7", " 12\t", "\n3 ", "", " ", "twelve", "1.5", "1.", ".5", "1e3", "0x1", "1 2", "--1", "1L", "\x003\x7f",
             "\u00a05", "\u0663", "2147483648", "9223372036854775808", "true", "TRUE ", "t", "Yes", "no", "n", "0", "off", "tru", "1.5x",
             "NaN", "-", None]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    for kind in (IntegerType(), LongType(), BooleanType(), DoubleType()):
        rows = df.select("t", F.col("t").try_cast(kind).alias("a"), FS.tried(F.col("t"), kind).alias("b")).collect()
        assert [(r.t, r.a) for r in rows if r.t != "NaN"] == [(r.t, r.b) for r in rows if r.t != "NaN"]


def test_unpivot_after_one_shuffle(spark):
    """Codes are summed in one aggregate; labels come with the cells."""
    from equiscope.plans import etl_registry as E

    ids = {c: F.lit(1) if c != "cipcode" else F.lit("01") for c in E.IDS}
    rows = [("cunknm", 3), ("cunknm", 5), ("cnralw", 7), ("other", 1), (None, 1)]
    long = spark.createDataFrame(rows, "code string, n_awards long").withColumns(ids)
    wide = E.wide_from(long)
    assert wide._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning") == 1
    tidy = S.unpivot_groups(wide, E.IDS)
    assert "map" not in tidy._jdf.queryExecution().analyzed().toString().lower()
    got = {(r.race_ethnicity, r.gender): r.n_awards for r in tidy.collect()}
    expected = {tuple(x.value for x in rg): None for rg in S.POST_2010_CODES.values()}
    expected |= {tuple(x.value for x in S.POST_2010_CODES["cunknm"]): "1", tuple(x.value for x in S.POST_2010_CODES["cnralw"]): "0"}
    assert got == expected


def test_layouts_of_one_join(spark):
    """One pass over the tables gives the wide rows of every layout."""
    from equiscope.plans import etl_registry as E

    sf = "/root/testdata/sf0.001"
    for i, w in enumerate(E.layouts_wide(spark, sf)):
        assert all("/layout-sums-" in f for f in w.inputFiles())
        other = E.layout_wide(spark, sf, i)
        assert w.columns == other.columns
        assert sorted(map(str, w.collect())) == sorted(map(str, other.collect()))
