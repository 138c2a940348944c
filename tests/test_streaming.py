"""Streaming ingestion of yearly files: new years append, revisions replace."""

import os
import tempfile

from equiscope.operators import crosswalk as X
from equiscope.operators.reshape import POST_2010_CODES
from equiscope.streaming.ingest import start_ingest

COLS = ["UNITID", "CIPCODE", "MAJORNUM", "AWLEVEL"] + [c.upper() for c in POST_2010_CODES]


def write(root, year, name, rows):
    os.makedirs(f"{root}/{year}", exist_ok=True)
    with open(f"{root}/{year}/{name}", "w") as fh:
        fh.write(",".join(COLS) + "\n")
        for r in rows:
            fh.write(",".join(r) + "\n")


def row(unitid, code, n_first, total=False):
    cells = [str(n_first), "0"] + [""] * (len(POST_2010_CODES) - 2)
    return [str(unitid), "99.0000" if total else code, "1", "5"] + cells


def test_stream_ingest(spark):
    root = tempfile.mkdtemp(prefix="eqs-land-")
    target = tempfile.mkdtemp(prefix="eqs-fact-") + "/fact"
    ckpt = tempfile.mkdtemp(prefix="eqs-ckpt-")
    empty = spark.createDataFrame([], "origin_code string, dest_code string")
    hops = [X.Hop(2010, 2019, spark.createDataFrame([("01.0001", "01.0002")], "origin_code string, dest_code string"),
                  spark.createDataFrame([("01.0002", "Two")], "code string, title string")),
            X.Hop(1984, 2009, empty, spark.createDataFrame([], "code string, title string"))]
    lookup = X.taxonomy_lookup(spark.createDataFrame(
        [("01.0002", "Two", "Science and engineering", "Engineering", "Other Engineering")],
        "code string, title string, ncses_sci_group string, ncses_field_group string, ncses_detailed_field_group string"))
    stem = spark.createDataFrame([("01.0002",)], "code string")

    def run():
        q = start_ingest(spark, root, COLS, target, ckpt, hops, lookup, stem, POST_2010_CODES)
        q.awaitTermination(120)
        return spark.read.parquet(target)

    write(root, 2015, "c2015.csv", [row(1, "01.0001", 3), row(1, "", 0, total=True)])
    write(root, 2016, "c2016.csv", [row(2, "01.0003", 4)])
    fact = run()
    got = [(r["year"], r["unitid"], r["cip2020"], r["n_awards"], r["gender"]) for r in fact.collect()]
    # "0" cells dropped, empty cells kept as NULL, totals line dropped
    assert (2015, 1, "01.0002", 3, "men") in got
    assert all(r[0] in (2015, 2016) for r in got)
    assert {r[2] for r in got} == {"01.0002", "01.0003"}
    assert fact.filter("cip2020 = '01.0002'").first()["dhs_stem"] is True

    write(root, 2015, "c2015rv.csv", [row(7, "01.0001", 9)])
    fact = run()
    y15 = {(r["unitid"], r["revision"]) for r in fact.filter("year = 2015").collect()}
    assert y15 == {(7, 1)}
    assert fact.filter("year = 2016").count() > 0

    write(root, 2015, "c2015b.csv", [row(8, "01.0001", 5)])  # late original: ignored
    fact = run()
    assert {r["unitid"] for r in fact.filter("year = 2015").collect()} == {7}


def test_batch_reader_matches_stream_semantics(spark):
    from equiscope.plans.yearly import read_completions

    root = tempfile.mkdtemp(prefix="eqs-batch-")
    empty = spark.createDataFrame([], "origin_code string, dest_code string")
    hops = [X.Hop(1984, 2019, empty, spark.createDataFrame([], "code string, title string"))]
    lookup = X.taxonomy_lookup(spark.createDataFrame(
        [("01.0002", "Two", "Science and engineering", "Engineering", "Other Engineering")],
        "code string, title string, ncses_sci_group string, ncses_field_group string, ncses_detailed_field_group string"))
    stem = spark.createDataFrame([("01.0002",)], "code string")
    write(root, 2015, "c2015.csv", [row(1, "01.0002", 3), row(1, "", 0, total=True)])
    write(root, 2015, "c2015rv.csv", [row(7, "01.0002", 9)])
    write(root, 2016, "c2016.csv", [row(2, "01.0003", 4)])
    got = read_completions(spark, root, hops, lookup, stem, POST_2010_CODES)
    rows = got.filter("n_awards IS NOT NULL").collect()
    assert {(r["year"], r["unitid"]) for r in rows} == {(2015, 7), (2016, 2)}
    assert {r["dhs_stem"] for r in rows if r["cip2020"] == "01.0002"} == {True}


def test_files_of_one_year_add_up_under_a_cap(spark):
    """Two files of a year in two micro-batches, then a third one later."""
    root = tempfile.mkdtemp(prefix="eqs-land-")
    target, ckpt = tempfile.mkdtemp(prefix="eqs-fact-") + "/fact", tempfile.mkdtemp(prefix="eqs-ckpt-")
    empty = spark.createDataFrame([], "origin_code string, dest_code string")
    hops = [X.Hop(1984, 2019, empty, spark.createDataFrame([], "code string, title string"))]
    lookup = X.taxonomy_lookup(spark.createDataFrame(
        [], "code string, title string, ncses_sci_group string, ncses_field_group string, ncses_detailed_field_group string"))
    stem = spark.createDataFrame([("01.0002",)], "code string")

    def units():
        start_ingest(spark, root, COLS, target, ckpt, hops, lookup, stem, max_files_per_trigger=1).awaitTermination(240)
        return {(r["year"], r["unitid"]) for r in spark.read.parquet(target).collect()}

    write(root, 2015, "a.csv", [row(1, "01.0001", 3)])
    write(root, 2015, "b.csv", [row(2, "01.0001", 3)])
    write(root, 2016, "a.csv", [row(9, "01.0001", 3)])
    assert units() == {(2015, 1), (2015, 2), (2016, 9)}
    write(root, 2015, "c.csv", [row(3, "01.0001", 3)])
    assert units() == {(2015, 1), (2015, 2), (2015, 3), (2016, 9)}


def test_mixed_layouts(spark):
    """Columns by name, not by position; each layout with its own code set."""
    from equiscope.operators.reshape import PRE_1995_GENDERONLY_CODES, PRE_2010_CODES
    from equiscope.plans.yearly import read_completions

    root = tempfile.mkdtemp(prefix="eqs-mixed-")
    empty = spark.createDataFrame([], "origin_code string, dest_code string")
    hops = [X.Hop(1984, 2019, empty, spark.createDataFrame([], "code string, title string"))]
    lookup = X.taxonomy_lookup(spark.createDataFrame(
        [], "code string, title string, ncses_sci_group string, ncses_field_group string, ncses_detailed_field_group string"))
    stem = spark.createDataFrame([("01.0002",)], "code string")

    def put(year, header, *rows):
        os.makedirs(f"{root}/{year}")
        with open(f"{root}/{year}/c.csv", "w") as fh:
            fh.write("\n".join(",".join(map(str, r)) for r in [header, *rows]) + "\n")

    old, post = list(PRE_2010_CODES), list(POST_2010_CODES)
    put(1990, ["UNITID", "CIPCODE", "AWLEVEL", *PRE_1995_GENDERONLY_CODES, "CRACE24"], [1, "01.0001", 5, 7, 0, 99])
    put(2005, ["unitid", "cipcode", "majornum", "awlevel", *old, "crace24"], [2, "02.0202", 1, 5, *range(1, 15), 105])
    put(2015, ["awlevel", "unitid", *post[::-1], "majornum", "cipcode"], [7, 3, *range(1, 19), 2, "03.0303"])
    got = {(r.year, r.unitid, r.cipcode, r.awlevel, r.majornum, r.race_ethnicity, r.gender, r.n_awards)
           for r in read_completions(spark, root, hops, lookup, stem).collect()}
    expected = {(1990, 1, "01.0001", "Bachelor's degree", 1, *[x.value for x in PRE_1995_GENDERONLY_CODES["crace15"]], 7)}
    expected |= {(2005, 2, "02.0202", "Bachelor's degree", 1, r.value, g.value, i) for i, (r, g) in enumerate(PRE_2010_CODES.values(), 1)}
    expected |= {(2015, 3, "03.0303", "Master's degree", 2, *[x.value for x in POST_2010_CODES[c]], i) for i, c in enumerate(post[::-1], 1)}
    assert got == expected


def test_stream_carries_files_not_rows(spark):
    root, target = tempfile.mkdtemp(prefix="eqs-land-"), tempfile.mkdtemp(prefix="eqs-fact-") + "/fact"
    ckpt = tempfile.mkdtemp(prefix="eqs-ckpt-")
    empty = spark.createDataFrame([], "origin_code string, dest_code string")
    hops = [X.Hop(1984, 2019, empty, spark.createDataFrame([], "code string, title string"))]
    lookup = X.taxonomy_lookup(spark.createDataFrame(
        [], "code string, title string, ncses_sci_group string, ncses_field_group string, ncses_detailed_field_group string"))
    stem = spark.createDataFrame([("01.0002",)], "code string")
    os.makedirs(f"{root}/2014")
    open(f"{root}/2014/empty.csv", "w").close()
    q = start_ingest(spark, root, COLS, target, ckpt, hops, lookup, stem)
    q.awaitTermination(120)
    assert q.exception() is None
    write(root, 2015, "c.csv", [row(u, "01.0001", 3) for u in range(50)])
    q = start_ingest(spark, root, COLS, target, ckpt, hops, lookup, stem)
    q.awaitTermination(120)
    assert sum(p["numInputRows"] for p in q.recentProgress) == 1
    assert spark.read.parquet(target).select("unitid").distinct().count() == 50


def test_files_of_a_year_are_bounded(spark):
    """However many tasks write, a year has YEAR_FILES files at most."""
    from equiscope.plans.etl_registry import YEAR_FILES, by_year

    rows = spark.range(0, 4000, 1, 60).selectExpr("id as unitid", "cast(id % 7 as string) as cipcode", "2000 + id % 2 as year")
    spark.conf.set("spark.sql.shuffle.partitions", "60")
    try:
        root = tempfile.mkdtemp(prefix="eqs-years-") + "/x"
        by_year(rows).write.partitionBy("year").csv(root)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    for y in (2000, 2001):
        assert len([f for f in os.listdir(f"{root}/year={y}") if f.endswith(".csv")]) <= YEAR_FILES
    assert spark.read.csv(root).count() == 4000


def test_codes_are_looked_up_before_the_unpivot(spark):
    from equiscope.plans.yearly import completions_from_wide

    empty = spark.createDataFrame([], "origin_code string, dest_code string")
    hops = [X.Hop(1984, 2019, empty, spark.createDataFrame([], "code string, title string"))]
    lookup = X.taxonomy_lookup(spark.createDataFrame(
        [("01.0002", "Two", "Science and engineering", "Engineering", "Other Engineering")],
        "code string, title string, ncses_sci_group string, ncses_field_group string, ncses_detailed_field_group string"))
    cells = ", ".join(f"{c} string" for c in POST_2010_CODES)
    wide = spark.createDataFrame([(1, "01.0002", 5, 1, 2015, "4", "0", *[None] * 16)],
                                 f"unitid long, cipcode string, awlevel int, majornum int, year int, {cells}")
    out = completions_from_wide(wide, hops, lookup, spark.createDataFrame([("01.0002",)], "code string"))
    lines = out._jdf.queryExecution().optimizedPlan().toString().splitlines()
    spread = next(i for i, x in enumerate(lines) if "Generate" in x or "Expand" in x)
    assert not any("Join" in x for x in lines[:spread])
    rows = out.collect()
    assert len(rows) == 17 and {(r.cip_title, r.dhs_stem) for r in rows} == {("Two", True)}
    assert out.columns[6:10] == ["race_ethnicity", "gender", "n_awards", "cip_title"]
