"""Crosswalk and classification goldens with minimal hand-built lookups."""

import pytest

from equiscope.operators import crosswalk as X
from equiscope.vocab import NCSESSciGroup, NSFBroadField

T = {
    "22.0303": "Court Reporting and Captioning/Court Reporter",
    "26.1502": "Neuroanatomy",
    "52.0302": "Accounting Technology/Technician and Bookkeeping",
    "52.0201": "Business Administration and Management, General",
    "11.0202": "Computer Programming, Specific Applications",
    "51.1504": "Community Health Services/Liaison/Counseling",
}


def hop(spark, start, end, codes, titles):
    c = spark.createDataFrame(list(codes.items()) or [("x", "x")], "origin_code string, dest_code string")
    if not codes:
        c = c.limit(0)
    t = spark.createDataFrame(list(titles.items()) or [("x", "x")], "code string, title string")
    if not titles:
        t = t.limit(0)
    return X.Hop(start, end, c, t)


@pytest.fixture(scope="module")
def hops(spark):
    return [
        hop(spark, 1984, 1991, {"07.0103": "07.0102", "06.0401": "06.0400", "07.0305": "11.0200", "17.0499": "17.0400"}, {}),
        hop(spark, 1990, 1999, {"52.0405": "22.0103", "07.0102": "52.0302", "06.0400": "52.0201", "11.0200": "11.0202",
                                "17.0400": "51.1504"}, {"52.0302": "old title"}),
        hop(spark, 2000, 2009, {"26.0405": "26.1502", "22.0103": "22.0303"}, {"26.1502": "Neuroanatomy (2010)"}),
        hop(spark, 2010, 2019, {}, T),
    ]


@pytest.mark.parametrize(
    "year, old, new",
    [(2010, "22.0303", "22.0303"), (2019, "22.0303", "22.0303"), (2000, "26.0405", "26.1502"), (2009, "26.0405", "26.1502"),
     (1990, "52.0405", "22.0303"), (1999, "52.0405", "22.0303"), (1984, "07.0103", "52.0302"), (1989, "07.0103", "52.0302"),
     (1991, "06.0401", "52.0201"), (1990, "07.0305", "11.0202"), (1990, "17.0499", "51.1504")],
)
def test_chain(spark, hops, year, old, new):
    df = spark.createDataFrame([(year, old)], "year int, cipcode string")
    r = X.crosswalk_chain(df, hops).collect()[0]
    assert r["cip2020"] == new
    assert r["cip2020_title"] == T[new]


def test_unknown_code_keeps_title(spark, hops):
    df = spark.createDataFrame([(1990, "91.9129", "Mystery")], "year int, cipcode string, t string")
    r = X.crosswalk_chain(df, hops, title="t").collect()[0]
    assert (r["cip2020"], r["cip2020_title"]) == ("91.9129", "Mystery")


def test_after_last_range_unchanged(spark, hops):
    df = spark.createDataFrame([(2021, "26.0405")], "year int, cipcode string")
    r = X.crosswalk_chain(df, hops).collect()[0]
    assert r["cip2020"] == "26.0405" and r["cip2020_title"] is None


def test_year_before_first_range_raises(spark, hops):
    df = spark.createDataFrame([(1980, "26.0405")], "year int, cipcode string")
    with pytest.raises(Exception, match="at least 1984"):
        X.crosswalk_chain(df, hops).collect()


def test_moved_loader_last_row_wins(spark):
    raw = spark.createDataFrame(
        [('="01.0001"', '="01.0002"', "Moved to", "A.", 1), ('="01.0001"', '="01.0003"', "moved TO", "B.", 2),
         ('="01.0004"', '="01.0005"', "Deleted", "X (Deleted)", 3)],
        "o string, d string, a string, t string, p long",
    )
    h = X.load_moved_crosswalk(raw, "o", "d", "t", "a", "p", 2010, 2019)
    assert [tuple(r) for r in h.codes.collect()] == [("01.0001", "01.0003")]
    assert sorted(tuple(r) for r in h.titles.collect()) == [("01.0002", "A"), ("01.0003", "B")]


def test_legacy_loader_priority_and_corrections(spark):
    pdf = spark.createDataFrame([("01.01", "02.02", "pdf", 1), ("03.03", "04.04", "pdf", 2)], "o string, d string, t string, p long")
    xls = spark.createDataFrame([("01.01", "09.09", "xls", 1), ("05.05", "Report as 06.06", "x", 2), ("07.07", "07.07", "s", 3),
                                 ("08.08", None, "n", 4)], "o string, d string, t string, p long")
    h = X.load_legacy_crosswalk([pdf, xls], "o", "d", "t", "p", 1984, 1991, corrections={"51.1313": "26.0901"})
    assert dict(tuple(r) for r in h.codes.collect()) == {"01.01": "09.09", "03.03": "04.04", "51.1313": "26.0901"}


def test_classification(spark):
    raw = spark.createDataFrame(
        [
            ("Science and engineering", "Life Sciences", "Agricultural Sciences", "01.0308 - Agroecology and Sustainable Agriculture.", 1),
            ("Science and engineering", "Engineering", "Aerospace Engineering", "14.0202 - Astronautical Engineering", 2),
            ("Non-science and engineering", "Architecture and Environmental Design", "Architecture and Environmental Design",
             "04.0200 - Pre-Architecture Studies", 3),
            ("Non-science and engineering", "Life Sciences", "Medical Sciences", "51.0507 - Oral/Maxillofacial Surgery", 4),
            ("Science and engineering", "Engineering", "x", "Total for selected values", 5),
        ],
        "sg string, fg string, dg string, s string, p long",
    )
    lk = X.taxonomy_lookup(X.load_taxonomy(raw, "sg", "fg", "dg", "s", "p"), X.missing_codes_frame(spark))
    codes = ["01.0308", "14.0202", "04.0200", "51.0507", "98.7654", "51.3205"]
    df = spark.createDataFrame([(c,) for c in codes], "cipcode string")
    got = {r["cipcode"]: r for r in X.classify_taxonomy(df, lk, "cipcode", None).collect()}
    assert got["01.0308"]["nsf_broad_field"] == NSFBroadField.ag_and_bio_sci.value
    assert got["01.0308"]["cip_title"] == "Agroecology and Sustainable Agriculture"
    assert got["14.0202"]["ncses_detailed_field_group"] == "Aerospace Engineering"
    assert got["14.0202"]["nsf_broad_field"] == "Engineering"
    assert got["04.0200"]["nsf_broad_field"] == NSFBroadField.non_stem.value
    assert got["51.0507"]["ncses_field_group"] == "Life Sciences (Non-S&E)"
    assert got["51.0507"]["nsf_broad_field"] == NSFBroadField.non_stem.value
    assert got["98.7654"]["cip_title"] == "Unknown"
    assert got["98.7654"]["ncses_sci_group"] == NCSESSciGroup.unknown.value
    assert got["98.7654"]["nsf_broad_field"] == NSFBroadField.unknown.value
    assert got["51.3205"]["cip_title"] == "History of Medicine"


def test_classification_prefers_current_code(spark):
    lk = X.taxonomy_lookup(spark.createDataFrame(
        [("01.0001", "old", "Science and engineering", "Engineering", "Other Engineering"),
         ("02.0002", "new", "Non-science and engineering", "Law", "Law")],
        "code string, title string, ncses_sci_group string, ncses_field_group string, ncses_detailed_field_group string"))
    df = spark.createDataFrame([("01.0001", "02.0002"), ("01.0001", "99.9999")], "cipcode string, cip2020 string")
    got = X.classify_taxonomy(df, lk).collect()
    assert got[0]["cip_title"] == "new" and got[0]["nsf_broad_field"] == NSFBroadField.non_stem.value
    assert got[1]["cip_title"] == "old" and got[1]["nsf_broad_field"] == "Engineering"


def test_stem(spark):
    stem = spark.createDataFrame([("14.0202",), ("27.0101",)], "code string")
    df = spark.createDataFrame([("43.0110",), ("39.0302",), ("14.0202",), (None,)], "cip2020 string")
    assert [r["dhs_stem"] for r in X.classify_stem(df, stem).collect()] == [False, False, True, False]
