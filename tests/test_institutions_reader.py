"""Institution files: layouts, dictionaries and titles by vintage."""

import pytest

from equiscope.plans.yearly import read_institutions
from equiscope.sources.files import read_stem_list


def put(root, vintage, name, lines):
    (root / str(vintage)).mkdir(exist_ok=True)
    (root / str(vintage) / name).write_bytes("\n".join(lines).encode("latin-1"))


@pytest.fixture
def root(tmp_path):
    put(tmp_path, 2010, "hd2010.csv", ["UNITID,INSTNM,OBEREG,STABBR,SECTOR", "1, Old Polytechnic ,5,AL,1", "2,Saint École,9,XX,2"])
    put(tmp_path, 2020, "hd2020.csv", ["SECTOR,INSTNM,UNITID,NEWVAR,STABBR,OBEREG", "7,New University,1,,AL,5", "1,Health Science College,3,z,NY,"])
    return tmp_path


DICTIONARY = "varname string, codevalue string, valuelabel string, metadata_vintage int, pos int"
ENTRIES = [
    ("OBEREG", "5", "Southeast AL, AR (FL).", 2010, 1), ("OBEREG", "9", "Other US jurisdictions AS FM GU MH MP PR PW VI", 2010, 2),
    ("OBEREG", "5", "Southeast  AL AR FL", 2020, 1), ("SECTOR", "1", "Zeta first", 2010, 3), ("SECTOR", "1", "Alpha last", 2010, 4),
    ("SECTOR", "2", "Second", 2010, 5), ("STABBR", "AL", "Alabama", 2010, 6),
]


def test_vintages(spark, root):
    names = [("OBEREG", "Bureau of Economic Analysis (BEA) regions", 2010), ("OBEREG", None, 2020), ("SECTOR", "Sector of institution", 2010),
             ("SECTOR", "Sector, new title", 2020), ("INSTNM", "Institution (entity) name", 2020), ("UNITID", "Unique id", 2020)]
    out = read_institutions(spark, str(root), spark.createDataFrame(ENTRIES, DICTIONARY),
                            spark.createDataFrame(names, "original_colname string, mapped_colname string, metadata_vintage int"))
    got = {r.unitid: r.asDict() for r in out.collect()}
    region = "bureau_of_economic_analysis_bea_regions"
    assert got[1]["institution_name"] == "New University" and not got[1]["tech_school"] and got[3]["health_school"]
    assert got[1][region] == "Southeast AL AR FL" and got[2][region] == "Outlying areas AS FM GU MH MP PR PW VI"
    assert got[2]["institution_name"] == "Saint École"
    # 2010 has entries for the sector (the last one wins), 2020 has none: raw
    assert got[2]["sector_new_title"] == "Second" and got[1]["sector_new_title"] == "7" and got[3]["sector_new_title"] == "1"
    assert got[1]["STABBR"] == "AL" and got[1]["metadata_vintage"] == 2020 and got[3]["NEWVAR"] == "z"


def test_last_entry_wins_and_unmapped_codes_are_null(spark, tmp_path):
    put(tmp_path, 2010, "a.csv", ["UNITID,INSTNM,SECTOR", "1,A,1", "2,B,8"])
    entries = spark.createDataFrame([e[:3] + e[4:] for e in ENTRIES], "varname string, codevalue string, valuelabel string, pos int")
    got = {r.unitid: r.SECTOR for r in read_institutions(spark, str(tmp_path), entries).collect()}
    assert got == {1: "Alpha last", 2: None}


def test_one_file_per_vintage(spark, root):
    dictionary = spark.createDataFrame(ENTRIES, DICTIONARY)
    put(root, 2020, "second.csv", ["UNITID,INSTNM", "1,A"])
    with pytest.raises(FileNotFoundError, match="2020"):
        read_institutions(spark, str(root), dictionary)


def test_stem_list(spark, tmp_path):
    (tmp_path / "stem.csv").write_text("Two-digit series,Code, Title \n01, 01.0308 ,Agroecology\n11,11.0101,Computing\n11,11.0101,Computing\n")
    assert sorted(map(tuple, read_stem_list(spark, str(tmp_path / "stem.csv")).collect())) == [
        ("01", "01.0308", "Agroecology"), ("11", "11.0101", "Computing")]
    (tmp_path / "bad.csv").write_text("a,b\n1,2\n")
    with pytest.raises(ValueError, match="three columns"):
        read_stem_list(spark, str(tmp_path / "bad.csv"))
