"""What the yearly ingestion does for each file and each row of its lookups."""

import gzip
import os
import re
import tempfile

from equiscope.sources import files as FS


def test_headers_take_no_job_for_each_file(spark):
    root = tempfile.mkdtemp(prefix="eqs-heads-")
    for i in range(40):
        with open(f"{root}/c{i:02d}.csv", "w") as fh:
            fh.write(f"UNITID,C{i}\n1,2\n")
    jobs = spark.sparkContext._jsc.sc().dagScheduler().numTotalJobs
    before = jobs()
    got = FS.file_headers(spark, f"{root}/*.csv")
    assert [h for _, h in got] == [f"UNITID,C{i}" for i in range(40)]
    assert jobs() - before < 10


def test_headers_of_odd_files(spark):
    """The same first lines as a scan gives: packed files, marks, line ends, other encodings, empty files."""
    root = tempfile.mkdtemp(prefix="eqs-odd-")
    texts = {"a.csv": b"\xef\xbb\xbfUNITID,X\r\n1,2\r\n", "b.csv": b"no end", "c.csv": b"", "d e%20f.csv": b"\nsecond\n", "g.csv": "né,é\n1,2\n".encode("latin-1")}
    for name, text in texts.items():
        with open(f"{root}/{name}", "wb") as fh:
            fh.write(text)
    with gzip.open(f"{root}/h.csv.gz", "wb") as fh:
        fh.write(b"packed,header\n1,2\n")
    got = dict(FS.file_headers(spark, f"{root}/*"))
    for path in spark.read.text(f"{root}/*").inputFiles():
        row = spark.read.text(FS.unquote(path)).head()
        assert got.get(path) == (row and row["value"]), path
    assert dict(FS.file_headers(spark, f"{root}/g.csv", "ISO-8859-1")).popitem()[1] == "né,é"


def test_crosswalk_loaders_are_compiled(spark):
    from equiscope.plans.etl_registry import hops

    if not os.path.isdir("/root/testdata/sf0.001"):
        return
    mode = spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("codegen")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        for hop in hops(spark, "/root/testdata/sf0.001"):
            for table in (hop.codes, hop.titles):
                text = table.select("*")._jdf.queryExecution().explainString(mode)
                assert all(int(n) < 8000 for n in re.findall(r"maxMethodCodeSize:(\d+)", text))
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
