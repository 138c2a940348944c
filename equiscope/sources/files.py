"""File sources and sinks.

Yearly raw files are read in one scan per layout (the year / vintage is a
column taken from the path).
"""

from __future__ import annotations

import functools
import re
import uuid
from codecs import BOM_UTF8
from concurrent.futures import ThreadPoolExecutor
from urllib.parse import unquote

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (
    BooleanType,
    DataType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
)

from equiscope.session import ensure_checkpoint_dir

FACT_SCHEMA = StructType(
    [
        StructField("year", IntegerType(), metadata={"comment": "survey year"}),
        StructField("unitid", LongType(), metadata={"comment": "institution id"}),
        StructField("cipcode", StringType(), metadata={"comment": "code as originally reported"}),
        StructField("awlevel", StringType(), metadata={"comment": "level of award"}),
        StructField("majornum", IntegerType(), metadata={"comment": "major number"}),
        StructField("cip2020", StringType(), metadata={"comment": "crosswalked code"}),
        StructField("race_ethnicity", StringType(), metadata={"comment": "race / ethnicity"}),
        StructField("gender", StringType(), metadata={"comment": "gender"}),
        StructField("n_awards", LongType(), metadata={"comment": "number of completions"}),
        StructField("cip_title", StringType()),
        StructField("ncses_sci_group", StringType()),
        StructField("ncses_field_group", StringType()),
        StructField("ncses_detailed_field_group", StringType()),
        StructField("nsf_broad_field", StringType()),
        StructField("dhs_stem", BooleanType()),
    ]
)


DATABASE_TABLES = ("completions", "cip_info", "institutions")
#: Files open at a time for their headers.
HEADERS_OPEN = 8


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared checkpoint folder."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/{name}-{uuid.uuid4().hex}"


def vintage_from_path(df: DataFrame, out: str = "year", pattern: str = r"/(\d{4})/") -> DataFrame:
    """Add an integer column parsed from each row's source file path; rows
    whose path does not match raise an error (no silent NULL year)."""
    path = F.col("_metadata.file_path")
    txt = F.regexp_extract(path, pattern, 1)
    return df.withColumn(
        out,
        F.when(txt == "", F.raise_error(F.concat(F.lit("no vintage in path "), path))).otherwise(
            txt.cast("int")
        ),
    )


def prefer_revised(original: DataFrame, revised: DataFrame, key: str = "year") -> DataFrame:
    """Per ``key`` (year): the revised rows where a revision exists, else the
    original rows.  Anti join on the distinct revised keys + union."""
    return original.join(revised.select(key).distinct(), key, "left_anti").unionByName(revised)


def file_headers(spark: SparkSession, pattern: str, encoding: str = "UTF-8") -> list[tuple[str, str]]:
    """(path, header line) of every file, in order.  Files are listed, not
    scanned, and of each only the first line is read, through the file system and
    codec that Spark would use for it but without a job for each file, so neither
    the bytes read for headers nor the jobs grow with the files; a file without
    any line is left out."""
    hadoop, conf = spark._jvm.org.apache.hadoop, spark._jsparkSession.sessionState().newHadoopConf()
    codecs = hadoop.io.compress.CompressionCodecFactory(conf)

    def header(path: str) -> tuple[str, str] | None:
        at, line = hadoop.fs.Path(unquote(path)), hadoop.io.Text()
        codec, stream = codecs.getCodec(at), at.getFileSystem(conf).open(at)
        try:
            reader = hadoop.util.LineReader(codec.createInputStream(stream) if codec else stream, conf)
            if not reader.readLine(line):
                return None
        finally:
            stream.close()
        return path, bytes(line.copyBytes()).removeprefix(BOM_UTF8).decode(encoding, "replace")

    files = sorted(spark.read.text(pattern).inputFiles())
    with ThreadPoolExecutor(HEADERS_OPEN) as pool:
        return [found for found in pool.map(header, files) if found]


def revised_paths(paths: list[str], pattern: str = r"/(?:year=)?(\d{4})/[^/]*$") -> list[str]:
    """Of each year's files the revised ones (``*rv.csv``) where there are
    any, else all.  Paths that name no year are an error."""
    by_year: dict[str, list[str]] = {}
    for p in paths:
        found = re.search(pattern, p)
        if not found:
            raise ValueError(f"no year in path {p}")
        by_year.setdefault(found[1], []).append(p)
    out = []
    for year in sorted(by_year):
        revised = [p for p in by_year[year] if p.endswith("rv.csv")]
        out += revised or by_year[year]
    return out


def yearly_layouts(spark: SparkSession, pattern: str) -> list[DataFrame]:
    """The yearly files as strings, one DataFrame per different header, with
    ``year`` and ``revision`` (1 for revised files) from the path.

    Files of one header are read in one scan under that header, so columns are
    never matched by position across layouts."""
    headers = dict(file_headers(spark, pattern))
    layouts: dict[str, list[str]] = {}
    for p in revised_paths(list(headers)):
        layouts.setdefault(headers[p].strip(), []).append(p)
    path = F.col("_metadata.file_path")
    frames = []
    for header in sorted(layouts):
        raw = spark.read.option("header", True).csv([unquote(p) for p in layouts[header]])
        frames.append(raw.withColumns({
            "year": F.regexp_extract(path, r"/(?:year=)?(\d{4})/[^/]*$", 1).cast("int"),
            "revision": F.when(path.rlike(r"rv\.csv$"), 1).otherwise(0),
        }))
    return frames


def read_prefer_revised(spark: SparkSession, root: str) -> DataFrame:
    """``root/<year>/*.csv`` as strings, revised files (``*rv.csv``) before
    originals; layouts are united by column name, absent columns are NULL."""
    frames = [f.drop("revision") for f in yearly_layouts(spark, f"{root.rstrip('/')}/*/*.csv")]
    if not frames:
        raise FileNotFoundError(f"no yearly files under {root}")
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out


#: Folder of a vintage: ``2015`` or ``name=2015``.
VINTAGE = r"/(?:\w+=)?(\d{4})/[^/]*$"


def vintage_frames(spark: SparkSession, pattern: str, encoding: str = "ISO-8859-1") -> list[DataFrame]:
    """One DataFrame per different header of ``<vintage>/<one file>.csv``, all
    strings, with ``metadata_vintage`` from the path.  A vintage with more than
    one file is an error, and so is none at all."""
    headers = file_headers(spark, pattern, encoding)
    by_vintage: dict[str, list[str]] = {}
    for p, _ in headers:
        found = re.search(VINTAGE, p)
        if not found:
            raise ValueError(f"no vintage in path {p}")
        by_vintage.setdefault(found[1], []).append(p)
    many = {v: len(ps) for v, ps in by_vintage.items() if len(ps) > 1}
    if many or not by_vintage:
        raise FileNotFoundError(f"each vintage needs one file; found {many or 'none at all'} for {pattern}")
    layouts: dict[str, list[str]] = {}
    for p, header in headers:
        layouts.setdefault(header.strip(), []).append(unquote(p))
    frames = []
    for header in sorted(layouts):
        raw = spark.read.option("header", True).option("encoding", encoding).csv(layouts[header])
        frames.append(vintage_from_path(raw, "metadata_vintage", VINTAGE))
    return frames


def read_institution_csv(spark: SparkSession, path: str) -> DataFrame:
    """Latin-1 CSV, all columns as strings."""
    return spark.read.option("header", True).option("encoding", "ISO-8859-1").csv(path)


BAD_VALUES = "bad_values"
#: Every text that a cast to the type takes fits its pattern (not the reverse).
#: try_cast throws and catches an exception for each text it does not take.
LIKELY = {
    IntegerType: r"^[^0-9A-Za-z.]*[0-9]+[^0-9A-Za-z.]*\z",
    LongType: r"^[^0-9A-Za-z.]*[0-9]+[^0-9A-Za-z.]*\z",
    BooleanType: r"(?i)^[^0-9A-Za-z]*(t|true|y|yes|1|f|false|n|no|0)[^0-9A-Za-z]*\z",
}


def tried(text: Column, kind: DataType) -> Column:
    """``text`` as a value of the type, NULL where it is none (``try_cast``,
    but words cost no exception)."""
    value = text.try_cast(kind)
    return F.when(text.rlike(LIKELY[type(kind)]), value) if type(kind) in LIKELY else value


def typed_rows(raw: DataFrame, schema: StructType) -> DataFrame:
    """``raw`` (strings, any order) under ``schema``, matched by name, with
    ``bad_values``: the names of the columns whose text is not a value of the
    type.  Missing and unknown columns are an error."""
    have, want = set(raw.columns), set(schema.names)
    if have != want:
        raise ValueError(f"columns do not fit: missing {sorted(want - have)}, unknown {sorted(have - want)}")
    out, bad, any_bad = [], [], F.lit(False)
    for f in schema.fields:
        if isinstance(f.dataType, StringType):
            out.append(F.col(f.name))
            continue
        value = tried(F.col(f.name), f.dataType)
        out.append(value.alias(f.name))
        wrong = F.col(f.name).isNotNull() & value.isNull()
        bad.append(F.when(wrong, F.lit(f.name)))
        any_bad = wrong | any_bad
    # the list is only made for rows that need one: array_compact is not compiled
    named = F.when(any_bad, F.array_compact(F.array(*bad))).otherwise(F.array().cast("array<string>"))
    return raw.select(*out, named.alias(BAD_VALUES))


def scan_fact_csv(spark: SparkSession, path: str) -> DataFrame:
    """The rows of interim fact files with ``bad_values``.  Every file is read
    under its own header (one scan per different header), so columns may stand
    in any order; a year may come from a ``year=`` folder."""
    layouts: dict[str, list[str]] = {}
    headers = file_headers(spark, path)
    if not headers:
        raise FileNotFoundError(f"no fact files under {path}")
    for p, header in headers:
        layouts.setdefault(header.strip(), []).append(unquote(p))
    base = spark.read.option("header", True)
    if not re.search(r"[*?\[{]", path):
        base = base.option("basePath", path)
    parts = [typed_rows(base.csv(layouts[header]), FACT_SCHEMA) for header in sorted(layouts)]
    return functools.reduce(DataFrame.unionByName, parts)


def read_fact_csv(spark: SparkSession, path: str) -> DataFrame:
    """Interim fact files (gzip CSV) with the fixed schema; a value that is
    not of its column's type fails the query, which names it."""
    rows = scan_fact_csv(spark, path)
    told = F.concat(F.lit("no values of their type in columns "), F.array_join(BAD_VALUES, ", "))
    # in every typed column, so that no column pruning loses the check
    checked = {f.name: F.when(F.size(BAD_VALUES) > 0, F.raise_error(told).cast(f.dataType)).otherwise(F.col(f.name))
               for f in FACT_SCHEMA.fields if not isinstance(f.dataType, StringType)}
    return rows.withColumns(checked).drop(BAD_VALUES)


def read_fact_csv_with_rejects(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """(good rows, rejected rows with ``bad_values``; their bad values are NULL)."""
    rows = scan_fact_csv(spark, path)
    return rows.filter(F.size(BAD_VALUES) == 0).drop(BAD_VALUES), rows.filter(F.size(BAD_VALUES) > 0)


def read_stem_list(spark: SparkSession, path: str) -> DataFrame:
    """(series, code, title) of a STEM list with three columns of any header:
    two-digit series, code, title; all text, trimmed, one row per code."""
    raw = spark.read.option("header", True).csv(path)
    if len(raw.columns) != 3:
        raise ValueError(f"a STEM list has three columns, not {len(raw.columns)}")
    named = raw.toDF("series", "code", "title").select(*[F.trim(c).alias(c) for c in ("series", "code", "title")])
    return named.filter("code is not null").dropDuplicates(["code"])


def load_institutions_table(spark: SparkSession, path: str) -> DataFrame:
    """Institution CSVs read as strings, then ``unitid`` typed as integer."""
    df = spark.read.option("header", True).option("inferSchema", False).csv(path)
    return df.withColumn("unitid", F.col("unitid").cast("int"))


def write_interim(df: DataFrame, path: str, partition_by: str | None = "year") -> None:
    """Gzip CSV per year (header, overwrite)."""
    w = df.write.mode("overwrite").option("header", True).option("compression", "gzip")
    (w.partitionBy(partition_by) if partition_by else w).csv(path)


def write_fact(df: DataFrame, path: str, overwrite: bool = False) -> None:
    """Persist the fact as Parquet partitioned by year (partition pruning for
    year filters).  Rows are clustered by year first so each task writes few
    files; range partitioning on (year, unitid, code) splits a year, or a unit
    within it, that holds a large share of rows over several tasks.  Refuses to
    replace existing data unless ``overwrite``."""
    (
        df.repartitionByRange("year", "unitid", "cipcode")
        .sortWithinPartitions("year", "unitid", "cipcode")
        .write.mode("overwrite" if overwrite else "errorifexists")
        .partitionBy("year")
        .parquet(path)
    )


def read_fact(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def read_lookup_csv(spark: SparkSession, path: str) -> DataFrame:
    """Lookup / dictionary tables shipped as CSV: all text, header names
    lower-cased (e.g. ``varname, codevalue, valuelabel``)."""
    df = spark.read.option("header", True).csv(path)
    return df.withColumnsRenamed({c: c.lower() for c in df.columns if c.lower() != c})


def _commits(spark: SparkSession, root: str) -> list[str]:
    """Names of the complete snapshots, oldest first (a row per write)."""
    try:
        rows = spark.read.schema("number int, snapshot string").parquet(f"{root}/commits").collect()
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return []
    return [r["snapshot"] for r in sorted(rows, key=lambda r: (r["number"], r["snapshot"]))]


def write_database(fact: DataFrame, institutions: DataFrame, root: str, overwrite: bool = False) -> dict[str, str]:
    """Persist the three tables of the data model as one snapshot under
    ``root``, all of them or nothing:

    * ``cip_info``: distinct code dimension taken from the fact;
    * ``completions``: the fact without ``cip_title`` (kept in cip_info),
      partitioned by year;
    * ``institutions``: the institution dimension.

    Every write has a folder of its own, and one row appended to ``commits``
    at the very end makes it the current one.  A write that fails earlier leaves
    the former tables as they were, and readers that have them open keep them.
    Refuses to replace existing tables unless ``overwrite``; of writers at the
    same time, the last to commit wins."""
    from equiscope.plans.engine import cip_table

    spark, root = fact.sparkSession, root.rstrip("/")
    done = _commits(spark, root)
    if done and not overwrite:
        raise FileExistsError(f"{root} holds a database")
    name = uuid.uuid4().hex
    paths = {t: f"{root}/snapshots/{name}/{t}" for t in DATABASE_TABLES}
    write_fact(fact.drop("cip_title"), paths["completions"])
    cip_table(fact).write.parquet(paths["cip_info"])
    institutions.write.parquet(paths["institutions"])
    commit = spark.createDataFrame([(len(done), name)], "number int, snapshot string")
    commit.coalesce(1).write.mode("append").parquet(f"{root}/commits")
    return paths


def read_database(spark: SparkSession, root: str) -> dict[str, DataFrame]:
    """The tables of the last complete snapshot."""
    done = _commits(spark, root.rstrip("/"))
    if not done:
        raise FileNotFoundError(f"{root} holds no complete database")
    return {t: spark.read.parquet(f"{root.rstrip('/')}/snapshots/{done[-1]}/{t}") for t in DATABASE_TABLES}
