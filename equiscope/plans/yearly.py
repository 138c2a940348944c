"""The yearly completions reader as one DataFrame plan over all years.

Raw files carry one text column per (race, gender) code; the reader
normalises codes, maps award levels, drops the all-fields total lines, walks
codes through the crosswalk chain, reshapes to tidy rows (dropping "0"
cells, keeping NULL ones), classifies fields and flags STEM codes.  Year is a
column; the plan has one branch per file layout, not per year.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from equiscope.functions.strings import clean_name
from equiscope.operators import crosswalk as X
from equiscope.operators import reshape as S

IDS = ["unitid", "cipcode", "awlevel", "majornum", "year"]


def clean_headers(df: DataFrame) -> DataFrame:
    """Raw headers -> snake names (schema-level rename, no data pass)."""
    return df.withColumnsRenamed({c: clean_name(c) for c in df.columns if clean_name(c) != c})


def completions_from_wide(
    wide: DataFrame,
    hops: Sequence[X.Hop],
    lookup: DataFrame,
    stem_codes: DataFrame,
    code_set: dict | None = None,
    extra_ids: Sequence[str] = (),
) -> DataFrame:
    """Wide yearly rows (unitid, cipcode, awlevel, [majornum], year, code
    columns...) -> tidy classified award rows."""
    extra = [c for c in ("year", *extra_ids) if c in wide.columns]
    known = S.project_known_columns(S.default_majornum(wide), extra)
    measures = [c for c in known.columns if c not in [*S.INDEX_COLS, *extra]]
    code_set = code_set or S.choose_code_set(measures)
    df = known
    df = df.withColumns(
        {
            "unitid": F.col("unitid").cast("long"),
            "awlevel": S.map_award_level(F.col("awlevel")),
            "cipcode": S.normalise_code(F.col("cipcode"), F.col("year")),
        }
    )
    df = S.filter_total_codes(df)
    df = X.crosswalk_chain(df, hops, "cipcode", "year", "cip2020", None)
    # fields and flags follow from the codes: looked up per wide row, not per cell
    cells = [c for c in df.columns if c in measures]
    df = X.classify_stem(X.classify_taxonomy(df, lookup, "cipcode", "cip2020"), stem_codes, "cip2020")
    ids = IDS + list(extra_ids) + ["cip2020"]
    fields = [c for c in df.columns if c not in [*ids, *cells]]
    tidy = S.filter_zero(S.unpivot_groups(df.select(*ids, *fields, *cells), [*ids, *fields], code_set))
    tidy = tidy.withColumn("n_awards", F.expr("cast(trim(n_awards) as bigint)"))
    return tidy.select(*ids, "race_ethnicity", "gender", "n_awards", *fields)


def read_completions(
    spark, root: str, hops: Sequence[X.Hop], lookup: DataFrame, stem_codes: DataFrame, code_set: dict | None = None
) -> DataFrame:
    """Batch reader for ``root/<year>/*.csv``: revised files (``*rv.csv``)
    replace the originals of their year.  Files may differ in their columns
    and in the columns' order: each layout is read under its own header with
    its own code set (``code_set`` overrides the choice)."""
    from equiscope.sources.files import yearly_layouts

    return all_layouts(yearly_layouts(spark, f"{root.rstrip('/')}/*/*.csv"), hops, lookup, stem_codes, code_set)


def all_layouts(frames, hops, lookup, stem_codes, code_set=None, extra_ids=()) -> DataFrame:
    if not frames:
        raise FileNotFoundError("no yearly files")
    out = None
    for raw in frames:
        tidy = completions_from_wide(clean_headers(raw), hops, lookup, stem_codes, code_set, extra_ids)
        out = tidy if out is None else out.unionByName(tidy)
    return out


#: Column names that do not follow the published titles.
NAME_OVERRIDES = {"INSTNM": "institution_name", "UNITID": "unitid"}
REGION = "OBEREG"


def read_institutions(
    spark,
    root: str,
    dictionary: DataFrame,
    varnames: DataFrame | None = None,
    keep_raw: Sequence[str] = ("STABBR",),
    overrides: dict[str, str] | None = None,
) -> DataFrame:
    """Institution attributes from ``root/<vintage>/*.csv`` (Latin-1, exactly
    one file per vintage) merged to one row per institution.

    * Vintages are read under their own headers and united by name.
    * ``dictionary`` (varname, codevalue, valuelabel[, metadata_vintage][,
      pos]): with ``metadata_vintage`` every vintage uses its own entries, and
      variables that it has none for stay raw; the last entry of a code wins;
      labels of the region variable are normalised.
    * ``varnames`` (original_colname, mapped_colname, metadata_vintage): each
      column gets its latest title that is not NULL, as a snake name;
      ``overrides`` (NAME_OVERRIDES by default) come first.
    * Name flags are added, and every attribute keeps its most recent value
      that is not NULL."""
    from equiscope.operators import institutions as I
    from equiscope.sources.files import vintage_frames

    df = None
    for frame in vintage_frames(spark, f"{root.rstrip('/')}/*/*.csv"):
        frame = I.clean_raw_strings(frame)
        df = frame if df is None else df.unionByName(frame, allowMissingColumns=True)
    vintage = "metadata_vintage" if "metadata_vintage" in dictionary.columns else None
    label = F.col("valuelabel")
    entries = dictionary.withColumn(
        "valuelabel", F.when(F.col("varname") == REGION, I.normalise_region(label)).otherwise(label)
    )
    # the set of coded variables is schema-sized (one row per variable)
    coded = {r[0] for r in dictionary.select("varname").distinct().collect()}
    df = I.join_code_labels(
        df, entries, [c for c in df.columns if c in coded], keep_raw, vintage=vintage,
        pos="pos" if "pos" in dictionary.columns else None,
    )
    names = {}
    if varnames is not None:
        names = {r[0]: clean_name(r[1]) for r in I.latest_column_names(varnames).collect() if r[1]}
    names |= NAME_OVERRIDES if overrides is None else overrides
    df = df.withColumnsRenamed({k: v for k, v in names.items() if k in df.columns})
    df = df.withColumn("unitid", F.col("unitid").cast("long"))
    name = "institution_name"
    if name in df.columns:
        df = df.withColumns({"tech_school": I.tech_school(F.col(name)), "health_school": I.health_school(F.col(name))})
    return I.latest_non_null(df, "unitid", "metadata_vintage")
