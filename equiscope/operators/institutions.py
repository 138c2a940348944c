"""Institution attributes merged across yearly vintages.

All per-institution reductions are aggregations with map-side partial
aggregation (``max_by``), so an institution with a huge share of rows never
has its rows gathered in one task; no per-key sort or window is needed.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from equiscope.operators.lookup import lookup_side
from equiscope.session import ensure_checkpoint_dir

TECH_PATTERN = "(?i)Polytech|techn|school of mines|Technology|Engineering"
HEALTH_PATTERN = "(?i)Health Science|Medical Science"
OUTLYING_FROM = "Other US jurisdictions AS FM GU MH MP PR PW VI"
OUTLYING_TO = "Outlying areas AS FM GU MH MP PR PW VI"


def _order(vintage: str, tie: str | None) -> Column:
    return F.struct(F.col(vintage), F.col(tie)) if tie else F.col(vintage)


def latest_non_null(
    df: DataFrame, key: str = "unitid", vintage: str = "metadata_vintage", tie: str | None = None,
    columns: Sequence[str] | None = None,
) -> DataFrame:
    """One row per ``key``: each column's most recent non-NULL value and the
    newest ``vintage`` seen.  ``tie`` orders rows sharing a vintage."""
    cols = [c for c in (columns or df.columns) if c not in (key, vintage, tie)]
    order = _order(vintage, tie)
    aggs = [F.max_by(F.col(c), F.when(F.col(c).isNotNull(), order)).alias(c) for c in cols]
    return df.groupBy(key).agg(*aggs, F.max(vintage).alias(vintage))


def keep_latest(df: DataFrame, key: str, vintage: str, tie: str | None = None) -> DataFrame:
    """The most recent row per ``key`` (whole row)."""
    others = [c for c in df.columns if c != key]
    latest = df.groupBy(key).agg(F.max_by(F.struct(*others), _order(vintage, tie)).alias("__r"))
    return latest.select(key, *[F.col("__r")[c].alias(c) for c in others])


def forward_fill(
    df: DataFrame, key: str, vintage: str, columns: Sequence[str], tie: str | None = None,
    strategy: str = "distributed",
) -> DataFrame:
    """Carry each column's last non-NULL value forward within ``key`` in
    (vintage, tie) order.

    ``"distributed"`` (default) never puts one key in one task: rows are
    range-partitioned on (key, order) -- which cuts a hot key into several
    partitions -- and checkpointed; each (key, partition) slice is filled
    locally, and the value entering a slice is the last non-NULL value of the
    key's earlier slices (a window over at most #partitions rows per key).
    ``"window"`` is the plain per-key window."""
    columns = list(columns)
    order = [vintage] + ([tie] if tie else [])
    if strategy == "window":
        w = Window.partitionBy(key).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
        return df.withColumns({c: F.last(F.col(c), ignorenulls=True).over(w) for c in columns})
    if strategy != "distributed":
        raise ValueError(f"unknown forward fill strategy {strategy!r}")

    ensure_checkpoint_dir(df.sparkSession)
    s = (
        df.repartitionByRange(key, *order)
        .sortWithinPartitions(key, *order)
        .withColumn("__pid", F.spark_partition_id())
        .checkpoint(eager=True)
    )
    slice_w = (
        Window.partitionBy(key, "__pid").orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    filled = s.withColumns({c: F.last(F.col(c), ignorenulls=True).over(slice_w) for c in columns})
    o = F.struct(*[F.col(x) for x in order])
    ends = s.groupBy(key, "__pid").agg(
        *[F.max_by(F.col(c), F.when(F.col(c).isNotNull(), o)).alias(f"__last_{c}") for c in columns]
    )
    earlier = Window.partitionBy(key).orderBy("__pid").rowsBetween(Window.unboundedPreceding, -1)
    carry = ends.select(
        key, "__pid", *[F.last(F.col(f"__last_{c}"), ignorenulls=True).over(earlier).alias(f"__in_{c}") for c in columns]
    )
    out = filled.join(carry, [key, "__pid"], "left")
    out = out.withColumns({c: F.coalesce(F.col(c), F.col(f"__in_{c}")) for c in columns})
    return out.select(*df.columns)


def latest_column_names(
    names: DataFrame, original: str = "original_colname", mapped: str = "mapped_colname",
    vintage: str = "metadata_vintage",
) -> DataFrame:
    """Per original variable name, its latest label that is not NULL."""
    order = F.when(F.col(mapped).isNotNull(), F.col(vintage))
    return names.groupBy(original).agg(F.max_by(F.col(mapped), order).alias(mapped))


def join_code_labels(
    df: DataFrame, dictionary: DataFrame, columns: Sequence[str], keep_raw: Sequence[str] = ("STABBR",),
    varname: str = "varname", code: str = "codevalue", label: str = "valuelabel", vintage: str | None = None,
    pos: str | None = None, broadcast: bool = True,
) -> DataFrame:
    """Replace coded values by their labels for each column in ``columns``
    (except ``keep_raw``); unmapped values become NULL.

    With ``vintage`` (a column of both tables) every row uses the dictionary
    of its own vintage, and a variable that has no entries there stays as it
    is.  Of several entries for a code the last one, by
    ``pos``, wins (without ``pos``: the last in the dictionary's row order).

    One join: the dictionary is folded to one map (variable, code) -> label
    per vintage, so the number of coded columns costs nothing."""
    coded = [c for c in columns if c not in keep_raw]
    if not coded:
        return df
    order = F.col(pos) if pos else F.monotonically_increasing_id()
    keys = [F.col(vintage).alias("__vintage")] if vintage else []
    entries = dictionary.filter(F.col(varname).isin(coded)).select(
        *keys, F.struct(F.col(varname).alias("v"), F.col(code).cast("string").alias("c")).alias("__key"),
        F.col(label).alias("__label"), order.alias("__pos"),
    )
    one = entries.groupBy(*[k for k in ["__vintage"] if vintage], "__key").agg(
        F.max_by("__label", "__pos").alias("__label")
    )
    folded = one.groupBy(*(["__vintage"] if vintage else [])).agg(
        F.map_from_entries(F.collect_list(F.struct("__key", "__label"))).alias("__map"),
        F.collect_set("__key.v").alias("__vars"),
    )
    side = lookup_side(folded, broadcast)
    out = df.join(side, df[vintage] == F.col("__vintage"), "left") if vintage else df.join(side, how="left")
    named = {}
    for c in coded:
        raw = F.col(f"`{c}`").cast("string")
        found = F.col("__map")[F.struct(F.lit(c).alias("v"), raw.alias("c"))]
        keeps = ~F.coalesce(F.array_contains("__vars", c), F.lit(False)) if vintage else F.lit(False)
        named[c] = F.when(keeps, raw).otherwise(found)
    return out.withColumns(named).drop("__map", "__vars", "__vintage")


def unmapped_codes(df: DataFrame, dictionary: DataFrame, col: str, varname: str = "varname", code: str = "codevalue") -> DataFrame:
    """Distinct values of ``col`` with no dictionary entry (for warnings)."""
    d = dictionary.filter(F.col(varname) == col).select(F.col(code).alias("__c"))
    vals = df.select(F.col(col).cast("string").alias(col)).distinct()
    return vals.join(d, vals[col] == F.col("__c"), "left_anti")


def tech_school(name: Column) -> Column:
    return name.rlike(TECH_PATTERN)


def health_school(name: Column) -> Column:
    return name.rlike(HEALTH_PATTERN)


def normalise_region(label: Column) -> Column:
    """Drop , ( ) . ; collapse whitespace; unify the outlying-areas label."""
    s = F.regexp_replace(F.translate(label, ",().", ""), r"\s+", " ")
    s = F.regexp_replace(s, r"^ | $", "")
    return F.when(s == OUTLYING_FROM, F.lit(OUTLYING_TO)).otherwise(s)


def clean_raw_strings(df: DataFrame) -> DataFrame:
    """Strip a byte-order mark and spaces from headers and trim every value."""
    out = []
    for f in df.schema.fields:
        name = f.name.replace("﻿", "").replace("ï»¿", "").strip()
        c = F.col(f"`{f.name}`")
        out.append((F.trim(c) if f.dataType.simpleString() == "string" else c).alias(name))
    return df.select(*out)
