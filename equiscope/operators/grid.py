"""The four subtotals and the dense field x group grid.

For a set of key columns the representation queries need, per output row

    fg  = awards in (unit?, field?, group, year?)      (taxonomy-filtered)
    ft  = awards in (unit?, field?, year?)             (taxonomy-filtered)
    gt  = awards in (unit?, group, year?)              (all fields)
    t   = awards in (unit?, year?)                     (all fields)

and one row for every field seen within a (unit?, year?) paired with every
group seen within the same (unit?, year?) -- zero-filled where the fact has
no row ("valid combinations").

Physical plan (exactly two shuffles, one of them over fact-sized data):

1. ``base``: the filtered fact aggregated to (unit?, field?, group, year?)
   with map-side partial aggregation, so a hot key ships one partial row per
   map task instead of its raw rows.
2. ``base`` is hash-partitioned once by the *total key* (unit and/or year).
   Rows per total key are bounded by the vocabularies (fields x groups),
   never by the fact size, so even a unit holding a third of all awards
   yields a bounded partition slice.
3. Over the co-located rows: group totals, the total and the list of groups
   seen per total key are window aggregates (partition keys are supersets of
   the partitioning: no exchange, one local sort); field totals are a hash
   aggregate on top, carrying the per-group counts as a small map.  No join.
4. Optional entity names are joined to the field-total rows, before the
   explode.
5. The grid is produced by exploding the (vocabulary-bounded) list of groups
   onto each field row; the field x group count is a map lookup, zero-filled.

``deal`` names a column for a number by unit (one of ``DEALS``), which then stands
for the unit in the partitioning of step 2: many units share a number, so what
groups the grid by (year?, number, ...) needs no further shuffle.

With no total key at all (national, all years) the windows span the
aggregated rows, of which there are at most fields x groups.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from equiscope.vocab import Grouping

UNIT = "unitid"
YEAR = "year"
#: Numbers that units are dealt by; with the years, several times the tasks.
DEALS, DEALS_BY_YEAR = 2048, 256


def subtotal_grid(
    filtered: DataFrame,
    *,
    grouping: Grouping,
    agg_type: str,
    per_unit: bool,
    field: str | None,
    by_year: bool,
    taxonomy_filter: Column | None = None,
    taxonomy_on_field: bool = False,
    measure: str = "n_awards",
    names: DataFrame | None = None,
    name_col: str = "institution_name",
    deal: str | None = None,
) -> DataFrame:
    """Dense zero-filled grid with the four subtotal columns.

    Output columns: [unitid], [field], *group columns, [year],
    ``{agg_type}_degrees_{suffix}``, ``{agg_type}_degrees_total``,
    ``uni_degrees_{suffix}``, ``uni_degrees_total`` (all bigint), [deal].
    """
    grouping = Grouping(grouping)
    gcols = grouping.grouping_columns
    suffix = grouping.label_suffix
    fg_name = f"{agg_type}_degrees_{suffix}"
    ft_name = f"{agg_type}_degrees_total"
    gt_name = f"uni_degrees_{suffix}"
    t_name = "uni_degrees_total"

    unit_k = [UNIT] if per_unit else []
    year_k = [YEAR] if by_year else []
    field_k = [field] if field else []
    deal_k = [deal] if deal else []
    total_keys = unit_k + year_k + deal_k
    field_keys = unit_k + field_k + year_k + deal_k
    n = F.col(measure)

    # 1. finest grain needed, taxonomy test folded into conditional sums
    keys = unit_k + field_k + gcols + year_k
    if taxonomy_filter is None:
        base = filtered.groupBy(*keys).agg(F.sum(n).alias("_g"))
        derived = {"_fg": F.col("_g"), "_seen": F.lit(True)}
    elif taxonomy_on_field:
        # the filtered column is a key: the test is constant per group
        base = filtered.groupBy(*keys).agg(F.sum(n).alias("_g"))
        derived = {"_fg": F.col("_g"), "_seen": F.coalesce(taxonomy_filter, F.lit(False))}
    else:
        derived = {}
        ok = F.coalesce(taxonomy_filter, F.lit(False))
        base = filtered.groupBy(*keys).agg(
            F.sum(F.when(ok, n)).alias("_fg"),
            F.bool_or(ok).alias("_seen"),
            F.sum(n).alias("_g"),
        )

    # 2. co-locate everything that shares a total key; what follows from other
    # columns is not shuffled
    if deal:
        number = F.pmod(F.hash(UNIT), F.lit(DEALS_BY_YEAR if by_year else DEALS))
        base = base.repartition(*year_k, number)
        derived[deal] = number
    elif total_keys:
        base = base.repartition(*total_keys)
    base = base.withColumns(derived)

    fg_entry = F.struct(F.struct(*gcols).alias("k"), F.col("_fg").alias("v"))
    # 3. one branch over the co-located rows: group totals and the list of
    # groups per total key are window aggregates (partition keys are supersets
    # of the partitioning: no exchange, one local sort), field totals a hash
    # aggregate -- no join, no second pass over the fact.  Without a total key
    # the window spans the aggregated rows, which number at most
    # fields x groups.
    by_group = Window.partitionBy(*total_keys, *gcols)
    by_total = Window.partitionBy(*total_keys)
    w = base.withColumn(gt_name, F.coalesce(F.sum("_g").over(by_group), F.lit(0)).cast("long"))
    w = w.withColumns(
        {
            "_groups": F.collect_set(F.struct(*gcols, gt_name)).over(by_total),
            t_name: F.coalesce(F.sum("_g").over(by_total), F.lit(0)).cast("long"),
        }
    )
    seen = F.col("_seen")
    grid = w.groupBy(*field_keys).agg(
        F.coalesce(F.sum(F.when(seen, F.col("_fg"))), F.lit(0)).cast("long").alias(ft_name),
        F.map_from_entries(F.collect_list(F.when(seen, fg_entry))).alias("_fgmap"),
        F.any_value("_groups").alias("_groups"),
        F.any_value(t_name).alias(t_name),
        F.bool_or(seen).alias("_any"),
    )
    if field_keys:
        # field rows exist only where some award passed the taxonomy filter;
        # the ungrouped field total (no keys) is always one row
        grid = grid.filter(F.col("_any"))
    name_out = []
    if per_unit and names is not None:
        grid = grid.join(names.select(UNIT, name_col), UNIT, "left")
        name_out = [F.col(name_col)]

    # 4. explode groups onto field rows; zero-fill from the map
    grid = grid.select(
        *name_out, *field_keys, ft_name, "_fgmap", t_name, F.explode("_groups").alias("_grp")
    )
    key_struct = F.struct(*[F.col("_grp")[c].alias(c) for c in gcols])
    return grid.select(
        *name_out,
        *unit_k,
        *field_k,
        *[F.col("_grp")[c].alias(c) for c in gcols],
        *year_k,
        F.coalesce(F.col("_fgmap")[key_struct], F.lit(0)).cast("long").alias(fg_name),
        F.col(ft_name),
        F.col("_grp")[gt_name].alias(gt_name),
        F.col(t_name),
        *deal_k,
    )
