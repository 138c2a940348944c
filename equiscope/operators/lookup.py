"""Lookup-table helpers: last-row-wins maps and checked broadcasts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Lookup tables (code maps, dictionaries, taxonomies) are vocabularies; this
#: is the most rows that are ever sent to all executors.
MAX_LOOKUP_ROWS = 500_000


def lookup_side(df: DataFrame, broadcast: bool = True, max_rows: int = MAX_LOOKUP_ROWS) -> DataFrame:
    """``df`` as the small side of a join.

    Broadcast with a check inside the plan: the limit stops at one row too
    many, and then the query fails and names the way out -- ``broadcast=False``,
    which leaves the join to the planner.  Nothing runs while the plan is
    built."""
    if not broadcast:
        return df
    n = F.count(F.lit(1)).over(Window.partitionBy(F.lit(0)))
    too_many = F.raise_error(F.lit(f"lookup table of more than {max_rows} rows: pass broadcast=False"))
    checked = df.limit(max_rows + 1).withColumn("__rows", n).filter(
        F.when(F.col("__rows") <= max_rows, F.lit(True)).otherwise(too_many.cast("boolean"))
    )
    return F.broadcast(checked.drop("__rows"))


def last_wins(
    df: DataFrame, key: str, values: Sequence[str], order: Column | str, out_key: str | None = None
) -> DataFrame:
    """One row per ``key`` carrying the ``values`` of its highest ``order``
    row ("later rows overwrite earlier ones", as when building a dict)."""
    o = F.col(order) if isinstance(order, str) else order
    return df.groupBy(F.col(key).alias(out_key or key)).agg(
        *[F.max_by(F.col(v), o).alias(v) for v in values]
    )
