"""Public query API: four representation queries over an award fact.

Every method returns a lazy DataFrame; nothing runs before the result is
asked for, except the optional roll-up value check (bounded by the caller's
list).  Results are
not sorted unless ``sort=True`` (a global sort is a full shuffle; the keys
are the leading columns either way).
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from equiscope.functions.rates import Rate, with_rel_rate
from equiscope.operators.effect import with_effect_size
from equiscope.operators.filters import (
    QueryFilters,
    TaxonomyRollup,
    apply_filters,
    warn_missing_rollup_values,
)
from equiscope.operators.grid import subtotal_grid
from equiscope.vocab import FieldTaxonomy, Grouping

COMPLETIONS_TABLE = "completions"
INSTITUTIONS_TABLE = "institutions"
CIP_TABLE = "cip_info"

CIP_COLUMNS = [
    "cip2020",
    "cip_title",
    "ncses_sci_group",
    "ncses_field_group",
    "ncses_detailed_field_group",
    "nsf_broad_field",
    "dhs_stem",
]


def order_by_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """ORDER BY keys ascending, NULLs last (the original engine's default)."""
    return df.orderBy(*[F.col(k).asc_nulls_last() for k in keys])


def cip_table(fact: DataFrame) -> DataFrame:
    """Distinct code dimension (one row per distinct attribute combination)."""
    return fact.select(*CIP_COLUMNS).distinct()


class QueryEngine:
    """Catalog access and raw SQL over registered tables."""

    def __init__(self, spark: SparkSession, tables: dict[str, DataFrame]):
        self.spark = spark
        self.tables = dict(tables)

    def get_df_from_query(
        self, query: str, query_params: dict[str, Any] | None = None, show_query: bool = False
    ) -> DataFrame:
        """Run Spark SQL with optional named parameters (``:name``); list
        parameters become array literals, e.g. ``array_contains(:xs, col)``.

        Table names mean this engine's tables: they are views only while the
        statement is analysed, and views of the same names that the session
        had before are put back."""
        if show_query:
            print("SQL:", query, "with", query_params or "no parameters")
        args = None
        if query_params:
            args = {
                k: (F.array(*[F.lit(x) for x in v]) if isinstance(v, (list, tuple)) else v)
                for k, v in query_params.items()
            }
        catalog = self.spark.catalog
        before = {n: self.spark.table(n) for n in self.tables if catalog.tableExists(n)}
        try:
            for name, df in self.tables.items():
                df.createOrReplaceTempView(name)
            return self.spark.sql(query, args=args)
        finally:
            for name in self.tables:
                catalog.dropTempView(name)
            for name, df in before.items():
                df.createOrReplaceTempView(name)

    def list_tables(self) -> list[str]:
        return sorted(self.tables)

    def get_cip_table(self) -> DataFrame:
        return order_by_keys(self.tables[CIP_TABLE], ["cip2020"])

    def get_institutions_table(self, cols: str | Sequence[str] | None = None) -> DataFrame:
        inst = self.tables[INSTITUTIONS_TABLE]
        if cols is None:
            return inst
        cols = [cols] if isinstance(cols, str) else list(cols)
        bad = [c for c in cols if c not in inst.columns]
        if bad:
            raise ValueError(f"the institutions table has no column {", ".join(map(str, bad))}")
        return inst.select("unitid", *[c for c in cols if c != "unitid"])


class CompletionsEngine(QueryEngine):
    """The four representation queries over a completions fact.

    ``CompletionsEngine.from_database(spark, root)`` opens the tables written
    by :func:`equiscope.sources.files.write_database`."""

    @classmethod
    def from_database(cls, spark: SparkSession, root: str, **kw) -> "CompletionsEngine":
        from equiscope.sources.files import read_database

        t = read_database(spark, root)
        return cls(spark, t["completions"], t["institutions"], cip_info=t["cip_info"], **kw)

    def __init__(
        self,
        spark: SparkSession,
        fact: DataFrame,
        institutions: DataFrame | None = None,
        check_values: bool = True,
        cip_info: DataFrame | None = None,
    ):
        tables = {COMPLETIONS_TABLE: fact, CIP_TABLE: cip_info if cip_info is not None else cip_table(fact)}
        if institutions is not None:
            tables[INSTITUTIONS_TABLE] = institutions
        super().__init__(spark, tables)
        self.fact = fact
        self.institutions = institutions
        self.check_values = check_values

    # -- helpers -----------------------------------------------------------
    def _run(
        self,
        *,
        grouping,
        agg_type: str,
        per_unit: bool,
        field: str | None,
        by_year: bool,
        query_filters: QueryFilters,
        taxonomy_filter,
        taxonomy_on_field: bool,
        filter_unitids,
        deal: str | None = None,
    ) -> DataFrame:
        filtered = apply_filters(self.fact, query_filters, filter_unitids)
        names = None
        if per_unit and self.institutions is not None:
            names = self.institutions.select("unitid", "institution_name")
        out = subtotal_grid(
            filtered,
            grouping=grouping,
            agg_type=agg_type,
            per_unit=per_unit,
            field=field,
            by_year=by_year,
            taxonomy_filter=taxonomy_filter,
            taxonomy_on_field=taxonomy_on_field,
            names=names,
            deal=deal,
        )
        if per_unit and names is None:
            out = out.select(F.lit(None).cast("string").alias("institution_name"), *out.columns)
        return out

    @staticmethod
    def _finish(df: DataFrame, keys: list[str], sort: bool, show_query: bool) -> DataFrame:
        if sort:
            df = order_by_keys(df, keys)
        if show_query:
            df.explain("formatted")
        return df

    # -- the four queries --------------------------------------------------
    def rollup_by_grouping(
        self,
        grouping: Grouping | str,
        rollup: TaxonomyRollup,
        query_filters: QueryFilters,
        by_year: bool = False,
        rel_rate: bool = False,
        show_query: bool = False,
        filter_unitids: Sequence[int] | None = None,
        sort: bool = False,
    ) -> DataFrame:
        """National totals for the fields in ``rollup``, by group."""
        grouping = Grouping(grouping)
        if self.check_values:
            warn_missing_rollup_values(self.fact, rollup)
        df = self._run(
            grouping=grouping, agg_type="rollup", per_unit=False, field=None, by_year=by_year,
            query_filters=query_filters, taxonomy_filter=rollup.predicate(),
            taxonomy_on_field=False, filter_unitids=filter_unitids,
        )
        if rel_rate:
            df = with_rel_rate(df, *self._rates("rollup", grouping))
        keys = [*grouping.grouping_columns, *(["year"] if by_year else [])]
        return self._finish(df, keys, sort, show_query)

    def field_totals_by_grouping(
        self,
        grouping: Grouping | str,
        taxonomy: FieldTaxonomy | str,
        query_filters: QueryFilters,
        taxonomy_values: Sequence[Any] | None = None,
        by_year: bool = False,
        rel_rate: bool = False,
        show_query: bool = False,
        filter_unitids: Sequence[int] | None = None,
        sort: bool = False,
    ) -> DataFrame:
        """National totals for every field of ``taxonomy``, by group."""
        grouping, tax = Grouping(grouping), FieldTaxonomy(taxonomy).value
        values = list(taxonomy_values) if taxonomy_values else None
        df = self._run(
            grouping=grouping, agg_type="field", per_unit=False, field=tax, by_year=by_year,
            query_filters=query_filters,
            taxonomy_filter=F.col(tax).isin(values) if values else None,
            taxonomy_on_field=True, filter_unitids=filter_unitids,
        )
        if rel_rate:
            df = with_rel_rate(df, *self._rates("field", grouping))
        keys = [tax, *grouping.grouping_columns, *(["year"] if by_year else [])]
        return self._finish(df, keys, sort, show_query)

    def uni_rollup_by_grouping(
        self,
        grouping: Grouping | str,
        rollup: TaxonomyRollup,
        query_filters: QueryFilters,
        by_year: bool = False,
        rel_rate: bool = False,
        effect_size: bool = False,
        show_query: bool = False,
        filter_unitids: Sequence[int] | None = None,
        sort: bool = False,
    ) -> DataFrame:
        """Per-institution totals for the fields in ``rollup``, by group."""
        grouping = Grouping(grouping)
        if self.check_values:
            warn_missing_rollup_values(self.fact, rollup)
        df = self._run(
            grouping=grouping, agg_type="rollup", per_unit=True, field=None, by_year=by_year,
            query_filters=query_filters, taxonomy_filter=rollup.predicate(),
            taxonomy_on_field=False, filter_unitids=filter_unitids,
        )
        keys = ["unitid", *grouping.grouping_columns, *(["year"] if by_year else [])]
        df = self._effects(df, "rollup", grouping, keys, rel_rate, effect_size)
        return self._finish(df, ["institution_name", *keys], sort, show_query)

    def uni_field_totals_by_grouping(
        self,
        grouping: Grouping | str,
        taxonomy: FieldTaxonomy | str,
        query_filters: QueryFilters,
        taxonomy_values: Sequence[Any] | None = None,
        by_year: bool = False,
        rel_rate: bool = False,
        effect_size: bool = False,
        show_query: bool = False,
        filter_unitids: Sequence[int] | None = None,
        sort: bool = False,
    ) -> DataFrame:
        """Per-institution totals for every field of ``taxonomy``, by group."""
        grouping, tax = Grouping(grouping), FieldTaxonomy(taxonomy).value
        values = list(taxonomy_values) if taxonomy_values else None
        df = self._run(
            grouping=grouping, agg_type="field", per_unit=True, field=tax, by_year=by_year,
            query_filters=query_filters,
            taxonomy_filter=F.col(tax).isin(values) if values else None,
            taxonomy_on_field=True, filter_unitids=filter_unitids, deal="_deal" if effect_size else None,
        )
        keys = ["unitid", tax, *grouping.grouping_columns, *(["year"] if by_year else [])]
        df = self._effects(df, "field", grouping, keys, rel_rate, effect_size, dealt="_deal")
        return self._finish(df, ["institution_name", *keys], sort, show_query)

    # -- rates -------------------------------------------------------------
    @staticmethod
    def _rates(agg_type: str, grouping: Grouping) -> tuple[Rate, Rate]:
        s = grouping.label_suffix
        sub = Rate(f"{agg_type}_pct", f"{agg_type}_degrees_{s}", f"{agg_type}_degrees_total")
        base = Rate("uni_pct", f"uni_degrees_{s}", "uni_degrees_total")
        return sub, base

    def _effects(self, df, agg_type, grouping, keys, rel_rate, effect_size, dealt=None):
        if not (rel_rate or effect_size):
            return df
        sub, base = self._rates(agg_type, grouping)
        df = with_rel_rate(df, sub, base)
        if effect_size:
            df = with_effect_size(df, sub, base, keys[1:], dealt=dealt)
        return df
