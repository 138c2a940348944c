"""ANSI SQL (DuckDB dialect) texts equivalent to the Spark queries.

Used only as the correctness oracle: the driver runs these on DuckDB over the
same Parquet tables and compares with the Spark results.  They follow the
textbook formulation (CTEs, CROSS JOIN / USING joins, window median) rather
than the Spark plan, so the two are independent implementations.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from fractions import Fraction

from equiscope.sources.tables import FACT_SQL, INSTITUTIONS_SQL
from equiscope.vocab import Grouping

NAN = "CAST('NaN' AS DOUBLE)"
INF = "CAST('Infinity' AS DOUBLE)"
NINF = "CAST('-Infinity' AS DOUBLE)"

RATE_COLUMNS = ["rel_rate", "log2_rel_rate", "fold_rel_rate", "bounded_rel_rate"]


def q(v) -> str:
    if isinstance(v, bool):
        return "TRUE" if v else "FALSE"
    if isinstance(v, (int, float)):
        return repr(v)
    return "'" + str(v).replace("'", "''") + "'"


def in_list(col: str, values: Sequence) -> str:
    return f"{col} IN ({', '.join(q(v) for v in values)})"


def safe_div(n: str, d: str) -> str:
    n, d = f"CAST({n} AS DOUBLE)", f"CAST({d} AS DOUBLE)"
    return f"(CASE WHEN {d} = 0 THEN {n} * {INF} ELSE {n} / {d} END)"


def log2_sql(x: str) -> str:
    return (
        f"(CASE WHEN isnan({x}) THEN {NAN} WHEN {x} = 0 THEN {NINF} WHEN {x} < 0 THEN {NAN} "
        f"ELSE log2({x}) END)"
    )


def fold_sql(x: str) -> str:
    return (
        f"(CASE WHEN isnan({x}) THEN {NAN} WHEN {x} <= 0 THEN {NINF} "
        f"WHEN {x} <= 1 THEN 1e0 - 1e0 / {x} ELSE {x} - 1e0 END)"
    )


def bounded_sql(x: str) -> str:
    return f"(CASE WHEN isnan({x}) THEN {NAN} WHEN {x} >= 1 THEN 1e0 - 1e0 / {x} ELSE {x} - 1e0 END)"


def zscore_sql(c1: str, n1: str, c2: str, n2: str) -> str:
    m1, m2 = f"(CAST({n1} AS DOUBLE) + 2e0)", f"(CAST({n2} AS DOUBLE) + 2e0)"
    p1 = safe_div(f"(CAST({c1} AS DOUBLE) + 1e0)", m1)
    p2 = safe_div(f"(CAST({c2} AS DOUBLE) + 1e0)", m2)
    var = f"({safe_div(f'{p1} * (1e0 - {p1})', m1)} + {safe_div(f'{p2} * (1e0 - {p2})', m2)})"
    return safe_div(f"({p1} - {p2})", f"sqrt({var})")


def _horner(coeffs: Sequence[float], v: str) -> str:
    out = f"{coeffs[-1]:.17e}"
    for c in reversed(coeffs[:-1]):
        out = f"({c:.17e} + {v} * {out})"
    return out


def _series() -> list[float]:
    """1 / (1 * 3 * ... * (2 n + 1))."""
    out, d = [], 1
    for n in range(41):
        d *= 2 * n + 1
        out.append(1.0 / d)
    return out


def _convergent(depth: int = 40) -> tuple[list[float], list[float]]:
    """Numerator and denominator, by power, of x + (1/2)/(x + 1/(x + (3/2)/(x + ...)))."""
    above, below = ([Fraction(1)], [Fraction(0), Fraction(1)]), ([Fraction(0)], [Fraction(1)])
    for k in range(1, depth + 1):
        step = []
        for before, now in (above, below):
            moved = [Fraction(0), *now]
            for i, c in enumerate(before):
                moved[i] += Fraction(k, 2) * c
            step.append((now, moved))
        above, below = step
    return [float(c) for c in above[1]], [float(c) for c in below[1]]


def pvalues(source: str, *zs: str) -> str:
    """CTE body: (z, p) of every different value of the z columns.

    ``p = erfc(|z| / sqrt 2)``: a power series below 2, Laplace's continued
    fraction as one quotient above; nothing of it is shared with the Spark side."""
    num, den = _convergent()
    each = " UNION ".join(f"SELECT {z} AS z FROM {source}" for z in zs)
    root = math.sqrt(math.pi)
    return (
        "SELECT z, CASE WHEN isnan(z) THEN z "
        f"WHEN x < 2e0 THEN 1e0 - {2 / root:.17e} * x * e * {_horner(_series(), 'y')} "
        f"WHEN x < 2.75e1 THEN e * {_horner(den, 'x')} / ({root:.17e} * {_horner(num, 'x')}) ELSE 0e0 END AS p "
        "FROM (SELECT z, x, 2e0 * x * x AS y, exp(-(x * x)) AS e "
        f"FROM (SELECT z, abs(z) * {0.5 ** 0.5!r} AS x FROM ({each}) WHERE z IS NOT NULL))"
    )


#: Digits of the compared p-values; the two sides compute them by different formulas.
P_DIGITS = 6


def rounded_expr(expr: str, digits: int = 9) -> str:
    return f"(round({expr}, {digits}) + 0e0)"


def rounded(col: str, digits: int = 9) -> str:
    return f"(round({col}, {digits}) + 0e0) AS {col}"


#: Read more than once, so computed once.
STORED = {"filtered", "rated0", "rated", "e1", "e4", "pv"}


def with_cte(*ctes: tuple[str, str]) -> str:
    return "WITH " + ",\n".join(f"{n} AS {'MATERIALIZED ' * (n in STORED)}({body})" for n, body in ctes)


def base_ctes() -> list[tuple[str, str]]:
    return [("fact", FACT_SQL), ("inst", INSTITUTIONS_SQL)]


def grid_sql(
    *,
    grouping: Grouping,
    agg_type: str,
    per_unit: bool,
    field: str | None,
    by_year: bool,
    start_year: int,
    end_year: int,
    race_ethns: Sequence[str] | None = None,
    award_levels: Sequence[str] | None = None,
    majornums: Sequence[int] = (1, 2),
    taxonomy_col: str | None = None,
    taxonomy_values: Sequence | None = None,
    unitids: Sequence[int] | None = None,
) -> tuple[list[tuple[str, str]], list[str]]:
    """CTEs ending in ``grid`` plus the output key column list."""
    grouping = Grouping(grouping)
    g = grouping.grouping_columns
    sfx = grouping.label_suffix
    fg, ft, gt, t = (
        f"{agg_type}_degrees_{sfx}", f"{agg_type}_degrees_total", f"uni_degrees_{sfx}",
        "uni_degrees_total",
    )
    unit = ["unitid"] if per_unit else []
    year = ["year"] if by_year else []
    fld = [field] if field else []
    total_keys = unit + year
    field_keys = unit + fld + year
    keys = unit + fld + g + year

    conds = [f"year BETWEEN {start_year} AND {end_year}"]
    if race_ethns is not None:
        conds.append(in_list("race_ethnicity", race_ethns))
    if award_levels is not None:
        conds.append(in_list("awlevel", award_levels))
    conds.append(in_list("majornum", majornums))
    if unitids:
        conds.append(in_list("unitid", unitids))
    tax = f"WHERE {in_list(taxonomy_col, taxonomy_values)}" if taxonomy_col else ""
    if taxonomy_col and not taxonomy_values:
        tax = "WHERE FALSE"

    def sub(cols, name, where=""):
        sel = ", ".join(cols) + ", " if cols else ""
        grp = f"GROUP BY {', '.join(cols)}" if cols else ""
        return f"SELECT {sel}CAST(COALESCE(SUM(n_awards), 0) AS BIGINT) AS {name} FROM filtered {where} {grp}"

    join = f"JOIN group_totals USING ({', '.join(total_keys)})" if total_keys else "CROSS JOIN group_totals"
    tjoin = f"LEFT JOIN totals USING ({', '.join(total_keys)})" if total_keys else "CROSS JOIN totals"
    combos = f"SELECT field_totals.*, {', '.join('group_totals.' + c for c in g)}, group_totals.{gt} FROM field_totals {join}"
    inst_sel = "inst.institution_name, " if per_unit else ""
    inst_join = "LEFT JOIN inst USING (unitid)" if per_unit else ""
    final = (
        f"SELECT {inst_sel}{', '.join(keys)}, CAST(COALESCE(field_group_totals.{fg}, 0) AS BIGINT) AS {fg}, "
        f"combos.{ft}, combos.{gt}, totals.{t} "
        f"FROM combos LEFT JOIN field_group_totals USING ({', '.join(keys)}) {tjoin} {inst_join}"
    )
    ctes = base_ctes() + [
        ("filtered", f"SELECT * FROM fact WHERE {' AND '.join(conds)}"),
        ("field_totals", sub(field_keys, ft, tax)),
        ("group_totals", sub(unit + g + year, gt)),
        ("combos", combos),
        ("field_group_totals", sub(keys, fg, tax)),
        ("totals", sub(total_keys, t)),
        ("grid", final),
    ]
    return ctes, (["institution_name"] if per_unit else []) + keys


def rates_cte(src: str, agg_type: str, grouping: Grouping) -> tuple[str, str]:
    sfx = Grouping(grouping).label_suffix
    pct = f"{agg_type}_pct"
    body = (
        f"SELECT *, {safe_div(f'{pct}_', 'uni_pct')} AS rel_rate FROM ("
        f"SELECT *, {safe_div(f'{agg_type}_degrees_{sfx}', f'{agg_type}_degrees_total')} AS {pct}_, "
        f"{safe_div(f'uni_degrees_{sfx}', 'uni_degrees_total')} AS uni_pct FROM {src})"
    )
    return ("rated0", body)


def rates_select(src: str, agg_type: str) -> tuple[str, str]:
    pct = f"{agg_type}_pct"
    body = (
        f"SELECT * EXCLUDE ({pct}_, uni_pct, rel_rate), {pct}_ AS {pct}, uni_pct, rel_rate, "
        f"{log2_sql('rel_rate')} AS log2_rel_rate, {fold_sql('rel_rate')} AS fold_rel_rate, "
        f"{bounded_sql('rel_rate')} AS bounded_rel_rate FROM {src}"
    )
    return ("rated", body)


def effect_ctes(src: str, agg_type: str, grouping: Grouping, group_cols: Sequence[str]):
    sfx = Grouping(grouping).label_suffix
    num, den = f"{agg_type}_degrees_{sfx}", f"{agg_type}_degrees_total"
    gk = ", ".join(group_cols)
    nn = " AND ".join(f"{c} IS NOT NULL" for c in group_cols)
    e1 = (
        f"SELECT *, {num} - uni_pct * {den} AS excess_degrees_from_parity, "
        f"{zscore_sql(num, den, f'uni_degrees_{sfx}', 'uni_degrees_total')} AS excess_degrees_from_parity_zscore "
        f"FROM {src}"
    )
    ranked = (
        f"SELECT {gk}, rel_rate, row_number() OVER (PARTITION BY {gk} ORDER BY rel_rate) - 1 AS r, "
        f"count(*) OVER (PARTITION BY {gk}) AS n FROM {src} WHERE NOT isnan(rel_rate) AND {nn}"
    )
    med = (
        f"SELECT {gk}, (min(rel_rate) + max(rel_rate)) / 2e0 AS median_rel_rate_uni FROM ranked "
        f"WHERE r = (n - 1) // 2 OR r = n // 2 GROUP BY {gk}"
    )
    e2 = (
        f"SELECT e1.*, COALESCE(med.median_rel_rate_uni, {NAN}) AS median_rel_rate_uni "
        f"FROM e1 LEFT JOIN med USING ({gk})"
    )
    e3 = (
        f"SELECT *, least(CAST({den} AS DOUBLE) * uni_pct * median_rel_rate_uni, CAST({den} AS DOUBLE)) "
        f"AS median_rel_rate_expected_degrees FROM e2"
    )
    # DuckDB's least() ranks NaN like Spark does (greater than any number)
    e4 = (
        f"SELECT *, {num} - median_rel_rate_expected_degrees AS excess_degrees_from_median_expected, "
        f"{zscore_sql(num, den, 'median_rel_rate_expected_degrees', den)} "
        f"AS excess_degrees_from_median_expected_zscore FROM e3"
    )
    e5 = (
        "SELECT e4.*, a.p AS excess_degrees_from_parity_pvalue, b.p AS excess_degrees_from_median_expected_pvalue "
        "FROM e4 LEFT JOIN pv a ON a.z = excess_degrees_from_parity_zscore "
        "LEFT JOIN pv b ON b.z = excess_degrees_from_median_expected_zscore"
    )
    pv = pvalues("e4", "excess_degrees_from_parity_zscore", "excess_degrees_from_median_expected_zscore")
    return [("e1", e1), ("ranked", ranked), ("med", med), ("e2", e2), ("e3", e3), ("e4", e4), ("pv", pv), ("e5", e5)]


def canned_query_sql(
    *, grouping, agg_type, per_unit, field, by_year, rel_rate=False, effect_size=False, **filters
) -> str:
    ctes, keys = grid_sql(
        grouping=grouping, agg_type=agg_type, per_unit=per_unit, field=field, by_year=by_year, **filters
    )
    sfx = Grouping(grouping).label_suffix
    counts = [f"{agg_type}_degrees_{sfx}", f"{agg_type}_degrees_total", f"uni_degrees_{sfx}", "uni_degrees_total"]
    cols = keys + counts
    src = "grid"
    dbl: list[str] = []
    if rel_rate or effect_size:
        ctes += [rates_cte("grid", agg_type, grouping), rates_select("rated0", agg_type)]
        src = "rated"
        dbl += [f"{agg_type}_pct", "uni_pct", *RATE_COLUMNS]
    if effect_size:
        gcols = [k for k in keys if k not in ("institution_name", "unitid")]
        ctes += effect_ctes("rated", agg_type, grouping, gcols)
        src = "e5"
        dbl += [
            "excess_degrees_from_parity", "excess_degrees_from_parity_zscore",
            "excess_degrees_from_parity_pvalue", "median_rel_rate_uni",
            "median_rel_rate_expected_degrees", "excess_degrees_from_median_expected",
            "excess_degrees_from_median_expected_zscore", "excess_degrees_from_median_expected_pvalue",
        ]
    select = ", ".join(cols + [rounded(c, P_DIGITS if c.endswith("pvalue") else 9) for c in dbl])
    return f"{with_cte(*ctes)}\nSELECT {select} FROM {src}"
