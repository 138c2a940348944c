"""Registered ETL / catalog / scalar queries with their oracle SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from equiscope.functions import rates as R
from equiscope.functions.stats import add_zscore
from equiscope.functions.strings import clean_name_col, split_code_title
from equiscope.operators import crosswalk as X
from equiscope.operators import institutions as I
from equiscope.operators import reports as P
from equiscope.operators import reshape as S
from equiscope.operators.filters import TaxonomyRollup, missing_rollup_values
from equiscope.operators.median import median_by
from equiscope.plans import bindings as B
from equiscope.plans import oracle as O
from equiscope.plans.engine import CIP_COLUMNS, cip_table, order_by_keys
from equiscope.plans.registry import CANNED, engine_for, presentable
from equiscope.session import code_apart
from equiscope.sources import files as FS
from equiscope.sources.tables import FACT_SQL, INSTITUTIONS_SQL, completions_fact, institutions_dim, read_table
from equiscope.vocab import NSF_BROAD_FIELD_MAP, NCSESDetailedFieldGroup, NCSESFieldGroup, NCSESSciGroup, NSFBroadField

QUERIES: dict = {}
ORACLE: dict = {}


def reg(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn

    return deco


PART = ["part"]
XTABLES = ["lineitem", "orders", "part"]

# ---------------------------------------------------------------------------
# crosswalk loaders and hops


def hops(spark: SparkSession, sf_dir: str) -> list[X.Hop]:
    def q(text):
        # the loaders' conditions on rows made by such long texts would be one method, too large to be compiled
        return code_apart(B.sql_df(spark, sf_dir, text, PART))

    m0, m1 = q(B.raw_modern_sql(0)), q(B.raw_modern_sql(1))
    l2, l3, l4 = q(B.raw_legacy_sql(2)), q(B.raw_legacy_sql(3)), q(B.raw_legacy_sql(4))
    return [
        X.load_moved_crosswalk(m0, "origin", "dest", "title", "action", "pos", 2010, 2019),
        X.load_moved_crosswalk(m1, "origin", "dest", "title", "action", "pos", 2000, 2009),
        X.load_legacy_crosswalk([l2], "origin", "dest", "title", "pos", 1990, 1999, corrections={"51.1313": "26.0901"}),
        X.load_legacy_crosswalk([l3, l4], "origin", "dest", "title", "pos", 1984, 1991),
    ]


def _sql_modern(k: int, name: str) -> list[tuple[str, str]]:
    strip = "regexp_replace({}, '^[=\"]+|[=\"]+$', '', 'g')"
    raw = f"raw_{name}"
    return [
        (raw, B.raw_modern_sql(k)),
        (f"{name}_codes", f"SELECT {strip.format('origin')} AS origin_code, arg_max({strip.format('dest')}, pos) AS dest_code "
                          f"FROM {raw} WHERE lower(action) = 'moved to' GROUP BY 1"),
        (f"{name}_titles", f"SELECT {strip.format('dest')} AS code, arg_max(trim(title, '.'), pos) AS title "
                           f"FROM {raw} WHERE NOT contains(title, 'Deleted') GROUP BY 1"),
    ]


def _sql_legacy(ks: list[int], name: str, corrections: dict | None = None) -> list[tuple[str, str]]:
    union = " UNION ALL ".join(f"SELECT *, {i} AS prio FROM ({B.raw_legacy_sql(k)}) s{i}" for i, k in enumerate(ks))
    raw = f"raw_{name}"
    keep = (
        f"SELECT * FROM {raw} WHERE origin IS NOT NULL AND dest IS NOT NULL "
        f"AND (prio < {len(ks) - 1} OR NOT coalesce(contains(title, 'Deleted'), FALSE) AND NOT contains(dest, 'Report') "
        "AND NOT contains(dest, 'Deleted') AND origin <> dest)"
    )
    codes = f"SELECT origin AS origin_code, arg_max(dest, {{'p': prio, 'q': pos}}) AS dest_code FROM {name}_keep GROUP BY 1"
    if corrections:
        fix = " UNION ALL ".join(f"SELECT {O.q(a)} AS origin_code, {O.q(b)} AS dest_code" for a, b in corrections.items())
        keys = ", ".join(O.q(a) for a in corrections)
        codes = f"SELECT * FROM ({codes}) c WHERE origin_code NOT IN ({keys}) UNION ALL {fix}"
    return [
        (raw, union),
        (f"{name}_keep", keep),
        (f"{name}_codes", codes),
        (f"{name}_titles", f"SELECT dest AS code, arg_max(title, {{'p': prio, 'q': pos}}) AS title FROM {name}_keep GROUP BY 1"),
    ]


HOP_SQL = (
    _sql_modern(0, "h4") + _sql_modern(1, "h3") + _sql_legacy([2], "h2", {"51.1313": "26.0901"})
    + _sql_legacy([3, 4], "h1")
)
HOP_RANGES = [("h1", 1991), ("h2", 1999), ("h3", 2009), ("h4", 2019)]


@reg("scan_crosswalk_csv", O.with_cte(*_sql_modern(0, "h4")) + """
SELECT c.origin_code, c.dest_code, t.title FROM h4_codes c LEFT JOIN h4_titles t ON c.dest_code = t.code""")
def q_scan_crosswalk_csv(spark, sf_dir):
    h = hops(spark, sf_dir)[0]
    return h.codes.join(h.titles, h.codes.dest_code == h.titles.code, "left").select("origin_code", "dest_code", "title")


@reg("scan_crosswalk_legacy", O.with_cte(*_sql_legacy([3, 4], "h1")) + """
SELECT c.origin_code, c.dest_code, t.title FROM h1_codes c LEFT JOIN h1_titles t ON c.dest_code = t.code""")
def q_scan_crosswalk_legacy(spark, sf_dir):
    h = hops(spark, sf_dir)[3]
    return h.codes.join(h.titles, h.codes.dest_code == h.titles.code, "left").select("origin_code", "dest_code", "title")


@reg("crosswalk_corrections", O.with_cte(*_sql_legacy([2], "h2", {"51.1313": "26.0901"})) + """
SELECT origin_code, dest_code FROM h2_codes""")
def q_crosswalk_corrections(spark, sf_dir):
    return hops(spark, sf_dir)[2].codes.select("origin_code", "dest_code")


@reg("crosswalk_hop", O.with_cte(("codes", B.CODES_SQL), *_sql_modern(0, "h4")) + """
, d AS (SELECT DISTINCT code FROM codes)
SELECT d.code, coalesce(m.dest_code, d.code) AS new_code, t.title AS new_title
FROM d LEFT JOIN h4_codes m ON d.code = m.origin_code LEFT JOIN h4_titles t ON coalesce(m.dest_code, d.code) = t.code""")
def q_crosswalk_hop(spark, sf_dir):
    h = hops(spark, sf_dir)[0]
    codes = B.sql_df(spark, sf_dir, B.CODES_SQL, PART).select("code").distinct().withColumn("new_code", F.col("code"))
    out = X.crosswalk_hop(codes, h, "new_code", None)
    return out.select("code", "new_code", F.col("new_code_title").alias("new_title"))


def chain_sql_ctes(src: str = "xfact", src_sql: str | None = B.XFACT_SQL) -> list[tuple[str, str]]:
    ctes = list(HOP_SQL) + ([(src, src_sql)] if src_sql else []) + [
        ("s0", f"SELECT DISTINCT year, cipcode, cipcode AS c, CAST(NULL AS VARCHAR) AS t, FALSE AS titled FROM {src}"),
    ]
    prev = "s0"
    for i, (h, end) in enumerate(HOP_RANGES, 1):
        g = f"(p.year <= {end})"
        ctes.append((
            f"s{i}",
            f"SELECT p.year, p.cipcode, CASE WHEN {g} THEN coalesce(m.dest_code, p.c) ELSE p.c END AS c, "
            f"CASE WHEN {g} THEN (CASE WHEN p.titled THEN coalesce(tt.title, p.t) ELSE tn.title END) ELSE p.t END AS t, "
            f"p.titled OR {g} AS titled "
            f"FROM {prev} p LEFT JOIN {h}_codes m ON p.c = m.origin_code "
            f"LEFT JOIN {h}_titles tt ON p.c = tt.code "
            f"LEFT JOIN {h}_titles tn ON coalesce(m.dest_code, p.c) = tn.code",
        ))
        prev = f"s{i}"
    ctes.append(("walked", f"SELECT x.*, s.c AS cip2020, s.t AS cip2020_title FROM {src} x LEFT JOIN {prev} s USING (year, cipcode)"))
    return ctes


def walked(spark, sf_dir) -> DataFrame:
    h = hops(spark, sf_dir)
    xf = B.sql_df(spark, sf_dir, B.XFACT_SQL, XTABLES)
    return X.crosswalk_chain(xf, h, "cipcode", "year", "cip2020", "cip2020_title")


@reg("crosswalk_chain", O.with_cte(*chain_sql_ctes()) + "\nSELECT * FROM walked")
def q_crosswalk_chain(spark, sf_dir):
    return walked(spark, sf_dir)


# ---------------------------------------------------------------------------
# taxonomy / classification


def taxonomy(spark, sf_dir) -> DataFrame:
    raw = B.sql_df(spark, sf_dir, B.RAW_TAXONOMY_SQL, PART)
    t = X.load_taxonomy(raw, "sci", "fg", "dfg", "cip_string", "pos")
    return X.taxonomy_lookup(t, X.missing_codes_frame(spark))


def _nsf_sql(fg: str, sg: str) -> str:
    whens = " ".join(f"WHEN {fg} = {O.q(k)} THEN {O.q(v)}" for k, v in NSF_BROAD_FIELD_MAP.items())
    whens2 = " ".join(f"WHEN {sg} = {O.q(k)} THEN {O.q(v)}" for k, v in NSF_BROAD_FIELD_MAP.items())
    return f"(CASE {whens} ELSE (CASE {whens2} END) END)"


def taxonomy_sql_ctes() -> list[tuple[str, str]]:
    over = " UNION ALL ".join(
        f"SELECT {O.q(k)} AS code, {O.q(t)} AS title, {O.q(sg.value)} AS ncses_sci_group, "
        f"{O.q(fg.value)} AS ncses_field_group, {O.q(dg.value)} AS ncses_detailed_field_group"
        for k, (t, sg, fg, dg) in X.MISSING_CODES.items()
    )
    parsed = (
        "SELECT trim(split_part(cip_string, ' - ', 1)) AS code, trim(split_part(cip_string, ' - ', 2), ' .') AS title, "
        "sci AS ncses_sci_group, CASE WHEN sci = 'Non-science and engineering' AND fg = 'Life Sciences' "
        "THEN 'Life Sciences (Non-S&E)' ELSE fg END AS ncses_field_group, dfg AS ncses_detailed_field_group, pos "
        "FROM raw_tax WHERE NOT starts_with(cip_string, 'Total for selected values')"
    )
    last = (
        "SELECT code, arg_max(title, pos) AS title, arg_max(ncses_sci_group, pos) AS ncses_sci_group, "
        "arg_max(ncses_field_group, pos) AS ncses_field_group, "
        "arg_max(ncses_detailed_field_group, pos) AS ncses_detailed_field_group FROM parsed GROUP BY code"
    )
    merged = f"SELECT * FROM last_rows WHERE code NOT IN (SELECT code FROM overrides) UNION ALL SELECT * FROM overrides"
    lookup = f"SELECT *, {_nsf_sql('ncses_field_group', 'ncses_sci_group')} AS nsf_broad_field FROM merged"
    return [("raw_tax", B.RAW_TAXONOMY_SQL), ("parsed", parsed), ("last_rows", last), ("overrides", over),
            ("merged", merged), ("lookup", lookup)]


@reg("scan_taxonomy", O.with_cte(*taxonomy_sql_ctes()) + "\nSELECT * FROM lookup")
def q_scan_taxonomy(spark, sf_dir):
    return taxonomy(spark, sf_dir)


UNK = {
    "cip_title": "Unknown",
    "ncses_sci_group": NCSESSciGroup.unknown.value,
    "ncses_field_group": NCSESFieldGroup.unknown.value,
    "ncses_detailed_field_group": NCSESDetailedFieldGroup.unknown.value,
    "nsf_broad_field": NSFBroadField.unknown.value,
}


def classified_sql_ctes() -> list[tuple[str, str]]:
    cols = []
    for out, src in [("cip_title", "title"), ("ncses_sci_group", "ncses_sci_group"), ("ncses_field_group", "ncses_field_group"),
                     ("ncses_detailed_field_group", "ncses_detailed_field_group"), ("nsf_broad_field", "nsf_broad_field")]:
        cols.append(f"coalesce(c.{src}, o.{src}, {O.q(UNK[out])}) AS {out}")
    body = (
        f"SELECT w.year, w.l_orderkey, w.l_linenumber, w.unitid, w.cipcode, w.n_awards, w.cip2020, {', '.join(cols)} "
        "FROM walked w LEFT JOIN lookup o ON w.cipcode = o.code LEFT JOIN lookup c ON w.cip2020 = c.code"
    )
    return chain_sql_ctes() + taxonomy_sql_ctes() + [("classified", body)]


def classified(spark, sf_dir) -> DataFrame:
    w = walked(spark, sf_dir).drop("cip2020_title")
    return X.classify_taxonomy(w, taxonomy(spark, sf_dir), "cipcode", "cip2020")


@reg("classify_taxonomy", O.with_cte(*classified_sql_ctes()) + "\nSELECT * FROM classified")
def q_classify_taxonomy(spark, sf_dir):
    return classified(spark, sf_dir)


@reg("lookup_titles", O.with_cte(("codes", B.CODES_SQL), *taxonomy_sql_ctes()) + """
, d AS (SELECT DISTINCT code FROM codes)
SELECT d.code, coalesce(l.title, 'Unknown') AS cip_title FROM d LEFT JOIN lookup l USING (code)""")
def q_lookup_titles(spark, sf_dir):
    codes = B.sql_df(spark, sf_dir, B.CODES_SQL, PART).select("code").distinct()
    return X.lookup_titles(codes, taxonomy(spark, sf_dir), "code")


@reg("classify_stem", O.with_cte(("xfact", B.XFACT_SQL), ("stem", B.STEM_SQL)) + """
SELECT x.year, x.l_orderkey, x.l_linenumber, x.cipcode, s.code IS NOT NULL AS dhs_stem
FROM xfact x LEFT JOIN stem s ON x.cipcode = s.code""")
def q_classify_stem(spark, sf_dir):
    xf = B.sql_df(spark, sf_dir, B.XFACT_SQL, XTABLES)
    stem = B.sql_df(spark, sf_dir, B.STEM_SQL, PART)
    return X.classify_stem(xf, stem, "cipcode").select("year", "l_orderkey", "l_linenumber", "cipcode", "dhs_stem")


@reg("scan_stem_list", O.with_cte(("stem", B.STEM_SQL)) + "\nSELECT code FROM stem")
def q_scan_stem_list(spark, sf_dir):
    """Write the list as it is published (series, code, title, spaces and
    repeated codes) and load it."""
    path = FS.scratch_path(spark, "stem-list")
    code = B.sql_df(spark, sf_dir, B.STEM_SQL, PART).select("code")
    listed = code.select(F.left("code", F.lit(2)).alias("2-Digit Series"), F.concat(F.lit(" "), "code").alias("Code"),
                         F.concat(F.lit("Title, of "), "code").alias("Title"))
    listed.unionAll(listed.limit(3)).write.option("header", True).option("ignoreLeadingWhiteSpace", False).csv(path)
    return FS.read_stem_list(spark, path).select("code")


@reg("split_code_title", O.with_cte(("raw_tax", B.RAW_TAXONOMY_SQL)) + """
SELECT pos, trim(split_part(cip_string, ' - ', 1)) AS code,
  CASE WHEN contains(cip_string, ' - ') THEN trim(split_part(cip_string, ' - ', 2), ' .') END AS title
FROM raw_tax""")
def q_split_code_title(spark, sf_dir):
    raw = B.sql_df(spark, sf_dir, B.RAW_TAXONOMY_SQL, PART)
    code, title = split_code_title(F.col("cip_string"))
    return raw.select("pos", code.alias("code"), title.alias("title"))


@reg("strip_wrapper", O.with_cte(("raw", B.raw_modern_sql(0))) + """
SELECT pos, regexp_replace(origin, '^[="]+|[="]+$', '', 'g') AS origin_code,
       regexp_replace(dest, '^[="]+|[="]+$', '', 'g') AS dest_code FROM raw""")
def q_strip_wrapper(spark, sf_dir):
    raw = B.sql_df(spark, sf_dir, B.raw_modern_sql(0), PART)
    return raw.select("pos", X.strip_wrapper("origin").alias("origin_code"), X.strip_wrapper("dest").alias("dest_code"))


# ---------------------------------------------------------------------------
# coverage reports


@reg("unclassified_by_code", O.with_cte(*classified_sql_ctes()) + """
SELECT year, cipcode, cip2020, sum(coalesce(CAST(n_awards AS DOUBLE), 0e0)) AS n_awards
FROM classified WHERE ncses_sci_group = 'Not categorized in NCSES crosswalk' GROUP BY year, cipcode, cip2020""")
def q_unclassified_by_code(spark, sf_dir):
    return P.unclassified_by_code(classified(spark, sf_dir))


@reg("unclassified_share", O.with_cte(*classified_sql_ctes()) + f"""
, a AS (SELECT year, sum(coalesce(CAST(n_awards AS DOUBLE), 0e0)) AS total_awards,
  sum(CASE WHEN ncses_sci_group = 'Not categorized in NCSES crosswalk' THEN coalesce(CAST(n_awards AS DOUBLE), 0e0) ELSE 0e0 END) AS unclassified_awards,
  sum(CASE WHEN ncses_sci_group = 'Not categorized in NCSES crosswalk' AND cipcode <> '95.0000' THEN coalesce(CAST(n_awards AS DOUBLE), 0e0) ELSE 0e0 END) AS non_generic_awards,
  count(DISTINCT CASE WHEN ncses_sci_group = 'Not categorized in NCSES crosswalk' THEN {{'cipcode': cipcode, 'cip2020': cip2020}} END) AS n_unclassified_codes
  FROM classified GROUP BY year)
SELECT year, total_awards, unclassified_awards, non_generic_awards, n_unclassified_codes,
  {O.rounded_expr(O.safe_div('unclassified_awards', 'total_awards'))} AS unclassified_pct,
  {O.rounded_expr(O.safe_div('non_generic_awards', 'total_awards'))} AS non_generic_pct FROM a""")
def q_unclassified_share(spark, sf_dir):
    return presentable(P.unclassified_share(classified(spark, sf_dir)))


@reg("unclassified_ranking", O.with_cte(*classified_sql_ctes()) + """
SELECT cipcode, cip2020, sum(coalesce(CAST(n_awards AS DOUBLE), 0e0)) AS n_awards
FROM classified WHERE ncses_sci_group = 'Not categorized in NCSES crosswalk' GROUP BY cipcode, cip2020
ORDER BY n_awards DESC, cipcode, cip2020""")
def q_unclassified_ranking(spark, sf_dir):
    return P.unclassified_ranking(classified(spark, sf_dir))


# ---------------------------------------------------------------------------
# reshape: wide count columns -> tidy rows, and the yearly reader

IDS = ["unitid", "cipcode", "awlevel", "majornum", "year"]
POST = list(S.POST_2010_CODES)


def _codes_values_sql() -> str:
    rows = ", ".join(f"({O.q(c)}, {O.q(r.value)}, {O.q(g.value)})" for c, (r, g) in S.POST_2010_CODES.items())
    return f"SELECT * FROM (VALUES {rows}) t(code, race_ethnicity, gender)"


def wide_from(long: DataFrame) -> DataFrame:
    """Binding: pivot award rows to one text column per code (sum mod 7, so
    some cells are "0"; combinations without rows stay NULL)."""
    w = S.pivot_codes(long, IDS, "code", {c: c for c in POST})
    return w.withColumns({c: (F.col(c) % 7).cast("string") for c in POST})


#: Files that a survey year is spread over.
YEAR_FILES = 16


def by_year(wide: DataFrame) -> DataFrame:
    """Rows dealt so that a year becomes YEAR_FILES files at most, however many
    tasks there are (else every task writes a file for every year)."""
    return wide.repartition("year", F.pmod(F.hash("unitid", "cipcode"), F.lit(YEAR_FILES)))


def _wide_sql(long_sql: str) -> list[tuple[str, str]]:
    return [
        ("long", long_sql),
        ("sums", f"SELECT {', '.join(IDS)}, code, CAST(sum(n_awards) % 7 AS VARCHAR) AS v FROM long GROUP BY ALL"),
        ("ids", f"SELECT DISTINCT {', '.join(IDS)} FROM long"),
        ("codes", _codes_values_sql()),
        ("tidy", f"SELECT ids.*, codes.race_ethnicity, codes.gender, sums.v AS n_awards FROM ids CROSS JOIN codes "
                 f"LEFT JOIN sums USING ({', '.join(IDS)}, code) WHERE sums.v IS DISTINCT FROM '0'"),
    ]


FACT4 = ["lineitem", "orders", "part", "customer"]


@reg("unpivot_groups", O.with_cte(*_wide_sql(B.wide_long_sql())) + "\nSELECT * FROM tidy")
def q_unpivot_groups(spark, sf_dir):
    wide = wide_from(B.sql_df(spark, sf_dir, B.wide_long_sql(), FACT4))
    return S.filter_zero(S.unpivot_groups(wide, IDS))


# raw yearly rows: codes without a dot up to 1986, padded with spaces later,
# size-50 rows stand for the all-fields total line
RAW_YEAR_LONG_SQL = f"""SELECT unitid, CASE WHEN p_size = 50 THEN (CASE WHEN year <= 1986 THEN '990000' ELSE '99.0000' END)
    WHEN year <= 1986 THEN CAST(bnum AS STRING) || lpad(CAST(p_size AS STRING), 4, '0')
    ELSE ' ' || {B.code_expr('bnum', 'p_size')} || ' ' END AS cipcode,
  awlevel, majornum, year, code, n_awards
FROM (SELECT 1984 + (CAST(year(o_orderdate) AS INTEGER) - 1995) * 7 + (l_linenumber - 1) AS year,
  l_suppkey AS unitid, CAST(replace(p_brand, 'Brand#', '') AS INTEGER) AS bnum, p_size,
  CAST(substr(o_orderpriority, 1, 1) AS INTEGER) * 4 - 3 AS awlevel,
  CASE WHEN l_linenumber <= 5 THEN 1 ELSE 2 END AS majornum,
  (CASE c_mktsegment {" ".join(f"WHEN '{k}' THEN '{v}'" for k, v in B.SEGMENT_CODE.items())} END)
    || (CASE WHEN l_linestatus = 'F' THEN 'w' ELSE 'm' END) AS code,
  CAST(l_quantity AS BIGINT) AS n_awards
  FROM {{lineitem}} JOIN {{orders}} ON l_orderkey = o_orderkey JOIN {{part}} ON l_partkey = p_partkey
  JOIN {{customer}} ON o_custkey = c_custkey) r"""


def read_years(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All survey years at once: clean -> translate -> crosswalk -> tidy ->
    classify -> STEM flag (the yearly reader without a per-year loop)."""
    from equiscope.plans.yearly import completions_from_wide

    wide = wide_from(B.sql_df(spark, sf_dir, RAW_YEAR_LONG_SQL, FACT4))
    return completions_from_wide(wide, hops(spark, sf_dir), taxonomy(spark, sf_dir), B.sql_df(spark, sf_dir, B.STEM_SQL, PART))


def _award_sql(c: str) -> str:
    whens = " ".join(f"WHEN {k} THEN {O.q(v.value)}" for k, v in S.AWARD_LEVEL_CODES.items())
    return f"coalesce(CASE CAST({c} AS INTEGER) {whens} END, 'Unknown')"


def _norm_code_sql(c: str, y: str) -> str:
    t = f"trim({c})"
    padded = f"(CASE WHEN length({t}) = 5 THEN '0' || {t} ELSE {t} END)"
    return f"(CASE WHEN {y} <= 1986 THEN substr({padded}, 1, 2) || '.' || substr({padded}, 3) ELSE {t} END)"


@reg("read_year")
def q_read_year(spark, sf_dir):
    return read_years(spark, sf_dir)


@reg("map_award_level", f"""SELECT o_orderkey, {_award_sql("CAST(substr(o_orderpriority, 1, 1) AS INTEGER) * 4 - 3")} AS awlevel FROM orders""")
def q_map_award_level(spark, sf_dir):
    o = read_table(spark, sf_dir, "orders")
    code = F.substring("o_orderpriority", 1, 1).cast("int") * 4 - 3
    return o.select("o_orderkey", S.map_award_level(code).alias("awlevel"))


@reg("normalise_code", O.with_cte(("r", RAW_YEAR_LONG_SQL)) + f"""
SELECT year, cipcode AS raw_code, {_norm_code_sql('cipcode', 'year')} AS cipcode FROM r""")
def q_normalise_code(spark, sf_dir):
    r = B.sql_df(spark, sf_dir, RAW_YEAR_LONG_SQL, FACT4)
    return r.select("year", F.col("cipcode").alias("raw_code"), S.normalise_code(F.col("cipcode"), F.col("year")).alias("cipcode"))


@reg("filter_total_codes", O.with_cte(("r", RAW_YEAR_LONG_SQL)) + f"""
, n AS (SELECT year, unitid, {_norm_code_sql('cipcode', 'year')} AS cipcode, n_awards FROM r)
SELECT * FROM n WHERE NOT coalesce(cipcode IN ('99.0000', '99'), FALSE)""")
def q_filter_total_codes(spark, sf_dir):
    r = B.sql_df(spark, sf_dir, RAW_YEAR_LONG_SQL, FACT4)
    n = r.select("year", "unitid", S.normalise_code(F.col("cipcode"), F.col("year")).alias("cipcode"), "n_awards")
    return S.filter_total_codes(n)


@reg("filter_zero", O.with_cte(*_wide_sql(B.wide_long_sql())) + """
SELECT count(*) AS n_rows, count(n_awards) AS n_non_null FROM tidy""")
def q_filter_zero(spark, sf_dir):
    wide = wide_from(B.sql_df(spark, sf_dir, B.wide_long_sql(), FACT4))
    t = S.filter_zero(S.unpivot_groups(wide, IDS))
    return t.agg(F.count(F.lit(1)).alias("n_rows"), F.count("n_awards").alias("n_non_null"))


def _pivot_sql() -> str:
    cells = ", ".join(f"max(CASE WHEN code = {O.q(c)} THEN v END) AS {c}" for c in POST)
    return (O.with_cte(*_wide_sql(B.wide_long_sql())[:2]) +
            f"\nSELECT unitid, cipcode, awlevel, majornum, {cells} FROM sums GROUP BY unitid, cipcode, awlevel, majornum, year")


@reg("project_known_columns", _pivot_sql())
def q_project_known_columns(spark, sf_dir):
    """Index and known code columns survive; others (year, extra totals) go."""
    wide = wide_from(B.sql_df(spark, sf_dir, B.wide_long_sql(), FACT4)).withColumn("ctotalt", F.lit("1"))
    return S.project_known_columns(wide)


# ---------------------------------------------------------------------------
# institutions


def event_attrs(spark, sf_dir) -> DataFrame:
    return B.sql_df(spark, sf_dir, B.EVENT_ATTRS_SQL, ["events"])


ATTRS = ["institution_name", "city", "score"]
ORDER_SQL = "{'v': metadata_vintage, 'e': event_id}"


@reg("latest_non_null", O.with_cte(("ev", B.EVENT_ATTRS_SQL)) + f"""
SELECT unitid, {', '.join(f"arg_max({c}, {ORDER_SQL}) FILTER (WHERE {c} IS NOT NULL) AS {c}" for c in ATTRS)},
  max(metadata_vintage) AS metadata_vintage FROM ev GROUP BY unitid""")
def q_latest_non_null(spark, sf_dir):
    return I.latest_non_null(event_attrs(spark, sf_dir), "unitid", "metadata_vintage", "event_id", ATTRS)


@reg("forward_fill", O.with_cte(("ev", B.EVENT_ATTRS_SQL)) + f"""
SELECT unitid, metadata_vintage, event_id, {', '.join(
    f"last_value({c} IGNORE NULLS) OVER (PARTITION BY unitid ORDER BY metadata_vintage, event_id "
    f"ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS {c}" for c in ATTRS)} FROM ev""")
def q_forward_fill(spark, sf_dir):
    return I.forward_fill(event_attrs(spark, sf_dir), "unitid", "metadata_vintage", ATTRS, tie="event_id")


@reg("keep_latest", """SELECT * FROM events
QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1""")
def q_keep_latest(spark, sf_dir):
    ev = read_table(spark, sf_dir, "events")
    return I.keep_latest(ev, "user_id", "ts", "event_id").select(*ev.columns)


@reg("latest_column_names", """SELECT event_type AS original_colname, arg_max(props, event_id) AS mapped_colname
FROM events GROUP BY event_type""")
def q_latest_column_names(spark, sf_dir):
    ev = read_table(spark, sf_dir, "events").select(
        F.col("event_type").alias("original_colname"), F.col("props").alias("mapped_colname"),
        F.col("event_id").alias("metadata_vintage"))
    return I.latest_column_names(ev)


@reg("join_code_labels", O.with_cte(("d", B.DICTIONARY_SQL)) + """
SELECT s_suppkey, s_name, d.valuelabel AS s_nationkey FROM supplier LEFT JOIN d ON CAST(s_nationkey AS VARCHAR) = d.codevalue""")
def q_join_code_labels(spark, sf_dir):
    d = B.sql_df(spark, sf_dir, B.DICTIONARY_SQL, ["region"])
    sup = read_table(spark, sf_dir, "supplier").select("s_suppkey", "s_name", "s_nationkey")
    return I.join_code_labels(sup, d, ["s_nationkey"])


@reg("join_code_labels_unmapped", O.with_cte(("d", B.DICTIONARY_SQL)) + """
SELECT DISTINCT CAST(s_nationkey AS VARCHAR) AS s_nationkey FROM supplier
WHERE CAST(s_nationkey AS VARCHAR) NOT IN (SELECT codevalue FROM d)""")
def q_join_code_labels_unmapped(spark, sf_dir):
    d = B.sql_df(spark, sf_dir, B.DICTIONARY_SQL, ["region"])
    return I.unmapped_codes(read_table(spark, sf_dir, "supplier"), d, "s_nationkey")


@reg("tech_health_school", f"""SELECT doc_id,
  regexp_matches(text, '{I.TECH_PATTERN}') AS tech_school,
  regexp_matches(text, '{I.HEALTH_PATTERN}') AS health_school FROM documents""")
def q_tech_health_school(spark, sf_dir):
    d = read_table(spark, sf_dir, "documents")
    return d.select("doc_id", I.tech_school(F.col("text")).alias("tech_school"), I.health_school(F.col("text")).alias("health_school"))


@reg("normalise_region", O.with_cte(("r", B.REGION_LABEL_SQL)) + f"""
, s AS (SELECT n_nationkey, regexp_replace(regexp_replace(translate(label, ',().', ''), '\\s+', ' ', 'g'), '^ | $', '', 'g') AS label FROM r)
SELECT n_nationkey, CASE WHEN label = '{I.OUTLYING_FROM}' THEN '{I.OUTLYING_TO}' ELSE label END AS region FROM s""")
def q_normalise_region(spark, sf_dir):
    r = B.sql_df(spark, sf_dir, B.REGION_LABEL_SQL, ["nation", "region"])
    return r.select("n_nationkey", I.normalise_region(F.col("label")).alias("region"))


@reg("clean_name", """SELECT p_partkey,
  regexp_replace(regexp_replace(lower(translate(replace(p_type || ' - ' || p_name || ' (' || CAST(p_size AS VARCHAR) || ')/x''s', '''', ''), '-:,()/', '      ')), '^\\s+|\\s+$', '', 'g'), '\\s+', '_', 'g') AS name
FROM part""")
def q_clean_name(spark, sf_dir):
    p = read_table(spark, sf_dir, "part")
    raw = F.concat(F.col("p_type"), F.lit(" - "), F.col("p_name"), F.lit(" ("), F.col("p_size").cast("string"), F.lit(")/x's"))
    return p.select("p_partkey", clean_name_col(raw).alias("name"))


# ---------------------------------------------------------------------------
# sources and sinks


@reg("scan_prefer_revised", """WITH o AS (SELECT o_orderkey, o_orderstatus, CAST(year(o_orderdate) AS INTEGER) AS year FROM orders),
rv AS (SELECT * FROM o WHERE o_orderstatus = 'F' AND year >= 1998)
SELECT * FROM o WHERE year NOT IN (SELECT year FROM rv) UNION ALL SELECT * FROM rv""")
def q_scan_prefer_revised(spark, sf_dir):
    o = read_table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", F.year("o_orderdate").alias("year"))
    rv = o.filter((F.col("o_orderstatus") == "F") & (F.col("year") >= 1998))
    return FS.prefer_revised(o, rv, "year")


@reg("vintage_from_path", "SELECT o_orderkey, CAST(year(o_orderdate) AS INTEGER) AS vintage FROM orders")
def q_vintage_from_path(spark, sf_dir):
    path = FS.scratch_path(spark, "orders-by-year")
    o = read_table(spark, sf_dir, "orders").select("o_orderkey", F.year("o_orderdate").alias("year"))
    o.write.partitionBy("year").parquet(path)
    back = spark.read.option("basePath", path).parquet(f"{path}/year=*")
    return FS.vintage_from_path(back.drop("year"), "vintage", r"/year=(\d{4})/").select("o_orderkey", "vintage")


@reg("scan_institutions", "SELECT CAST(s_suppkey AS VARCHAR) AS s_suppkey, s_name, CAST(s_nationkey AS VARCHAR) AS s_nationkey FROM supplier")
def q_scan_institutions(spark, sf_dir):
    path = FS.scratch_path(spark, "institutions-csv")
    sup = read_table(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").cast("string").alias("ï»¿s_suppkey"),
        F.concat(F.lit("  "), F.col("s_name"), F.lit(" ")).alias(" s_name"),
        F.col("s_nationkey").cast("string").alias("s_nationkey"),
    )
    sup.write.option("header", True).option("encoding", "ISO-8859-1").csv(path)
    return I.clean_raw_strings(FS.read_institution_csv(spark, path))


@reg("load_institutions_table", """SELECT CAST(s_suppkey AS INTEGER) AS unitid, s_name AS institution_name,
  CAST(s_nationkey AS VARCHAR) AS nationkey FROM supplier""")
def q_load_institutions_table(spark, sf_dir):
    path = FS.scratch_path(spark, "institutions-gz")
    sup = read_table(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").cast("string").alias("unitid"), F.col("s_name").alias("institution_name"),
        F.col("s_nationkey").cast("string").alias("nationkey"))
    sup.write.option("header", True).option("compression", "gzip").csv(path)
    return FS.load_institutions_table(spark, path)


def _fact_files(spark, sf_dir, name, **changed):
    """The fact as two sets of files, the second with its columns in reverse."""
    path = FS.scratch_path(spark, name)
    fact = completions_fact(spark, sf_dir).withColumns({c: v for c, v in changed.items()})
    half = F.pmod(F.col("unitid"), F.lit(2)) == 0
    for part, columns in ((fact.filter(half), fact.columns), (fact.filter(~half), fact.columns[::-1])):
        part.select(*columns).write.mode("append").option("header", True).option("compression", "gzip").csv(path)
    return path


@reg("load_typed_table", FACT_SQL)
def q_load_typed_table(spark, sf_dir):
    """Files of two column orders, each read under its own header."""
    return FS.read_fact_csv(spark, _fact_files(spark, sf_dir, "fact-csv"))


@reg("load_typed_table_rejects", f"""SELECT unitid, cipcode, CASE WHEN unitid % 11 <> 0 THEN majornum END AS majornum,
  unitid % 7 = 0 OR unitid % 11 = 0 AS rejected, CASE WHEN unitid % 7 <> 0 THEN n_awards END AS n_awards,
  concat_ws(',', CASE WHEN unitid % 11 = 0 THEN 'majornum' END, CASE WHEN unitid % 7 = 0 THEN 'n_awards' END) AS bad
FROM ({FACT_SQL}) f""")
def q_load_typed_table_rejects(spark, sf_dir):
    """Counts and majors that are no numbers: such rows are set aside, named."""
    unit = F.col("unitid")
    words = F.when(unit % 7 == 0, F.lit("twelve")).otherwise(F.col("n_awards").cast("string"))
    major = F.when(unit % 11 == 0, F.lit("1.5x")).otherwise(F.col("majornum").cast("string"))
    path = _fact_files(spark, sf_dir, "fact-csv-bad", n_awards=words, majornum=major)
    good, bad = FS.read_fact_csv_with_rejects(spark, path)
    both = good.withColumn(FS.BAD_VALUES, F.array().cast("array<string>")).unionByName(bad)
    return both.select("unitid", "cipcode", "majornum", (F.size(FS.BAD_VALUES) > 0).alias("rejected"), "n_awards",
                       F.array_join(FS.BAD_VALUES, ",").alias("bad"))


@reg("sink_interim", FACT_SQL)
def q_sink_interim(spark, sf_dir):
    path = FS.scratch_path(spark, "fact-interim")
    FS.write_interim(completions_fact(spark, sf_dir), path)
    back = FS.read_fact_csv(spark, path)
    return back.select(*[c for c in completions_fact(spark, sf_dir).columns])


@reg("sink_database", f"SELECT * EXCLUDE (cip_title) FROM ({FACT_SQL}) f")
def q_sink_database(spark, sf_dir):
    """Write the three tables (fact without titles, code dimension,
    institutions) and read the fact back."""
    root = FS.scratch_path(spark, "database")
    fact = completions_fact(spark, sf_dir)
    FS.write_database(fact, institutions_dim(spark, sf_dir), root)
    return FS.read_database(spark, root)["completions"].select(*[c for c in fact.columns if c != "cip_title"])


# ---------------------------------------------------------------------------
# catalog, domains, sorting, set operations

FACT_CTE = O.with_cte(("fact", FACT_SQL), ("inst", INSTITUTIONS_SQL))


@reg("cip_table_build", FACT_CTE + f"\nSELECT DISTINCT {', '.join(CIP_COLUMNS)} FROM fact")
def q_cip_table_build(spark, sf_dir):
    return cip_table(completions_fact(spark, sf_dir))


@reg("get_cip_table", FACT_CTE + f"\nSELECT DISTINCT {', '.join(CIP_COLUMNS)} FROM fact ORDER BY cip2020")
def q_get_cip_table(spark, sf_dir):
    return order_by_keys(engine_for(spark, sf_dir).get_cip_table(), ["cip2020"])


@reg("get_institutions_table", FACT_CTE + "\nSELECT unitid, institution_name FROM inst")
def q_get_institutions_table(spark, sf_dir):
    return engine_for(spark, sf_dir).get_institutions_table("institution_name")


CUSTOM = """SELECT cip2020, SUM(n_awards) AS total_awards FROM completions
WHERE year BETWEEN :start AND :stop AND array_contains(:levels, awlevel)
GROUP BY cip2020 ORDER BY total_awards DESC, cip2020 LIMIT 10"""


@reg("custom_sql", FACT_CTE + """
SELECT cip2020, SUM(n_awards) AS total_awards FROM fact
WHERE year BETWEEN 1996 AND 2000 AND awlevel IN ('1-URGENT', '3-MEDIUM')
GROUP BY cip2020 ORDER BY total_awards DESC, cip2020 LIMIT 10""")
def q_custom_sql(spark, sf_dir):
    eng = engine_for(spark, sf_dir)
    return eng.get_df_from_query(CUSTOM, {"start": 1996, "stop": 2000, "levels": ["1-URGENT", "3-MEDIUM"]})


@reg("top_codes", FACT_CTE + """
SELECT cip2020, SUM(n_awards) AS total_awards FROM fact GROUP BY cip2020 ORDER BY total_awards DESC, cip2020 LIMIT 10""")
def q_top_codes(spark, sf_dir):
    return P.top_codes(completions_fact(spark, sf_dir))


@reg("enum_domains", FACT_CTE + """
SELECT DISTINCT awlevel, (SELECT count(DISTINCT awlevel) FROM fact) AS domain_size FROM fact""")
def q_enum_domains(spark, sf_dir):
    return P.enum_domain(completions_fact(spark, sf_dir), "awlevel")


@reg("count_distinct_domain", FACT_CTE + """
SELECT count(DISTINCT awlevel) AS n_awlevel, count(DISTINCT race_ethnicity) AS n_race_ethnicity,
  count(DISTINCT gender) AS n_gender, count(DISTINCT cipcode) AS n_cipcode, count(DISTINCT cip2020) AS n_cip2020 FROM fact""")
def q_count_distinct_domain(spark, sf_dir):
    return P.count_distinct_domains(completions_fact(spark, sf_dir), ["awlevel", "race_ethnicity", "gender", "cipcode", "cip2020"])


@reg("union_distinct_codes", O.with_cte(*classified_sql_ctes()) + """
SELECT cipcode AS code FROM classified UNION SELECT cip2020 FROM classified""")
def q_union_distinct_codes(spark, sf_dir):
    return P.shared_domain(classified(spark, sf_dir), ["cipcode", "cip2020"])


@reg("distinct_values", FACT_CTE + "\nSELECT DISTINCT ncses_field_group FROM fact")
def q_distinct_values(spark, sf_dir):
    return completions_fact(spark, sf_dir).select("ncses_field_group").distinct()


@reg("union_years", FACT_CTE + """
SELECT year, unitid, cipcode, n_awards, CAST(NULL AS INTEGER) AS majornum FROM fact WHERE year <= 1998
UNION ALL SELECT year, unitid, cipcode, n_awards, majornum FROM fact WHERE year > 1998""")
def q_union_years(spark, sf_dir):
    f = completions_fact(spark, sf_dir)
    early = f.filter(F.col("year") <= 1998).select("year", "unitid", "cipcode", "n_awards")
    late = f.filter(F.col("year") > 1998).select("year", "unitid", "cipcode", "n_awards", "majornum")
    return early.unionByName(late, allowMissingColumns=True)


@reg("sort_dimension", FACT_CTE + "\nSELECT unitid, institution_name FROM inst ORDER BY unitid")
def q_sort_dimension(spark, sf_dir):
    return order_by_keys(institutions_dim(spark, sf_dir), ["unitid"])


@reg("order_by_keys")
def q_order_by_keys(spark, sf_dir):
    spec = CANNED["field_totals_by_grouping"]
    eng = engine_for(spark, sf_dir)
    from equiscope.operators.filters import QueryFilters

    df = eng.field_totals_by_grouping(spec["grouping"], spec["taxonomy"], QueryFilters(strict=False, **spec["filters"]),
                                      rel_rate=True, sort=True)
    return presentable(df)


@reg("warn_missing_values", FACT_CTE + """
SELECT v AS ncses_field_group FROM (VALUES ('FG3'), ('No such field'), ('FG9')) t(v)
WHERE v NOT IN (SELECT DISTINCT ncses_field_group FROM fact)""")
def q_warn_missing_values(spark, sf_dir):
    return missing_rollup_values(completions_fact(spark, sf_dir), TaxonomyRollup("ncses_field_group", ["FG3", "No such field", "FG9"]))


def _order_by_oracle() -> str:
    from equiscope.plans.registry import ORACLE as CANNED_ORACLE

    return CANNED_ORACLE["field_totals_by_grouping"] + "\nORDER BY ncses_field_group, gender"


ORACLE["order_by_keys"] = _order_by_oracle()


# ---------------------------------------------------------------------------
# scalar functions on the per-institution grid (zero-filled rows give the
# 0 / -inf edge cases)

SCALAR_SPEC = dict(grouping="gender", agg_type="field", per_unit=True, field="ncses_field_group", by_year=True,
                   start_year=1984, end_year=2024)


def scalar_grid(spark, sf_dir) -> DataFrame:
    from equiscope.operators.filters import QueryFilters

    eng = engine_for(spark, sf_dir)
    return eng.uni_field_totals_by_grouping("gender", "ncses_field_group", QueryFilters(strict=False), by_year=True,
                                            rel_rate=True)


def _scalar_sql(select: str) -> str:
    ctes, _ = O.grid_sql(**SCALAR_SPEC)
    ctes += [O.rates_cte("grid", "field", "gender"), O.rates_select("rated0", "field")]
    return O.with_cte(*ctes) + "\n" + select


KEYS = "unitid, ncses_field_group, gender, year"


@reg("rel_rate_transforms", _scalar_sql(f"""SELECT {KEYS}, {O.rounded('rel_rate')}, {O.rounded('log2_rel_rate')},
  {O.rounded('fold_rel_rate')}, {O.rounded('bounded_rel_rate')},
  {O.rounded_expr("CASE WHEN isnan(fold_rel_rate) THEN CAST('NaN' AS DOUBLE) WHEN fold_rel_rate < 0 THEN -1e0 / (fold_rel_rate - 1e0) ELSE fold_rel_rate + 1e0 END")} AS inverse_fold,
  {O.rounded_expr("CASE WHEN isnan(bounded_rel_rate) THEN CAST('Infinity' AS DOUBLE) WHEN bounded_rel_rate <= 0 THEN bounded_rel_rate + 1e0 WHEN bounded_rel_rate < 1 THEN 1e0 / (1e0 - bounded_rel_rate) ELSE CAST('Infinity' AS DOUBLE) END")} AS inverse_bounded
FROM rated"""))
def q_rel_rate_transforms(spark, sf_dir):
    g = scalar_grid(spark, sf_dir)
    out = g.select(
        "unitid", "ncses_field_group", "gender", "year", "rel_rate", "log2_rel_rate", "fold_rel_rate", "bounded_rel_rate",
        R.inverse_fold_transform("fold_rel_rate").alias("inverse_fold"),
        R.inverse_bounded_ratio_transform("bounded_rel_rate").alias("inverse_bounded"),
    )
    return presentable(out)


@reg("group_share", _scalar_sql(f"""SELECT {KEYS},
  {O.rounded_expr(O.safe_div('field_degrees_within_gender', 'field_degrees_total'))} AS share_within_field,
  {O.rounded_expr(O.safe_div('uni_degrees_within_gender', 'uni_degrees_total'))} AS share_of_all_fields FROM rated"""))
def q_group_share(spark, sf_dir):
    g = scalar_grid(spark, sf_dir)
    g = R.group_share(g, "field_degrees_within_gender", "field_degrees_total", "share_within_field")
    g = R.group_share(g, "uni_degrees_within_gender", "uni_degrees_total", "share_of_all_fields")
    return presentable(g.select("unitid", "ncses_field_group", "gender", "year", "share_within_field", "share_of_all_fields"))


def _zscore_pvalue_sql() -> str:
    z = O.zscore_sql("field_degrees_within_gender", "field_degrees_total", "uni_degrees_within_gender", "uni_degrees_total")
    scored = f"(SELECT {KEYS}, {z} AS z FROM rated)"
    small = "CASE WHEN p > 0 THEN log10(p) END"
    return _scalar_sql(f"""SELECT {KEYS}, {O.rounded('z')}, {O.rounded_expr('p', O.P_DIGITS)} AS pvalue,
  {O.rounded_expr(small, O.P_DIGITS)} AS log10_p
FROM {scored} LEFT JOIN ({O.pvalues(scored, 'z')}) USING (z)""")


@reg("zscore_pvalue", _zscore_pvalue_sql())
def q_zscore_pvalue(spark, sf_dir):
    """Small p-values are compared by their logarithm, so by relative error."""
    g = scalar_grid(spark, sf_dir)
    g = add_zscore(g, R.Rate("field_pct", "field_degrees_within_gender", "field_degrees_total"),
                   R.Rate("uni_pct", "uni_degrees_within_gender", "uni_degrees_total"), "t")
    p = F.col("t_pvalue")
    out = g.select("unitid", "ncses_field_group", "gender", "year", F.col("t_zscore").alias("z"), p.alias("pvalue"),
                   F.when(p > 0, F.log10(p)).alias("log10_pvalue"))
    return presentable(out).withColumnRenamed("log10_pvalue", "log10_p")


@reg("median_rel_rate", _scalar_sql("""SELECT ncses_field_group, gender, year, (min(rel_rate) + max(rel_rate)) / 2e0 AS median_rel_rate
FROM (SELECT ncses_field_group, gender, year, rel_rate,
  row_number() OVER (PARTITION BY ncses_field_group, gender, year ORDER BY rel_rate) - 1 AS r,
  count(*) OVER (PARTITION BY ncses_field_group, gender, year) AS n FROM rated WHERE NOT isnan(rel_rate))
WHERE r = (n - 1) // 2 OR r = n // 2 GROUP BY ncses_field_group, gender, year"""))
def q_median_rel_rate(spark, sf_dir):
    g = scalar_grid(spark, sf_dir)
    return median_by(g, ["ncses_field_group", "gender", "year"], "rel_rate", "median_rel_rate")


@reg("median_rel_rate_aggregate", ORACLE.get("median_rel_rate"))
def q_median_rel_rate_aggregate(spark, sf_dir):
    """The path for groups of any size gives the same values."""
    g = scalar_grid(spark, sf_dir)
    return median_by(g, ["ncses_field_group", "gender", "year"], "rel_rate", "median_rel_rate", unbounded=True)


def _read_year_sql(wide: list[tuple[str, str]]) -> str:
    ctes = wide + [
        ("t1", f"SELECT unitid, {_norm_code_sql('cipcode', 'year')} AS cipcode, {_award_sql('awlevel')} AS awlevel, "
               "majornum, year, race_ethnicity, gender, n_awards FROM tidy"),
        ("t2", "SELECT * FROM t1 WHERE NOT coalesce(cipcode IN ('99.0000', '99'), FALSE)"),
    ]
    ctes += chain_sql_ctes("t2", None)
    ctes += taxonomy_sql_ctes()
    ctes.append(("stem", B.STEM_SQL))
    cols = []
    for out, src in [("cip_title", "title"), ("ncses_sci_group", "ncses_sci_group"), ("ncses_field_group", "ncses_field_group"),
                     ("ncses_detailed_field_group", "ncses_detailed_field_group"), ("nsf_broad_field", "nsf_broad_field")]:
        cols.append(f"coalesce(c.{src}, o.{src}, {O.q(UNK[out])}) AS {out}")
    final = (
        f"SELECT w.unitid, w.cipcode, w.awlevel, w.majornum, w.year, w.cip2020, w.race_ethnicity, w.gender, "
        f"CAST(trim(w.n_awards) AS BIGINT) AS n_awards, {', '.join(cols)}, s.code IS NOT NULL AS dhs_stem "
        "FROM walked w LEFT JOIN lookup o ON w.cipcode = o.code LEFT JOIN lookup c ON w.cip2020 = c.code "
        "LEFT JOIN stem s ON w.cip2020 = s.code"
    )
    return O.with_cte(*ctes) + "\n" + final


ORACLE["read_year"] = _read_year_sql(_wide_sql(RAW_YEAR_LONG_SQL))


# ---------------------------------------------------------------------------
# yearly files of the four layouts, through CSV files

#: Layout by survey year, with the order of its columns in the files.
LAYOUTS = [S.PRE_1995_GENDERONLY_CODES, S.PRE_2010_CODES, S.INTERIM_CODES, S.POST_2010_CODES]
LAYOUT_SQL = f"""SELECT unitid, cipcode, awlevel, CASE WHEN layout = 0 THEN 1 ELSE majornum END AS majornum, year, layout,
  CAST(k % (CASE layout {" ".join(f"WHEN {i} THEN {len(c)}" for i, c in enumerate(LAYOUTS))} END) AS INTEGER) AS k, n_awards
FROM (SELECT *, CASE WHEN year < 1995 THEN 0 WHEN year < 2008 THEN 1 WHEN year < 2011 THEN 2 ELSE 3 END AS layout FROM (
{RAW_YEAR_LONG_SQL.replace("code, n_awards", "code, n_awards, k").replace("AS BIGINT) AS n_awards", "AS BIGINT) AS n_awards, l_partkey + l_linenumber AS k")}
) rr) ll"""


def _layout_wide_sql() -> list[tuple[str, str]]:
    codes = ", ".join(
        f"({i}, {k}, {O.q(r.value)}, {O.q(g.value)})" for i, c in enumerate(LAYOUTS) for k, (r, g) in enumerate(c.values())
    )
    ids = ", ".join(IDS)
    return [
        ("long", LAYOUT_SQL),
        ("sums", f"SELECT {ids}, layout, k, CAST(sum(n_awards) % 7 AS VARCHAR) AS v FROM long GROUP BY ALL"),
        ("ids", f"SELECT DISTINCT {ids}, layout FROM long"),
        ("codes", f"SELECT * FROM (VALUES {codes}) t(layout, k, race_ethnicity, gender)"),
        ("tidy", f"SELECT {ids}, layout, race_ethnicity, gender, v AS n_awards FROM ids JOIN codes USING (layout) "
                 f"LEFT JOIN sums USING ({ids}, layout, k) WHERE v IS DISTINCT FROM '0'"),
    ]


def layout_wide(spark, sf_dir, layout: int) -> DataFrame:
    """Binding: the wide rows of one layout, one text column per code."""
    codes = list(LAYOUTS[layout])
    long = B.sql_df(spark, sf_dir, LAYOUT_SQL, FACT4).filter(F.col("layout") == layout)
    w = S.pivot_codes(long, IDS, "k", dict(enumerate(codes)))
    return w.withColumns({c: (F.col(c) % 7).cast("string") for c in codes})


def layouts_wide(spark, sf_dir) -> list[DataFrame]:
    """:func:`layout_wide` of every layout.  The tables are joined and summed
    once for all of them, with one column per place in the layout."""
    places = {k: f"place{k:02d}" for k in range(max(map(len, LAYOUTS)))}
    sums = S.pivot_codes(B.sql_df(spark, sf_dir, LAYOUT_SQL, FACT4), [*IDS, "layout"], "k", places)
    path = FS.scratch_path(spark, "layout-sums")
    sums.write.partitionBy("layout").parquet(path)
    kept = spark.read.schema(sums.schema).parquet(path)
    return [
        kept.filter(F.col("layout") == i).select(*IDS, *[(F.col(places[k]) % 7).cast("string").alias(c) for k, c in enumerate(codes)])
        for i, codes in enumerate(LAYOUTS)
    ]


def _unpivot_layout(i: int):
    def fn(spark, sf_dir):
        return S.filter_zero(S.unpivot_groups(layout_wide(spark, sf_dir, i), IDS))

    fn.__doc__ = f"Code set {i}, chosen from the column names."
    return fn


for _i, _name in enumerate(["gender_only", "pre_2010", "interim", "post_2010"]):
    reg(f"unpivot_groups_{_name}", O.with_cte(*_layout_wide_sql()) + f"""
SELECT {", ".join(IDS)}, race_ethnicity, gender, n_awards FROM tidy WHERE layout = {_i}""")(_unpivot_layout(_i))


@reg("default_majornum", O.with_cte(*_layout_wide_sql()) + """
SELECT unitid, cipcode, awlevel, year, CAST(1 AS INTEGER) AS majornum FROM ids WHERE layout = 0""")
def q_default_majornum(spark, sf_dir):
    wide = layout_wide(spark, sf_dir, 0).drop("majornum")
    return S.default_majornum(wide).select("unitid", "cipcode", "awlevel", "year", "majornum")


@reg("read_completions", _read_year_sql(_layout_wide_sql()))
def q_read_completions(spark, sf_dir):
    """All four layouts as CSV files, each with its own columns in its own
    order, some with columns that are not known, read back in one call."""
    from equiscope.plans.yearly import read_completions

    root = FS.scratch_path(spark, "layouts")
    for i, w in enumerate(layouts_wide(spark, sf_dir)):
        known = [c.upper() if i % 2 else c for c in w.columns if c not in ("year", *(["majornum"] if i == 0 else []))]
        shift = 3 * i % len(known)
        order = [*known[shift:], *known[:shift]][:: -1 if i % 2 else 1]
        w = by_year(w.select(*order, F.lit("7").alias("CRACE24"), "year"))
        w.write.mode("append").partitionBy("year").option("header", True).csv(root)
    return read_completions(spark, root, hops(spark, sf_dir), taxonomy(spark, sf_dir), B.sql_df(spark, sf_dir, B.STEM_SQL, PART))


INST_MERGE_SQL = O.with_cte(("ev", B.EVENT_ATTRS_SQL)) + f"""
, latest AS (SELECT unitid, {', '.join(f"arg_max({c}, {ORDER_SQL}) FILTER (WHERE {c} IS NOT NULL) AS {c}" for c in ATTRS)},
  max(metadata_vintage) AS metadata_vintage FROM ev GROUP BY unitid)
SELECT *, regexp_matches(institution_name, '{I.TECH_PATTERN}') AS tech_school,
  regexp_matches(institution_name, '{I.HEALTH_PATTERN}') AS health_school FROM latest"""


@reg("institutions_merge", INST_MERGE_SQL)
def q_institutions_merge(spark, sf_dir):
    """Vintages -> latest non-null attributes per institution -> flags."""
    latest = I.latest_non_null(event_attrs(spark, sf_dir), "unitid", "metadata_vintage", "event_id", ATTRS)
    return latest.withColumns(
        {"tech_school": I.tech_school(F.col("institution_name")), "health_school": I.health_school(F.col("institution_name"))}
    )


@reg("stream_ingest_years", ORACLE["read_year"])
def q_stream_ingest_years(spark, sf_dir):
    """Structured Streaming ingestion of the yearly raw files reproduces the
    batch reader: the rule-derived wide rows are written as one CSV folder per
    year, picked up by the file stream and merged into the fact table."""
    from equiscope.streaming.ingest import start_ingest

    root = FS.scratch_path(spark, "stream")
    wide = wide_from(B.sql_df(spark, sf_dir, RAW_YEAR_LONG_SQL, FACT4))
    cols = ["unitid", "cipcode", "awlevel", "majornum", *POST]
    by_year(wide.select(*cols, "year")).write.partitionBy("year").option("header", True).csv(f"{root}/landing")
    q = start_ingest(spark, f"{root}/landing", cols, f"{root}/fact", f"{root}/ckpt", hops(spark, sf_dir),
                     taxonomy(spark, sf_dir), B.sql_df(spark, sf_dir, B.STEM_SQL, PART), S.POST_2010_CODES)
    q.awaitTermination()
    out = spark.read.parquet(f"{root}/fact")
    return out.select(
        "unitid", "cipcode", "awlevel", "majornum", "year", "cip2020", "race_ethnicity", "gender", "n_awards",
        "cip_title", "ncses_sci_group", "ncses_field_group", "ncses_detailed_field_group", "nsf_broad_field",
        "dhs_stem",
    )


# ---------------------------------------------------------------------------
# dictionaries, institution files, enum domains


@reg("scan_dictionary", """SELECT 'N' || CAST(n_regionkey AS VARCHAR) AS varname, CAST(n_nationkey AS VARCHAR) AS codevalue,
  n_name AS valuelabel FROM nation""")
def q_scan_dictionary(spark, sf_dir):
    path = FS.scratch_path(spark, "dictionary")
    n = read_table(spark, sf_dir, "nation").select(
        F.concat(F.lit("N"), F.col("n_regionkey").cast("string")).alias("VarName"),
        F.col("n_nationkey").cast("string").alias("CODEVALUE"), F.col("n_name").alias("valuelabel"))
    n.write.option("header", True).csv(path)
    return FS.read_lookup_csv(spark, path)


# one row per unit and vintage; the label of a code depends on the vintage
VINTAGES_SQL = """SELECT unitid, vintage, max(instnm) AS instnm, max(region) AS region, max(city) AS city FROM (
  SELECT user_id AS unitid, 2000 + CAST(event_id % 6 AS INTEGER) AS vintage,
    CASE WHEN event_type = 'signup' THEN 'Institute of Technology ' || CAST(event_id % 97 AS STRING)
         WHEN event_type = 'purchase' THEN 'Health Science Center ' || CAST(event_id % 89 AS STRING) END AS instnm,
    CAST(event_id % 7 AS STRING) AS region, CASE WHEN event_id % 6 < 3 THEN event_type END AS city
  FROM {events}) e GROUP BY unitid, vintage"""


@reg("institutions_pipeline", O.with_cte(("v", VINTAGES_SQL)) + """
, d AS (SELECT r_regionkey, r_name, y.vintage FROM region, (SELECT unnest([2000, 2001, 2002, 2003, 2004]) AS vintage) y),
l AS (SELECT v.*, CASE WHEN v.vintage = 2005 THEN v.region WHEN d.r_name IS NULL THEN NULL
    WHEN v.vintage < 2003 THEN d.r_name ELSE d.r_name || ' ' || v.vintage END AS label
  FROM v LEFT JOIN d ON v.region = CAST(d.r_regionkey AS VARCHAR) AND v.vintage = d.vintage),
m AS (SELECT unitid, arg_max(instnm, vintage) FILTER (WHERE instnm IS NOT NULL) AS institution_name,
  arg_max(label, vintage) FILTER (WHERE label IS NOT NULL) AS region_of_the_unit,
  arg_max(city, vintage) FILTER (WHERE city IS NOT NULL) AS city_name, CAST(max(vintage) AS INTEGER) AS metadata_vintage,
  arg_max(CASE WHEN instnm IS NOT NULL THEN regexp_matches(instnm, '%s') END, vintage) FILTER (WHERE instnm IS NOT NULL) AS tech_school,
  arg_max(CASE WHEN instnm IS NOT NULL THEN regexp_matches(instnm, '%s') END, vintage) FILTER (WHERE instnm IS NOT NULL) AS health_school
  FROM l GROUP BY unitid)
SELECT * FROM m""" % (I.TECH_PATTERN, I.HEALTH_PATTERN))
def q_institutions_pipeline(spark, sf_dir):
    """Vintage files of two layouts, a dictionary per vintage (of several
    entries the last wins; 2005 has none), titles by vintage."""
    from equiscope.plans.yearly import read_institutions

    root = FS.scratch_path(spark, "vintages")
    v = B.sql_df(spark, sf_dir, VINTAGES_SQL, ["events"]).select(
        F.col("unitid").alias("UNITID"), F.col("instnm").alias("INSTNM"), F.col("region").alias("OBEREG"), F.col("city").alias("CITY"), "vintage")
    old = v.filter("vintage < 2003").repartition("vintage")
    new = v.filter("vintage >= 2003").select("OBEREG", "INSTNM", "UNITID", "vintage").repartition("vintage")
    for part in (old, new):
        part.write.mode("append").partitionBy("vintage").option("header", True).option("encoding", "ISO-8859-1").csv(root)
    years = F.explode(F.array(*[F.lit(y) for y in range(2000, 2005)]))
    d = read_table(spark, sf_dir, "region").select("r_regionkey", "r_name", years.alias("metadata_vintage"))
    label = F.when(F.col("metadata_vintage") < 2003, F.col("r_name")).otherwise(F.concat("r_name", F.lit(" "), "metadata_vintage"))
    entry = [F.lit("OBEREG").alias("varname"), F.col("r_regionkey").cast("string").alias("codevalue")]
    d = d.select(*entry, F.lit("superseded").alias("valuelabel"), "metadata_vintage", F.lit(0).alias("pos")).union(
        d.select(*entry, F.concat(label, F.lit(".")), "metadata_vintage", F.lit(1)))
    names = spark.createDataFrame(
        [("OBEREG", "Old title", 2000), ("OBEREG", "Region of the unit", 2004), ("OBEREG", None, 2005), ("CITY", "City (name)", 2002)],
        "original_colname string, mapped_colname string, metadata_vintage int")
    return read_institutions(spark, root, d, names)


ENUM_COLUMNS = ["awlevel", "race_ethnicity", "gender", "ncses_sci_group", "ncses_field_group", "ncses_detailed_field_group",
                "nsf_broad_field", "cip_title"]


@reg("enum_domains_all", FACT_CTE + f"""
, u AS ({" UNION ALL ".join(f"SELECT '{c}' AS domain, {c} AS value FROM fact" for c in ENUM_COLUMNS)}
  UNION ALL SELECT 'code', cipcode FROM fact UNION ALL SELECT 'code', cip2020 FROM fact)
SELECT domain, value, count(*) OVER (PARTITION BY domain) AS domain_size FROM (SELECT DISTINCT domain, value FROM u WHERE value IS NOT NULL)""")
def q_enum_domains_all(spark, sf_dir):
    return P.enum_domains(completions_fact(spark, sf_dir), {**{c: [c] for c in ENUM_COLUMNS}, "code": ["cipcode", "cip2020"]})


@reg("filter_base_nulls", FACT_CTE + """
, f AS (SELECT *, CASE WHEN unitid % 5 = 0 THEN NULL ELSE race_ethnicity END AS r, CASE WHEN unitid % 7 = 0 THEN 'no such level' ELSE awlevel END AS a FROM fact)
SELECT r AS race_ethnicity, gender, CAST(sum(n_awards) AS BIGINT) AS n FROM f WHERE r IS NOT NULL AND a IN ('1-URGENT', '2-HIGH', '5-LOW')
  AND majornum IN (1, 2) AND year BETWEEN 1984 AND 2024 GROUP BY r, gender""")
def q_filter_base_nulls(spark, sf_dir):
    from equiscope.operators.filters import QueryFilters, apply_filters

    fact = completions_fact(spark, sf_dir).withColumns({
        "race_ethnicity": F.when(F.col("unitid") % 5 != 0, F.col("race_ethnicity")),
        "awlevel": F.when(F.col("unitid") % 7 == 0, "no such level").otherwise(F.col("awlevel")),
    })
    kept = apply_filters(fact, QueryFilters(strict=False, award_levels=["1-URGENT", "2-HIGH", "5-LOW"]))
    return kept.groupBy("race_ethnicity", "gender").agg(F.sum("n_awards").cast("long").alias("n"))
