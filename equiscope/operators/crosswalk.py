"""Code crosswalks and field classification.

A crosswalk *hop* maps codes of one vintage to the next; the *chain* walks a
code forward through every hop whose range ends at or after the row's year,
so a 1990 code passes through the first two hops, a 2015 code only the last.

The hops of the chain are composed to one table over (first hop, code), which
is bounded by the code vocabulary times the hops, and the data is joined to it
once, instead of once per hop.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from equiscope.operators.lookup import lookup_side, last_wins
from equiscope.vocab import (
    NSF_BROAD_FIELD_MAP,
    UNKNOWN_TITLE,
    NCSESDetailedFieldGroup,
    NCSESFieldGroup,
    NCSESSciGroup,
    NSFBroadField,
)

# ---------------------------------------------------------------------------
# loaders (raw crosswalk rows -> code map + title map)


def strip_wrapper(c: Column | str) -> Column:
    """Remove spreadsheet text wrappers: leading/trailing ``=`` and ``"``."""
    c = F.col(c) if isinstance(c, str) else c
    return F.regexp_replace(c, r'^[="]+|[="]+$', "")


@dataclass
class Hop:
    """One crosswalk step valid for survey years ``start..end``.

    ``codes``: (origin_code, dest_code); ``titles``: (code, title)."""

    start: int
    end: int
    codes: DataFrame
    titles: DataFrame


def load_moved_crosswalk(
    raw: DataFrame, origin: str, dest: str, title: str, action: str, pos: str, start: int, end: int
) -> Hop:
    """Loader for the modern crosswalk format: codes wrapped as ``="..."``,
    code map from rows whose action is "moved to" (any case), titles from
    rows whose title is not marked Deleted, titles stripped of ``.``;
    duplicates: the last row (highest ``pos``) wins."""
    r = raw.select(
        strip_wrapper(origin).alias("origin_code"),
        strip_wrapper(dest).alias("dest_code"),
        F.col(title).alias("title"),
        F.col(action).alias("action"),
        F.col(pos).alias("pos"),
    )
    moved = r.filter(F.lower(F.col("action")) == "moved to")
    codes = last_wins(moved, "origin_code", ["dest_code"], "pos")
    named = r.filter(~F.col("title").contains("Deleted")).withColumn("title", F.btrim("title", F.lit(".")))
    titles = last_wins(named, "dest_code", ["title"], "pos", out_key="code")
    return Hop(start, end, codes, titles)


def load_legacy_crosswalk(
    sources: Sequence[DataFrame],
    origin: str,
    dest: str,
    title: str,
    pos: str,
    start: int,
    end: int,
    corrections: dict[str, str] | None = None,
) -> Hop:
    """Loader for the older format.  The last source is the main one and wins:
    its rows need both codes, a title not marked Deleted, a destination that is
    not a "Report as"/"Deleted" note and that differs from the origin.  Earlier
    sources fill in what it lacks and need both codes only, so their rows that
    map a code to itself give that code its title.  Within a source the last
    row wins.  ``corrections`` override the code map."""
    parts = []
    for prio, src in enumerate(sources):
        part = src.select(
            F.col(origin).alias("origin_code"),
            F.col(dest).alias("dest_code"),
            F.col(title).alias("title"),
            F.struct(F.lit(prio).alias("p"), F.col(pos).alias("q")).alias("pos"),
        ).filter("origin_code is not null and dest_code is not null")
        if prio == len(sources) - 1:
            part = part.filter(
                ~F.coalesce(F.col("title").contains("Deleted"), F.lit(False))
                & ~F.col("dest_code").contains("Report")
                & ~F.col("dest_code").contains("Deleted")
                & (F.col("origin_code") != F.col("dest_code"))
            )
        parts.append(part)
    r = parts[0]
    for p in parts[1:]:
        r = r.unionByName(p)
    codes = last_wins(r, "origin_code", ["dest_code"], "pos")
    if corrections:
        spark = r.sparkSession
        fix = spark.createDataFrame(list(corrections.items()), "origin_code string, dest_code string")
        codes = codes.join(fix.select("origin_code"), "origin_code", "left_anti").unionByName(fix)
    titles = last_wins(r, "dest_code", ["title"], "pos", out_key="code")
    return Hop(start, end, codes, titles)


# ---------------------------------------------------------------------------
# hop / chain


def crosswalk_hop(
    df: DataFrame, hop: Hop, code: str, title: str | None = None, guard: Column | None = None,
    titled: Column | None = None,
) -> DataFrame:
    """Apply one hop to ``code`` (and ``title``) on rows where ``guard`` holds.

    new code  = map[code] if mapped else code
    new title = title_map[old code] if mapped else old title   (row already titled)
              = title_map[new code]                             (row not titled yet)

    ``titled`` tells per row whether a title exists already (default: a title
    column was given).  Without ``title`` a ``title`` column named
    ``<code>_title`` is created.
    """
    g = F.lit(True) if guard is None else guard
    out_title = title or f"{code}_title"
    has = (F.lit(title is not None) if titled is None else titled)
    cm = lookup_side(hop.codes.select(F.col("origin_code").alias("__o"), F.col("dest_code").alias("__d")))
    tm = lookup_side(hop.titles.select(F.col("code").alias("__tc"), F.col("title").alias("__tt")))
    tn = tm.select(F.col("__tc").alias("__nc"), F.col("__tt").alias("__nt"))
    j = df.join(cm, df[code] == F.col("__o"), "left").join(tm, F.col(code) == F.col("__tc"), "left")
    new_code = F.coalesce(F.col("__d"), F.col(code))
    j = j.withColumn("__new", new_code).join(tn, F.col("__new") == F.col("__nc"), "left")
    old_title = F.col(title) if title is not None else F.lit(None).cast("string")
    new_title = F.when(has, F.coalesce(F.col("__tt"), old_title)).otherwise(F.col("__nt"))
    j = j.withColumns(
        {
            code: F.when(g, F.col("__new")).otherwise(F.col(code)),
            out_title: F.when(g, new_title).otherwise(old_title),
        }
    )
    return j.drop("__o", "__d", "__tc", "__tt", "__nc", "__nt", "__new")


def composed_hops(hops: Sequence[Hop], titled: bool) -> DataFrame:
    """(__until, __from, __code, __title): where a code of a survey year ends
    up after all its hops.

    ``__until`` is the last year of the hop that the walk starts with; codes
    that no hop table mentions are not listed (they stay as they are).  The
    table has at most (codes in the hop tables) x (hops) rows and is made from
    the hop tables alone, without a look at the data."""
    hops = sorted(hops, key=lambda h: h.start)
    codes = None
    for h in hops:
        named = h.codes.select(F.col("origin_code").alias("__from")).union(h.titles.select("code"))
        codes = named if codes is None else codes.union(named)
    ends = sorted({h.end for h in hops})
    w = codes.filter("__from is not null").distinct().select(
        F.explode(F.array(*[F.lit(e) for e in ends])).alias("__until"), "__from",
        F.col("__from").alias("__code"), F.lit(None).cast("string").alias("__title"), F.lit(titled).alias("__titled"),
    )
    for h in hops:
        guard = F.col("__until") <= h.end
        w = crosswalk_hop(w, h, "__code", "__title", guard, titled=F.col("__titled"))
        w = w.withColumn("__titled", F.col("__titled") | guard)
    return w.drop("__titled")


def crosswalk_chain(
    df: DataFrame,
    hops: Sequence[Hop],
    code: str = "cipcode",
    year: str = "year",
    out_code: str = "cip2020",
    out_title: str | None = "cip2020_title",
    title: str | None = None,
    broadcast: bool = True,
) -> DataFrame:
    """Walk ``code`` forward to the newest vintage.

    Hops are applied in order of their start year, each only to rows with
    ``year <= hop.end``; years before the first hop's start raise an error.
    The hops are composed to one table first (:func:`composed_hops`), so the
    data meets a single broadcast join and is neither shuffled nor read
    twice."""
    first = min(h.start for h in hops)
    until = F.lit(None).cast("int")
    for end in sorted({h.end for h in hops}, reverse=True):
        until = F.when(F.col(year) <= end, end).otherwise(until)
    until = F.when(
        F.col(year) < first, F.raise_error(F.lit(f"Year provided must be at least {first}")).cast("int")
    ).otherwise(until)
    walked = lookup_side(composed_hops(hops, title is not None), broadcast)
    j = df.withColumn("__year_until", until)
    j = j.join(walked, (j["__year_until"] == walked["__until"]) & (j[code] == walked["__from"]), "left")
    outs = {out_code: F.coalesce(F.col("__code"), F.col(code))}
    if out_title:
        outs[out_title] = F.coalesce(F.col("__title"), F.col(title)) if title else F.col("__title")
    return j.withColumns(outs).drop("__year_until", "__until", "__from", "__code", "__title")


# ---------------------------------------------------------------------------
# classification

# Codes missing from the published taxonomy table, with their
# titles and (sci group, field group, detailed group) labels.
MISSING_CODES = {
    "03.0405": ("Logging/Timber Harvesting", NCSESSciGroup.sci, NCSESFieldGroup.sci_life_sci, NCSESDetailedFieldGroup.ag_sci),
    "15.1799": ("Energy Systems Technologies/Technicians, Other", NCSESSciGroup.non_sci, NCSESFieldGroup.sci_eng_technologies, NCSESDetailedFieldGroup.engineering_technologies),
    "16.1402": ("Indonesian/Malay Languages and Literatures", NCSESSciGroup.non_sci, NCSESFieldGroup.humanities, NCSESDetailedFieldGroup.languages),
    "51.2404": ("Veterinary Medicine (DVM)", NCSESSciGroup.non_sci, NCSESFieldGroup.nonsci_life_sci, NCSESDetailedFieldGroup.medical_sci),
    "51.3205": ("History of Medicine", NCSESSciGroup.sci, NCSESFieldGroup.social_sciences, NCSESDetailedFieldGroup.social_sci_other),
    "20.0102": ("Child Development, Care & Guidance", NCSESSciGroup.non_sci, NCSESFieldGroup.home_ec, NCSESDetailedFieldGroup.home_ec),
    "07.0608": ("Word Processing", NCSESSciGroup.non_sci, NCSESFieldGroup.business_and_mgmt, NCSESDetailedFieldGroup.business_and_mgmt),
}

TOTAL_ROW_PREFIX = "Total for selected values"


def missing_codes_frame(spark) -> DataFrame:
    rows = [(k, t, sg.value, fg.value, dg.value) for k, (t, sg, fg, dg) in MISSING_CODES.items()]
    return spark.createDataFrame(
        rows,
        "code string, title string, ncses_sci_group string, ncses_field_group string, "
        "ncses_detailed_field_group string",
    )


def load_taxonomy(raw: DataFrame, sci: str, field: str, detailed: str, cip_string: str, pos: str) -> DataFrame:
    """Taxonomy table from the published layout: drop the "Total for selected
    values" rows, relabel Life Sciences outside S&E as "Life Sciences
    (Non-S&E)", split ``"code - title"`` (title stripped of spaces and dots);
    duplicate codes: last row wins."""
    from equiscope.functions.strings import split_code_title

    r = raw.filter(~F.col(cip_string).startswith(TOTAL_ROW_PREFIX))
    nonsci_life = (F.col(sci) == NCSESSciGroup.non_sci.value) & (F.col(field) == NCSESFieldGroup.sci_life_sci.value)
    code, title = split_code_title(F.col(cip_string))
    r = r.select(
        code.alias("code"),
        title.alias("title"),
        F.col(sci).alias("ncses_sci_group"),
        F.when(nonsci_life, F.lit(NCSESFieldGroup.nonsci_life_sci.value)).otherwise(F.col(field)).alias("ncses_field_group"),
        F.col(detailed).alias("ncses_detailed_field_group"),
        F.col(pos).alias("pos"),
    )
    return last_wins(r, "code", ["title", "ncses_sci_group", "ncses_field_group", "ncses_detailed_field_group"], "pos")


def taxonomy_lookup(table: DataFrame, overrides: DataFrame | None = None) -> DataFrame:
    """Code -> (title, sci group, field group, detailed group, nsf field).

    ``table`` columns: code, title, ncses_sci_group, ncses_field_group,
    ncses_detailed_field_group.  Override rows replace table rows with the
    same code.  The NSF broad field comes from the field group, else from the
    sci group (fixed map in :mod:`equiscope.vocab`)."""
    cols = ["code", "title", "ncses_sci_group", "ncses_field_group", "ncses_detailed_field_group"]
    t = table.select(*cols)
    if overrides is not None:
        o = overrides.select(*cols)
        t = t.join(o.select("code"), "code", "left_anti").unionByName(o)
    nsf = F.create_map(*[F.lit(x) for kv in NSF_BROAD_FIELD_MAP.items() for x in kv])
    return t.withColumn(
        "nsf_broad_field",
        F.coalesce(nsf[F.col("ncses_field_group")], nsf[F.col("ncses_sci_group")]),
    )


def classify_taxonomy(df: DataFrame, lookup: DataFrame, original: str = "cipcode", current: str | None = "cip2020") -> DataFrame:
    """Add cip_title and the four taxonomy columns; prefer the classification
    of the current code, fall back level by level to the original code, then
    to the "unknown" labels."""
    levels = ["title", "ncses_sci_group", "ncses_field_group", "ncses_detailed_field_group", "nsf_broad_field"]
    lk = lookup_side(lookup.select("code", *levels))
    o = lk.select(F.col("code").alias("__oc"), *[F.col(c).alias("__o_" + c) for c in levels])
    j = df.join(o, df[original] == F.col("__oc"), "left")
    if current is not None:
        c = lk.select(F.col("code").alias("__cc"), *[F.col(x).alias("__c_" + x) for x in levels])
        j = j.join(c, j[current] == F.col("__cc"), "left")
    unknown = {
        "title": UNKNOWN_TITLE,
        "ncses_sci_group": NCSESSciGroup.unknown.value,
        "ncses_field_group": NCSESFieldGroup.unknown.value,
        "ncses_detailed_field_group": NCSESDetailedFieldGroup.unknown.value,
        "nsf_broad_field": NSFBroadField.unknown.value,
    }
    out = {}
    for lvl in levels:
        parts = ([F.col("__c_" + lvl)] if current is not None else []) + [F.col("__o_" + lvl), F.lit(unknown[lvl])]
        out["cip_title" if lvl == "title" else lvl] = F.coalesce(*parts)
    drop = ["__oc", "__cc"] + ["__o_" + x for x in levels] + ["__c_" + x for x in levels]
    return j.withColumns(out).drop(*[d for d in drop if d in j.columns])


def lookup_titles(df: DataFrame, lookup: DataFrame, code: str, out: str = "cip_title", fill_na: bool = True) -> DataFrame:
    t = lookup_side(lookup.select(F.col("code").alias("__k"), F.col("title").alias("__t")))
    j = df.join(t, df[code] == F.col("__k"), "left")
    v = F.coalesce(F.col("__t"), F.lit(UNKNOWN_TITLE)) if fill_na else F.col("__t")
    return j.withColumn(out, v).drop("__k", "__t")


def classify_stem(df: DataFrame, stem_codes: DataFrame, code: str = "cip2020", out: str = "dhs_stem") -> DataFrame:
    """Membership flag (never NULL): code in the STEM list."""
    s = lookup_side(stem_codes.select(F.col("code").alias("__s")).distinct())
    j = df.join(s, df[code] == F.col("__s"), "left")
    return j.withColumn(out, F.col("__s").isNotNull()).drop("__s")
