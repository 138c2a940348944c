"""Wide yearly count files -> tidy award rows.

Raw completion files carry one string column per (race, gender) code.  The
code set depends on the survey vintage; the choice follows the columns
present (derived ``dv*`` columns -> interim set; ``crace*`` columns -> the
two-column gender-only set when only two measure columns exist, else the
pre-2010 set; otherwise the post-2010 set).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from equiscope.vocab import AwardLevel, Gender, RaceEthn

_R, _G = RaceEthn, Gender

# Measure-column codes of the raw survey files -> (race, gender).
PRE_1995_GENDERONLY_CODES = {
    "crace15": (_R.unknown, _G.men),
    "crace16": (_R.unknown, _G.women),
}
PRE_2010_CODES = {
    "crace01": (_R.nonres, _G.men),
    "crace02": (_R.nonres, _G.women),
    "crace03": (_R.black_or_aa, _G.men),
    "crace04": (_R.black_or_aa, _G.women),
    "crace05": (_R.american_indian, _G.men),
    "crace06": (_R.american_indian, _G.women),
    "crace07": (_R.asian, _G.men),
    "crace08": (_R.asian, _G.women),
    "crace09": (_R.hispanic, _G.men),
    "crace10": (_R.hispanic, _G.women),
    "crace11": (_R.white, _G.men),
    "crace12": (_R.white, _G.women),
    "crace13": (_R.unknown, _G.men),
    "crace14": (_R.unknown, _G.women),
}
INTERIM_CODES = {
    "cunknm": (_R.unknown, _G.men),
    "cunknw": (_R.unknown, _G.women),
    "cnralm": (_R.nonres, _G.men),
    "cnralw": (_R.nonres, _G.women),
    "dvcaim": (_R.american_indian, _G.men),
    "dvcaiw": (_R.american_indian, _G.women),
    "dvcapm": (_R.asian, _G.men),
    "dvcapw": (_R.asian, _G.women),
    "dvcbkm": (_R.black_or_aa, _G.men),
    "dvcbkw": (_R.black_or_aa, _G.women),
    "dvchsm": (_R.hispanic, _G.men),
    "dvchsw": (_R.hispanic, _G.women),
    "dvcwhm": (_R.white, _G.men),
    "dvcwhw": (_R.white, _G.women),
}
POST_2010_CODES = {
    "cunknm": (_R.unknown, _G.men),
    "cunknw": (_R.unknown, _G.women),
    "cnralm": (_R.nonres, _G.men),
    "cnralw": (_R.nonres, _G.women),
    "caianm": (_R.american_indian, _G.men),
    "caianw": (_R.american_indian, _G.women),
    "casiam": (_R.asian, _G.men),
    "casiaw": (_R.asian, _G.women),
    "cbkaam": (_R.black_or_aa, _G.men),
    "cbkaaw": (_R.black_or_aa, _G.women),
    "chispm": (_R.hispanic, _G.men),
    "chispw": (_R.hispanic, _G.women),
    "cnhpim": (_R.hawaiian_pi, _G.men),
    "cnhpiw": (_R.hawaiian_pi, _G.women),
    "cwhitm": (_R.white, _G.men),
    "cwhitw": (_R.white, _G.women),
    "c2morm": (_R.two_or_more, _G.men),
    "c2morw": (_R.two_or_more, _G.women),
}
ALL_CODES = {**PRE_2010_CODES, **INTERIM_CODES, **POST_2010_CODES, **PRE_1995_GENDERONLY_CODES}

# Award level codes -> labels (first-professional degrees count
# as professional doctorates, first-professional certificates as
# post-master's certificates).
AWARD_LEVEL_CODES = {
    -1: AwardLevel.unknown,
    1: AwardLevel.lt1,
    2: AwardLevel.gt1_lt2,
    3: AwardLevel.associates,
    4: AwardLevel.gt2_lt4,
    5: AwardLevel.bachelors,
    6: AwardLevel.postbac,
    7: AwardLevel.masters,
    8: AwardLevel.postmas,
    9: AwardLevel.doctor_research,
    10: AwardLevel.doctor_professional,
    11: AwardLevel.postmas,
    17: AwardLevel.doctor_research,
    18: AwardLevel.doctor_professional,
    19: AwardLevel.doctor_other,
    20: AwardLevel.lt_12w,
    21: AwardLevel.gt_12w_lt_1y,
}

INDEX_COLS = ["unitid", "cipcode", "awlevel", "majornum"]
TOTAL_CODES = ("99.0000", "99")


def choose_code_set(measure_columns: Sequence[str]) -> dict:
    """Pick the code set from the measure column names (schema-level, driver)."""
    cols = list(measure_columns)
    if any(c.startswith("dv") for c in cols):
        return INTERIM_CODES
    if any(c.startswith("crace") for c in cols):
        return PRE_1995_GENDERONLY_CODES if len(cols) == 2 else PRE_2010_CODES
    return POST_2010_CODES


def unpivot_groups(
    df: DataFrame, ids: Sequence[str], code_set: dict | None = None, measure: str = "n_awards"
) -> DataFrame:
    """Wide count columns -> rows (ids..., race_ethnicity, gender, measure).

    NULL cells are kept; measure columns outside the code set are ignored; a
    code-set column missing from ``df`` is an error."""
    ids = list(ids)
    measures = [c for c in df.columns if c not in ids]
    code_set = code_set or choose_code_set(measures)
    missing = [c for c in code_set if c not in df.columns]
    if missing:
        raise KeyError(f"expected measure columns missing: {missing}")
    cells = [
        F.struct(F.lit(r.value).alias("race_ethnicity"), F.lit(g.value).alias("gender"), F.col(c).cast("string").alias(measure))
        for c, (r, g) in code_set.items()
    ]
    # labels stand in the cells, so no row looks its code up
    return df.select(*ids, F.inline(F.array(*cells)))


def pivot_codes(long: DataFrame, ids: Sequence[str], code: str, codes: dict, measure: str = "n_awards") -> DataFrame:
    """Long rows -> one row per ``ids`` with the sum of ``measure`` per code
    (``codes``: value of ``code`` -> column name; NULL where a code has no rows).

    All sums are taken in one aggregate, so rows are shuffled once; ``pivot``
    shuffles by (ids, code) and then again by the ids."""
    sums = [F.sum(F.when(F.col(code) == k, F.col(measure))).alias(name) for k, name in codes.items()]
    return long.groupBy(*ids).agg(*sums)


def filter_zero(df: DataFrame, measure: str = "n_awards") -> DataFrame:
    """Drop cells whose raw text is exactly "0" (NULL cells are kept)."""
    return df.filter(~F.col(measure).eqNullSafe(F.lit("0")))


def filter_total_codes(df: DataFrame, code: str = "cipcode") -> DataFrame:
    """Drop the all-fields total rows (code 99.0000 or 99); NULL kept."""
    return df.filter(~F.coalesce(F.col(code).isin(list(TOTAL_CODES)), F.lit(False)))


def normalise_code(code: Column, year: Column) -> Column:
    """Trim; for surveys up to 1986 (codes without a dot) left-pad 5-char
    codes with 0 and insert the dot after two digits."""
    c = F.trim(code)
    padded = F.when(F.length(c) == 5, F.concat(F.lit("0"), c)).otherwise(c)
    dotted = F.concat(F.substring(padded, 1, 2), F.lit("."), F.substring(padded, 3, 1 << 20))
    return F.when(year <= 1986, dotted).otherwise(c)


def map_award_level(code: Column) -> Column:
    """Integer award level code -> label; unknown codes -> "Unknown".
    Non-integer text raises (as an integer cast of the raw column would)."""
    lut = F.create_map(*[x for k, v in AWARD_LEVEL_CODES.items() for x in (F.lit(k), F.lit(v.value))])
    return F.coalesce(lut[code.cast("int")], F.lit(AwardLevel.unknown.value))


def default_majornum(df: DataFrame) -> DataFrame:
    """Ensure an integer ``majornum`` column (1 when the file has none)."""
    if "majornum" in df.columns:
        return df.withColumn("majornum", F.col("majornum").cast("int"))
    return df.withColumn("majornum", F.lit(1))


def project_known_columns(df: DataFrame, extra: Sequence[str] = ()) -> DataFrame:
    """Keep index columns, ``extra`` ones and known measure columns (names
    already cleaned)."""
    missing = [c for c in INDEX_COLS if c not in df.columns]
    if missing:
        raise KeyError(f"index columns missing: {missing}")
    return df.select(*[c for c in df.columns if c in INDEX_COLS or c in ALL_CODES or c in extra])
