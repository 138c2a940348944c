import os
import sys
import warnings

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from equiscope.session import build_session  # noqa: E402
from equiscope.vocab import (  # noqa: E402
    END_YEAR,
    START_YEAR,
    AwardLevel,
    Gender,
    NCSESDetailedFieldGroup,
    NCSESFieldGroup,
    NCSESSciGroup,
    NSFBroadField,
    RaceEthn,
)

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    s = build_session("local[4]", shuffle_partitions=4)
    yield s


FIELDS = [
    # code, title, sci, field, detailed, nsf, stem
    ("27.0101", "Mathematics, General", NCSESSciGroup.sci, NCSESFieldGroup.math_cs,
     NCSESDetailedFieldGroup.math_stats, NSFBroadField.math_cs, True),
    ("42.2706", "Behavioral Neuroscience", NCSESSciGroup.non_sci, NCSESFieldGroup.psych,
     NCSESDetailedFieldGroup.psych, NSFBroadField.soc_behav_sci, True),
    ("23.0801", "English Literature (British And Commonwealth)", NCSESSciGroup.unknown,
     NCSESFieldGroup.humanities, NCSESDetailedFieldGroup.english_lit, NSFBroadField.non_stem, False),
]
RACES = [RaceEthn.black_or_aa, RaceEthn.asian, RaceEthn.hispanic]
GENDERS = [Gender.women, Gender.men]


def fixture_rows():
    rows = []
    for unitid in (1, 2):
        for year in (START_YEAR, END_YEAR):
            for code, title, sg, fg, dg, bf, stem in FIELDS:
                for r in RACES:
                    for g in GENDERS:
                        rows.append((year, unitid, code, AwardLevel.bachelors.value, 1, code, r.value, g.value, 1,
                                     title, sg.value, fg.value, dg.value, bf.value, stem))
    return rows


@pytest.fixture(scope="session")
def fixture_fact(spark):
    from equiscope.sources.files import FACT_SCHEMA

    return spark.createDataFrame(fixture_rows(), FACT_SCHEMA)


@pytest.fixture(scope="session")
def fixture_engine(spark, fixture_fact):
    from equiscope.plans.engine import CompletionsEngine

    inst = spark.createDataFrame([(1, "University 1"), (2, "University 2")], "unitid long, institution_name string")
    return CompletionsEngine(spark, fixture_fact, inst)


@pytest.fixture
def all_filters():
    with warnings.catch_warnings():
        warnings.simplefilter("ignore")
        from equiscope.operators.filters import QueryFilters

        return QueryFilters()
