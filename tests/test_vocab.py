"""Closed vocabularies: hierarchy closure and grouping rules."""

from collections import Counter

from equiscope.vocab import (
    NCSES_HIERARCHY,
    AwardLevel,
    Grouping,
    NCSESDetailedFieldGroup,
    NCSESFieldGroup,
    NCSESSciGroup,
    RaceEthn,
)


def test_hierarchy_covers_each_value_once():
    assert set(NCSES_HIERARCHY) == set(NCSESSciGroup)
    fields = Counter(fg for groups in NCSES_HIERARCHY.values() for fg in groups)
    assert set(fields) == set(NCSESFieldGroup) and set(fields.values()) == {1}
    details = Counter(d for groups in NCSES_HIERARCHY.values() for ds in groups.values() for d in ds)
    assert set(details) == set(NCSESDetailedFieldGroup) and set(details.values()) == {1}


def test_grouping_rules():
    assert Grouping.gender.label_suffix == "within_gender"
    assert Grouping.intersectional.label_suffix == "intersectional"
    assert Grouping.intersectional.grouping_columns == ["race_ethnicity", "gender"]
    assert Grouping.intersectional.students_suffix == "students"
    assert len(RaceEthn) == 9
    assert len({a.value for a in AwardLevel}) == 13
