import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

from equiscope.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    yield build_session("local[4]", shuffle_partitions=4)


@pytest.fixture(scope="session")
def sf():
    return "/root/testdata/sf0.001"


DOC_SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def docs_of(spark):
    """A documents table of the given (id, text[, lang]) rows."""

    def make(rows, extra=None):
        full = [(r[0], r[1], r[2] if len(r) > 2 else "en", "s", len(r[1] or "")) for r in rows]
        df = spark.createDataFrame(full, DOC_SCHEMA)
        return df

    return make
