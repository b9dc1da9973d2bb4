import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from commerce_lens.session import clear_scratch, local_session

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = local_session(8, shuffle_partitions=4, app="commerce-lens-tests")
    yield session
    clear_scratch(session)
    session.stop()


@pytest.fixture
def frame(spark):
    """A DataFrame from rows and a DDL schema."""

    def make(schema, *rows):
        return spark.createDataFrame(list(rows), schema)

    return make


def rows(df, *columns):
    """Rows as sorted tuples."""
    picked = df.select(*columns) if columns else df
    return sorted((tuple(r) for r in picked.collect()), key=lambda r: [(x is not None, str(type(x)), x) for x in r])


def plan(df):
    """The physical plan as text."""
    return df._sc._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "simple")
