import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from wardlake import session  # noqa: E402
from wardlake.sources.tables import TableStore  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    spark = session.build("local[8]", 4)
    spark.sparkContext.setLogLevel("ERROR")
    yield spark
    spark.stop()


@pytest.fixture
def store(spark, tmp_path):
    return TableStore(spark, str(tmp_path / "lake"))


def rows(df, *cols):
    """Rows as a sorted list of tuples."""
    picked = df.select(*cols) if cols else df
    return sorted((tuple(r) for r in picked.collect()), key=str)


@pytest.fixture
def tuples():
    return rows
