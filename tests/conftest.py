import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tests.sessions import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session()
    yield session
    session.stop()


@pytest.fixture
def tables(spark, tmp_path):
    from panelspark.sources.tables import Tables

    return Tables(spark, str(tmp_path / "tables"))


@pytest.fixture
def rows():
    """Rows of a frame as a sorted list of tuples."""

    def collect(df, *cols):
        picked = df.select(*cols) if cols else df
        return sorted((tuple(r) for r in picked.collect()), key=repr)

    return collect
