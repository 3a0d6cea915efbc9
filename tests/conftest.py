import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from millrace.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "tests",
        "local[8]",
        **{
            "spark.sql.shuffle.partitions": "8",
            "spark.python.sql.dataFrameDebugging.enabled": "false",
            "spark.driver.memory": "4g",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def root(spark):
    from millrace.session import fresh_path

    return fresh_path(spark, "test")


@pytest.fixture
def rows():
    """Rows of a DataFrame as a sorted list of tuples, nulls first."""

    def collect(df, *columns):
        df = df.select(*columns) if columns else df
        return sorted(
            (tuple(r) for r in df.collect()),
            key=lambda r: [(v is not None, str(v) if not isinstance(v, (int, float)) else "", v if isinstance(v, (int, float)) else 0) for v in r],
        )

    return collect
