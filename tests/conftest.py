import sys
from pathlib import Path

import pytest

sys.path[:0] = [str(Path(__file__).resolve().parents[1]), str(Path(__file__).resolve().parent)]

from goldseam.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    home = tmp_path_factory.mktemp("spark")
    session = build_session(
        "goldseam-tests",
        "local[4]",
        **{
            "spark.sql.shuffle.partitions": "4",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": "4g",
            "spark.sql.warehouse.dir": str(home / "warehouse"),
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    session.sql("CREATE DATABASE IF NOT EXISTS layers")
    yield session
    session.stop()


@pytest.fixture
def frame(spark):
    """frame(rows, ddl) -> DataFrame"""
    return lambda rows, ddl: spark.createDataFrame(rows, ddl)


@pytest.fixture
def values():
    """Rows as sorted tuples, None first."""

    def key(row):
        return tuple((v is not None, str(type(v)), v if v is not None else 0) for v in row)

    return lambda df: sorted((tuple(r) for r in df.collect()), key=key)


@pytest.fixture
def plan():
    """The physical plan of a frame as text; the final one when it has been run."""

    def text(df, run=False):
        if run:
            df.collect()
        return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]

    return text
