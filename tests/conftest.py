import datetime as dt
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from signalloom.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    folder = tmp_path_factory.mktemp("shared")
    session = build_session(
        "signalloom-tests",
        "local[4]",
        **{
            "spark.checkpoint.dir": str(folder),
            "spark.sql.shuffle.partitions": "3",
            "spark.ui.enabled": "false",
            "spark.driver.memory": "4g",
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


NOW = dt.datetime(2024, 3, 10, 12, 0, 0)


@pytest.fixture
def now():
    return NOW


def ago(**parts):
    """Naive UTC time that long before NOW."""
    return NOW - dt.timedelta(**parts)


def rows(df, *columns):
    out = df.select(*columns) if columns else df
    return sorted((tuple(r) for r in out.collect()), key=lambda r: tuple((v is None, str(v)) for v in r))


def plan_of(df):
    return df._jdf.queryExecution().explainString(
        df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    )
