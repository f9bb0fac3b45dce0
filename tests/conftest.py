import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from telemetra.session import build_session, use_time_zone  # noqa: E402


@pytest.fixture(scope="session")
def session():
    spark = build_session(
        "tests",
        "local[4]",
        settings={
            "spark.sql.shuffle.partitions": "4",
            "spark.driver.memory": "4g",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    yield spark
    spark.stop()


@pytest.fixture
def spark(session):
    use_time_zone(session, "UTC")
    return session


@pytest.fixture
def spark_utc8(session):
    """The zone all keys of the message fixtures are written in."""
    use_time_zone(session, "Asia/Shanghai")
    yield session
    use_time_zone(session, "UTC")


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def as_dict(df, *keys):
    return {tuple(r[k] for k in keys): r for r in df.collect()}
