import datetime as dt
import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from quotemill.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    base = tmp_path_factory.mktemp("spark")
    session = local_session(
        "quotemill-tests",
        cores="4",
        shuffle_partitions=4,
        **{
            "spark.sql.warehouse.dir": str(base / "warehouse"),
            "spark.driver.memory": "4g",
        },
    )
    yield session
    session.stop()


def day(text):
    return dt.date.fromisoformat(text)


def rows(df, *columns):
    """Collected rows as a sorted list of tuples."""
    data = df.select(*columns).collect() if columns else df.collect()
    return sorted((tuple(r) for r in data), key=lambda t: [(v is not None, v) for v in t])
