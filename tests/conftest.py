import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from vitrine.schemas import EVENT_COLUMNS, EVENT_SCHEMA  # noqa: E402
from vitrine.session import build_session  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    return build_session("local[4]", 8, app_name="vitrine-tests")


def make_events(spark, rows: list[dict]):
    """Hand-made events: dicts with any subset of the event columns."""
    data = [tuple(r.get(c) for c in EVENT_COLUMNS) for r in rows]
    return spark.createDataFrame(data, EVENT_SCHEMA)


@pytest.fixture
def events_of(spark):
    return lambda rows: make_events(spark, rows)
