import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from playlens import schemas  # noqa: E402
from playlens.session import session  # noqa: E402

SAMPLE = os.environ.get("SAMPLE_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark():
    spark = session("playlens-tests", "local[8]", **{
        "spark.ui.enabled": "false",
        "spark.sql.shuffle.partitions": "8",
        "spark.checkpoint.dir": tempfile.mkdtemp(prefix="playlens-tests-"),
    })
    spark.sparkContext.setLogLevel("ERROR")
    yield spark
    spark.stop()


@pytest.fixture
def base(tmp_path):
    return str(tmp_path)


# A plausible event; tests change the fields they are about.
EVENT = {
    "event_id": "e1", "event_timestamp": "2024-01-05T20:15:00.000001", "event_hour": 20,
    "event_day": "Friday", "event_month": 1, "is_prime_time": 1, "is_weekend": 0,
    "user_id": "u-1", "age_group": "25-34", "content_id": "c-1",
    "content_title": "First", "content_type": "Movie", "genre": "Drama",
    "language": "English", "action": "PLAY", "watch_duration_mins": 45,
    "total_duration_mins": 90, "completion_pct": 50.0, "is_completed": 0, "is_dropped": 0,
    "device_type": "Mobile", "device_os": "iOS", "city": "Lyon", "state": "Rhone",
    "region": "West", "subscription_plan": "BASIC", "subscription_price": 149,
}


@pytest.fixture
def events(spark):
    """``events({...}, {...})``: one event per dict of changed fields."""
    from decimal import Decimal

    def make(*changes):
        rows = []
        for i, change in enumerate(changes):
            row = {**EVENT, "event_id": f"e{i}", **change}
            if row["watch_duration_mins"] is not None:
                row["watch_duration_mins"] = Decimal(row["watch_duration_mins"])
            rows.append(tuple(row[f] for f in schemas.WATCH_EVENT.names))
        return spark.createDataFrame(rows, schemas.WATCH_EVENT)

    return make


def values(df, *columns):
    """Sorted tuples of the named (or all) columns."""
    rows = df.select(*columns).collect() if columns else df.collect()
    return sorted((tuple(r) for r in rows), key=repr)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()
