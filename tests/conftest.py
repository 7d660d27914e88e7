import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))
sys.path.insert(0, str(Path(__file__).resolve().parent))

from admetrics import schemas  # noqa: E402
from admetrics.session import get_session  # noqa: E402

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = get_session(
        master="local[8]",
        **{
            "spark.sql.shuffle.partitions": "8",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": "6g",
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    return session


@pytest.fixture
def conf(spark):
    """Sets session options for one test."""
    before = {}

    def put(**options):
        for key, value in options.items():
            key = key.replace("__", ".")
            before.setdefault(key, spark.conf.get(key, None))
            spark.conf.set(key, value)

    yield put
    for key, value in before.items():
        if value is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, value)


_DEFAULTS = {
    "timestamp": "2024-01-01T00:00:00Z",
    "campaign_id": "C1",
    "campaign_name": "One",
    "campaign_type": "conversion",
    "advertiser": "A",
    "platform": "Google",
    "channel": "Google Search",
    "date": "2024-01-01",
    "impressions": 100,
    "clicks": 10,
    "conversions": 1,
    "spend_usd": 5.0,
    "revenue_usd": 10.0,
}


@pytest.fixture
def events(spark):
    """Builds raw events; only what differs from the defaults is stated."""

    def build(*rows):
        full = [{"event_id": f"e{i}", **_DEFAULTS, **row} for i, row in enumerate(rows)]
        data = [tuple(row[c] for c in schemas.RAW.names) for row in full]
        return spark.createDataFrame(data, schemas.RAW)

    return build


def by_id(df, *columns):
    rows = df.select("event_id", *columns).collect()
    if len(columns) == 1:
        return {r.event_id: r[1] for r in rows}
    return {r.event_id: tuple(r)[1:] for r in rows}
