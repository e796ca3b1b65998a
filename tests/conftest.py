import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from tidemark.session import local_session
    s = local_session(cpus=8, shuffle_partitions=8, app="tidemark-tests")
    yield s
    s.stop()


def bars_df(spark, rows, symbol="AAPL"):
    """rows: list of (date-string, open, high, low, close, volume)."""
    import datetime as dt
    data = [(symbol, dt.date.fromisoformat(d), o, h, lo, c, v) for d, o, h, lo, c, v in rows]
    from tidemark.schemas import BARS
    return spark.createDataFrame(data, BARS)


def series(spark, closes, symbol="AAPL", start="2024-01-01", volume=1000):
    import datetime as dt
    d0 = dt.date.fromisoformat(start)
    rows = [((d0 + dt.timedelta(days=i)).isoformat(), c, c, c, c, volume) for i, c in enumerate(closes)]
    return bars_df(spark, rows, symbol)
