import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"
SF_MAIN = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from pricetrend.session import get_session
    s = get_session(app="pricetrend-tests", master="local[4]", shuffle_partitions=4,
                    extra={"spark.checkpoint.dir": tempfile.mkdtemp(prefix="pt-ckpt-")})
    yield s
    s.stop()


def micro_bars(spark, series: dict[str, list[tuple[float, float, float]]]):
    """Bars from (high, low, close) lists, one hourly bar per element."""
    import datetime as dt
    rows = []
    t0 = dt.datetime(2024, 1, 1)
    for sym, vals in series.items():
        for i, (h, l, c) in enumerate(vals):
            rows.append((sym, t0 + dt.timedelta(hours=i), float(c), float(h), float(l), float(c)))
    return spark.createDataFrame(
        rows, "symbol string, bar_ts timestamp_ntz, open double, high double, low double, close double")
