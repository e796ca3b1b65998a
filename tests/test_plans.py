"""Physical-plan shape: the properties the design relies on at scale."""

from tests.conftest import SF_SMALL, series
from tidemark.operators.indicators import add_indicators
from tidemark.sources.bars import bars_from, load_bars


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_indicators_share_one_exchange(spark):
    p = plan(add_indicators(series(spark, [1.0 + i for i in range(30)])))
    assert p.count("Exchange hashpartitioning(symbol") == 1


def test_symbol_filter_and_columns_reach_the_scan(spark):
    p = plan(load_bars(spark, bars_from(spark, SF_SMALL, "orders"), ["1-URGENT"]))
    scan = [line for line in p.split("\n") if "FileScan parquet" in line][0]
    assert "o_orderpriority" in scan and "1-URGENT" in scan  # pushed to the scan
    assert "o_custkey" not in scan and "o_orderstatus" not in scan  # pruned columns


def test_blocked_windows_partition_by_chunk(spark):
    p = plan(add_indicators(bars_from(spark, SF_SMALL, "orders"), block_rows=64, block_days=30))
    assert "hashpartitioning(symbol" in p and "_chunk" in p
