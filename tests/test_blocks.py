import pytest
from pyspark.sql import functions as F

from tests.conftest import SF_SMALL, series
from tidemark.models import ar
from tidemark.operators import blocks as B
from tidemark.operators import dataset as D
from tidemark.operators.indicators import add_indicators, next_target
from tidemark.sources.bars import bars_from

FEATURES = ["close", "volume"]


@pytest.fixture(scope="module")
def bars(spark):
    some = bars_from(spark, SF_SMALL, "orders").unionByName(series(spark, [float(i % 7) for i in range(130)], "EXACT"))
    return some.unionByName(series(spark, [1.0], "ONE"))


def same(a, b):
    cols = a.columns
    text = lambda df: sorted(map(str, df.select(*cols).collect()))
    left, right = text(a), text(b)
    assert left == right and left


@pytest.mark.parametrize("rows", [64, 65, 3])
def test_blocked_operators_equal_the_plain_ones(bars, rows):
    same(next_target(bars), next_target(bars, block_rows=rows))
    same(D.lookback_sequences(bars, FEATURES, 10), D.lookback_sequences(bars, FEATURES, 10, block_rows=rows))
    same(ar.ar_dataset(bars), ar.ar_dataset(bars, block_rows=rows))
    same(add_indicators(bars), add_indicators(bars, block_rows=rows, block_days=50))


def test_blocked_split_and_fit(bars):
    same(D.chronological_split(bars), D.chronological_split(bars, blocked=True))
    same(ar.fit_ar(ar.ar_dataset(bars)).select("symbol", "n_train", F.round("loglik", 6)),
         ar.fit_ar(ar.ar_dataset(bars, block_rows=64)).select("symbol", "n_train", F.round("loglik", 6)))


def test_source_is_read_once(bars):
    plan = B.in_chunks(B.positioned(bars), 64, before=9)._jdf.queryExecution().executedPlan().toString()
    assert "FileScan" not in plan  # only the numbered rows are read again
    copies = B.in_chunks(B.positioned(bars), 64, before=9).count()
    assert bars.count() < copies < 1.3 * bars.count()


def test_empty(bars):
    assert next_target(bars.limit(0), block_rows=64).count() == 0
    assert ar.ar_dataset(bars.limit(0), block_rows=64).count() == 0
