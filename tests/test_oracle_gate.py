"""Every registered query with SQL matches DuckDB at sf0.001; the value checks of the others."""

import json

import pytest

import __spark_entry__ as E
from tests.conftest import SF_SMALL
from tests.oracle import compare, duck
from tidemark.catalog import QUERIES, SQL

# rows of the queries without SQL at sf0.001, from the number of symbols, steps and requests
ROWS = {"fit_linear": 25, "linear_metrics": 25, "fit_ar": 25, "ar_metrics": 25, "ar_forecast": 25 * 30,
        "fit_trend_seasonal": 25, "forecast_trend_seasonal": 25 * 30, "trend_seasonal_metrics": 25,
        "trend_seasonal_metrics_positional": 25, "sequence_metrics": 10, "sequence_rollout": 5, "sequence_rollout_last": 5,
        "train_all": 20, "file_inventory": 14}


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


@pytest.mark.parametrize("name", sorted(SQL))
def test_sql_match(spark, con, name):
    r = compare(QUERIES[name](spark, SF_SMALL), SQL[name], con)
    assert r["ok"], r


@pytest.mark.parametrize("name", sorted(ROWS))
def test_rows_without_sql(spark, name):
    assert QUERIES[name](spark, SF_SMALL).count() == ROWS[name]


def test_streamed_responses_equal_the_batch(spark):
    assert set(QUERIES) - set(SQL) == set(ROWS) | {"predict_batch", "score_requests_stream"}

    def rows(name):
        return {r.request_id: json.dumps(r.asDict(True), default=str, sort_keys=True) for r in QUERIES[name](spark, SF_SMALL).collect()}

    batch = rows("predict_batch")
    assert len(batch) == 2500 and rows("score_requests_stream") == batch


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0 and "RSI" in df.columns
