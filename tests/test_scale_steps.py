"""Steps that have to read their input once and keep what they shuffle small."""

import numpy as np
from pyspark.sql import functions as F

from tidemark.catalog import models, registry
from tidemark.models import linear, sequence, solve
from tidemark.operators.indicators import add_indicators

SF = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_runs_read_the_ticks_once(spark):
    for df in (registry.run_metrics(spark, SF), models.baseline_metrics(spark, SF)):
        assert plan(df).count("FileScan parquet") == 1


def closing_bars(spark, symbols=("a", "b"), days=150):
    rng = np.random.default_rng(5)
    rows = [(s, i, float(50 + i * 0.1 + rng.normal()), int(rng.integers(1, 90))) for s in symbols for i in range(days)]
    return spark.createDataFrame(rows, "symbol string, i int, close double, volume long").select(
        "symbol", F.date_add(F.lit("2024-01-01").cast("date"), F.col("i")).alias("date"), "close", "volume")


def test_window_fit_equals_the_joined_one(spark):
    bars = closing_bars(spark).unionByName(closing_bars(spark, [None], 60))
    ds = linear.linear_dataset(bars)
    fit = linear.fit_linear_1f(ds)
    want = ds.where("split = 'test'").join(fit, "symbol").select("symbol", "date", (F.col("intercept") + F.col("slope") * F.col("MA_5")).alias("yhat"))
    got = models.baseline_predictions(ds).where("model_type = 'linear_1f'").select("symbol", "date", "yhat")
    a, b = (sorted(map(tuple, x.collect())) for x in (want, got))
    assert [r[:2] for r in a] == [r[:2] for r in b] and np.allclose([r[2] for r in a], [r[2] for r in b], rtol=1e-9)


def test_sequences_trained_in_one_pass_equal_the_dataset_form(spark):
    ind = add_indicators(closing_bars(spark).unionByName(closing_bars(spark, ["short"], 62)))
    ds = sequence.sequence_dataset(ind)
    fit = sequence.fit_sequence(ds).join(sequence.scalers(ds), "symbol")
    want = {r.symbol: r for r in fit.join(sequence.evaluate_sequence(ds, fit).where("metric_space = 'scaled'"), "symbol", "left").collect()}
    got = {r.symbol: r for r in sequence.train_sequences(sequence.sequence_rows(ind)).collect()}
    assert set(got) == set(want) and {"a", "b"} <= set(got)
    for s, r in got.items():
        w = want[s]
        assert (r.n_train, r.error, r.n or None) == (w.n_train, w.error, w.n)
        for c in ("coef", "sigma", "scale_min", "scale_max", "mae", "mse", "rmse", "r2"):
            assert (r[c] is None) == (w[c] is None) and (r[c] is None or np.allclose(r[c], w[c], rtol=1e-6, atol=1e-9)), (s, c)


def test_packed_sums_are_not_shuffled(spark):
    ds = sequence.sequence_dataset(add_indicators(closing_bars(spark)))
    assert plan(sequence.fit_sequence(ds)).count("Exchange") == 1  # the bars by symbol; no gram of 89,253 numbers


def test_regular_systems_have_the_minimum_norm_solution(spark):
    rng = np.random.default_rng(1)
    x = rng.normal(size=(40, 6))
    a, b = x.T @ x, rng.normal(size=6)
    assert np.allclose(solve.scaled_lstsq(a, b), np.linalg.lstsq(a, b, rcond=None)[0], rtol=1e-9)
    a, b = np.ones((2, 2)), np.ones(2)
    assert np.allclose(solve.scaled_lstsq(a, b), [0.5, 0.5])


def test_requests_are_not_dealt_by_symbol_and_model_type(spark):
    served = plan(models.responses(spark, SF))  # a few pairs have all rows: as many tasks would make all responses
    assert "SortMergeJoin" not in served and "Exchange hashpartitioning" not in served and "BroadcastHashJoin" in served
