import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.conftest import SF_SMALL, series
from tidemark.models import ar, linear, sequence, trend_seasonal as TS
from tidemark.models.solve import fit_least_squares
from tidemark.operators.cleaning import LINEAR_FEATURES
from tidemark.operators.indicators import add_indicators
from tidemark.sources.bars import bars_from


def _pdf(df):
    return df.toPandas()


def test_partial_gram_matches_numpy(spark):
    rng = np.random.default_rng(0)
    rows = []
    for sym in ("A", "B"):
        X = rng.normal(size=(300, 3))
        y = X @ np.array([1.0, -2.0, 0.5]) + (3.0 if sym == "A" else -1.0) + rng.normal(scale=0.1, size=300)
        rows += [(sym, [1.0] + list(map(float, x)), float(t)) for x, t in zip(X, y)]
    df = spark.createDataFrame(rows, "symbol string, x array<double>, y double").repartition(7)
    fit = {r.symbol: r for r in fit_least_squares(df, 4).collect()}
    for sym in ("A", "B"):
        sub = [(x, t) for s, x, t in rows if s == sym]
        X = np.array([x for x, _ in sub])
        y = np.array([t for _, t in sub])
        ref = np.linalg.lstsq(X, y, rcond=None)[0]
        assert np.allclose(fit[sym].coef, ref, atol=1e-8)
        assert fit[sym].n_train == 300


def test_linear_matches_numpy(spark):
    ds = linear.linear_dataset(bars_from(spark, SF_SMALL, "brands"))
    fit = {r.symbol: r for r in linear.fit_linear(ds).collect()}
    train = _pdf(ds.where(F.col("split") == "train"))
    for sym, g in train.groupby("symbol"):
        X = np.column_stack([np.ones(len(g))] + [g[c].to_numpy() for c in LINEAR_FEATURES])
        ref = np.linalg.lstsq(X, g["target"].to_numpy(), rcond=None)[0]
        r = fit[sym]
        pred_spark = r.intercept + X[:, 1:] @ np.array(r.coef)
        assert np.allclose(pred_spark, X @ ref, rtol=1e-6, atol=1e-6)
        assert r.coef[2] == pytest.approx(0.0, abs=1e-9)  # constant RSI column


def test_ar_fit_and_forecast_match_numpy(spark):
    ds = ar.ar_dataset(bars_from(spark, SF_SMALL, "orders"))
    fit = {r.symbol: r for r in ar.fit_ar(ds, method="conditional").collect()}
    train = _pdf(ds.where(F.col("split") == "train")).sort_values(["symbol", "date"])
    for sym, g in train.groupby("symbol"):
        c = g["close"].to_numpy()
        d = np.diff(c)
        X = np.column_stack([d[5 - i - 1:len(d) - i - 1] for i in range(5)])
        y = d[5:]
        phi = np.linalg.lstsq(X, y, rcond=None)[0]
        assert np.allclose(fit[sym].coef, phi, rtol=1e-6, atol=1e-9)
        # recursive forecast
        hist, lvl, out = list(d[::-1][:5]), c[-1], []
        for _ in range(7):
            dy = float(np.dot(phi, hist))
            lvl += dy
            out.append(lvl)
            hist = [dy] + hist[:4]
        got = spark.createDataFrame([(fit[sym].coef, fit[sym].last_diffs, fit[sym].last_close)],
                                    "c array<double>, d array<double>, l double").select(
            ar.ar_forecast_expr(F.col("c"), F.col("d"), F.col("l"), F.lit(7)).alias("f")).first().f
        assert np.allclose(got, out, rtol=1e-9)


def test_rollout_matches_numpy_loop(spark):
    L, nf = 60, 7
    rng = np.random.default_rng(1)
    coef = rng.normal(scale=0.01, size=1 + L * nf)
    window = rng.uniform(size=L * nf)
    got = spark.createDataFrame([(coef.tolist(), window.tolist())], "c array<double>, w array<double>").select(
        sequence.rollout_expr(F.col("c"), F.col("w"), F.lit(4), "roll").alias("p")).first().p
    cur = window.reshape(L, nf).copy()
    ref = []
    for _ in range(4):
        p = coef[0] + coef[1:] @ cur.reshape(-1)
        ref.append(p)
        cur = np.roll(cur, -1, axis=0)
        cur[-1, 0] = p
    assert np.allclose(got, ref, rtol=1e-10)


def test_trend_seasonal_and_sequence_run(spark):
    b = bars_from(spark, SF_SMALL, "orders")
    ds = TS.ts_dataset(b)
    fit = TS.fit_trend_seasonal(ds)
    assert fit.where(F.col("error").isNull()).count() == 5
    m = TS.evaluate_trend_seasonal(ds, fit).collect()
    assert all(r.mae >= 0 for r in m)
    fc = TS.forecast_frame(fit, TS.future_frame(fit, 10))
    assert fc.where(F.col("yhat_lower") > F.col("yhat_upper")).count() == 0
    sds = sequence.sequence_dataset(add_indicators(b))
    sfit = sequence.fit_sequence(sds)
    ev = sequence.evaluate_sequence(sds, sfit)
    assert {r.metric_space for r in ev.collect()} == {"scaled", "price"}


def test_ar_serving_state_is_newest_bars(spark):
    bars = bars_from(spark, SF_SMALL, "orders")
    fit = {r.symbol: r for r in ar.fit_ar(ar.ar_dataset(bars)).collect()}
    pdf = bars.toPandas().sort_values(["symbol", "date"])
    for sym, g in pdf.groupby("symbol"):
        c = g["close"].to_numpy()
        assert fit[sym].serve_last_close == pytest.approx(c[-1])
        assert np.allclose(fit[sym].serve_last_diffs, np.diff(c)[::-1][:5])
        assert fit[sym].serve_as_of == g["date"].iloc[-1]


def test_rollout_last_carry_matches_numpy(spark):
    L, nf = 60, 7
    rng = np.random.default_rng(2)
    coef = rng.normal(scale=0.01, size=1 + L * nf)
    window = rng.uniform(size=L * nf)
    got = spark.createDataFrame([(coef.tolist(), window.tolist())], "c array<double>, w array<double>").select(
        sequence.rollout_expr(F.col("c"), F.col("w"), F.lit(3), "last").alias("p")).first().p
    cur = window.reshape(L, nf).copy()
    ref = []
    for _ in range(3):
        p = coef[0] + coef[1:] @ cur.reshape(-1)
        ref.append(p)
        new = cur[-1].copy()
        new[0] = p
        cur = np.vstack([cur[1:], new])
    assert np.allclose(got, ref, rtol=1e-10)


@pytest.mark.parametrize("price,spread", [(5.0, 2e7), (0.05, 2e7), (1e6, 1e-3), (100.0, 100.0)])
def test_linear_is_independent_of_units(spark, price, spread):
    rng = np.random.default_rng(6)
    n = 400
    a, b = price * (1 + 0.01 * rng.normal(size=n)), price * (1 + 0.01 * rng.normal(size=n))
    v = spread * rng.normal(size=n) + 3 * spread
    y = 0.7 * a - 0.2 * b + 0.01 * price * v / spread + 1e-4 * price * rng.normal(size=n)
    rows = [("S", "train", float(p), float(q), 50.0, float(w), float(t)) for p, q, w, t in zip(a, b, v, y)]
    ds = spark.createDataFrame(rows, "symbol string, split string, MA_5 double, MA_20 double, RSI double, Volume_MA double, target double")
    r = linear.fit_linear(ds).first()
    X = np.column_stack([a, b, v])
    Z = (X - X.mean(0)) / X.std(0)
    ref = np.linalg.lstsq(Z, y - y.mean(), rcond=None)[0] / X.std(0)
    assert np.allclose([r.coef[0], r.coef[1], r.coef[3]], ref, rtol=1e-5) and r.coef[2] == 0.0
    assert r.intercept == pytest.approx(y.mean() - ref @ X.mean(0), rel=1e-4, abs=1e-4 * price)


@pytest.mark.parametrize("scale", [1e-9, 1e-3, 1.0, 1e3, 1e9])
def test_least_squares_is_independent_of_units(spark, scale):
    rng = np.random.default_rng(7)
    for k in (3, 12):  # built-in sums and packed Gram
        X = rng.normal(size=(200, k)) * np.r_[1.0, np.full(k - 1, scale)]
        y = X @ (1 / np.r_[1.0, np.full(k - 1, scale)]) + 0.01 * rng.normal(size=200)
        df = spark.createDataFrame([("S", list(map(float, x)), float(t)) for x, t in zip(X, y)], "symbol string, x array<double>, y double")
        got = fit_least_squares(df, k).first().coef
        assert np.allclose(got, np.linalg.lstsq(X / np.r_[1.0, np.full(k - 1, scale)], y, rcond=None)[0] / np.r_[1.0, np.full(k - 1, scale)], rtol=1e-6)


def test_trend_seasonal_fit_matches_numpy(spark):
    ds = TS.ts_dataset(bars_from(spark, SF_SMALL, "orders"))
    fit = {r.symbol: r for r in TS.fit_trend_seasonal(ds, prior="normal").collect()}
    train = _pdf(ds.where(F.col("split") == "train"))
    pen = np.diag(TS.penalties())
    for sym, g in train.groupby("symbol"):
        X, y = np.vstack(g["x"].to_numpy()), (g["y"] / g["y_scale"]).to_numpy()
        ref = np.linalg.solve(X.T @ X + pen, X.T @ y)
        assert np.allclose(X @ np.array(fit[sym].coef), X @ ref, rtol=1e-6, atol=1e-8)


def test_sequence_fit_matches_numpy(spark):
    ind = add_indicators(bars_from(spark, SF_SMALL, "orders"))
    ds = sequence.sequence_dataset(ind)
    fit = {r.symbol: r for r in sequence.fit_sequence(ds).collect()}
    feats = sequence.SEQUENCE_FEATURES
    pdf = _pdf(ind.select("symbol", "date", *feats)).dropna().sort_values(["symbol", "date"])
    for sym, g in pdf.groupby("symbol"):
        raw = g[feats].to_numpy(float)
        head = raw[: len(raw) * 4 // 5]
        z = (raw - head.min(0)) / (head.max(0) - head.min(0))
        n = len(z) - 60
        X = np.array([np.r_[1.0, z[i: i + 60].ravel()] for i in range(n)])[: n * 4 // 5]
        y = z[60:, 0][: n * 4 // 5]
        pen = np.eye(X.shape[1]) * sequence.RIDGE
        pen[0, 0] = 0
        ref = np.linalg.solve(X.T @ X + pen, X.T @ y)
        assert fit[sym].n_train == len(y)
        assert np.allclose(X @ np.array(fit[sym].coef), X @ ref, rtol=1e-6, atol=1e-8)


def test_history_before_the_window_does_not_move_a_served_forecast(spark):
    bars = bars_from(spark, SF_SMALL, "orders").where(F.col("symbol") == "1-URGENT")
    ind = add_indicators(bars)
    ds = sequence.sequence_dataset(ind)
    fit, scaler = sequence.fit_sequence(ds), sequence.scalers(ds)
    old = bars.orderBy(F.desc("date")).collect()[180].date
    moved = bars.withColumn("close", F.when(F.col("date") == F.lit(old), F.col("close") * 9).otherwise(F.col("close")))
    a, b = (sequence.predict_sequence(fit, sequence.latest_window(add_indicators(x), scaler), 5).first() for x in (bars, moved))
    assert np.allclose(a.predictions, b.predictions, rtol=1e-9)


def test_ar_band_is_the_spread_of_simulated_paths(spark):
    phi, sigma, h = [0.5, -0.2, 0.1, 0.0, 0.0], 2.0, 8
    got = spark.createDataFrame([(phi,)], "c array<double>").select(
        ar.ar_band_expr(F.col("c"), F.lit(sigma), F.lit(h)).alias("b")).first().b
    rng = np.random.default_rng(3)
    paths = np.zeros((60000, h))
    d = np.zeros((60000, 5))
    lvl = np.zeros(60000)
    for t in range(h):
        dy = d @ np.array(phi) + sigma * rng.normal(size=60000)
        lvl = lvl + dy
        d = np.column_stack([dy, d[:, :4]])
        paths[:, t] = lvl
    assert np.allclose(got, paths.std(0), rtol=0.02) and got[0] == sigma


def test_every_symbol_has_a_row_and_every_type_is_served(spark):
    from tidemark.plans import predict as P
    from tidemark.plans.train import MODEL_TYPES, train_many
    from tests.conftest import series
    bars = bars_from(spark, SF_SMALL, "orders").where(F.col("symbol").isin("1-URGENT", "2-HIGH"))
    bars = bars.unionByName(series(spark, [1.0, 2.0, 3.0], "SHORT").select(bars.columns)).unionByName(
        series(spark, [0.0] * 200, "ZERO").select(bars.columns))
    models = train_many(bars, created_at="2024-01-01").cache()
    rows = {(r.model_type, r.symbol): r for r in models.collect()}
    assert set(rows) == {(m, s) for m in MODEL_TYPES for s in ("1-URGENT", "2-HIGH", "SHORT", "ZERO")}
    assert all(rows[(m, "SHORT")].error for m in ("linear", "prophet", "lstm")) and rows[("prophet", "ZERO")].error
    assert all(rows[(m, "1-URGENT")].error is None for m in MODEL_TYPES)
    req = spark.createDataFrame([(f"{m}{d}", "1-urgent", m, d) for m in MODEL_TYPES for d in (1, 3)],
                                "request_id string, symbol string, model_type string, days_ahead int")
    got = {r.request_id: r for r in P.predict_batch(req, P.forecast_table(models, bars), "2024-01-02").collect()}
    assert all(got[f"{m}1"].status == "success" and len(got[f"{m}1"].predictions) == 1 for m in MODEL_TYPES)
    assert got["linear3"].status == "error" and got["lstm3"].status == "success"
    feats = linear.newest_features(bars).where(F.col("symbol") == "1-URGENT").first()
    m = rows[("linear", "1-URGENT")]
    assert got["linear1"].predictions[0] == pytest.approx(m.intercept + sum(c * feats[f] for c, f in zip(m.coef, m.features)))


def _dense_loglik(phi, sigma, w):
    """Gaussian log-likelihood of a stationary autoregression from its whole covariance matrix."""
    p, n = len(phi), len(w)
    start = np.linalg.inv(ar.start_precision(phi)[0])
    gamma = list(start[0]) + [0.0] * (n - p)
    for k in range(p, n):
        gamma[k] = sum(phi[i] * gamma[k - 1 - i] for i in range(p))
    cov = sigma**2 * np.array(gamma)[np.abs(np.subtract.outer(np.arange(n), np.arange(n)))]
    _, det = np.linalg.slogdet(cov)
    return -0.5 * (n * np.log(2 * np.pi) + det + w @ np.linalg.solve(cov, w))


def test_exact_ar_likelihood_equals_dense_covariance(spark):
    ds = ar.ar_dataset(bars_from(spark, SF_SMALL, "brands"))
    fit = {r.symbol: r for r in ar.fit_ar(ds).collect()}
    train = _pdf(ds.where(F.col("split") == "train")).sort_values(["symbol", "date"])
    rng = np.random.default_rng(5)
    assert len(fit) == 25
    for sym, g in train.groupby("symbol"):
        w, r = np.diff(g["close"].to_numpy()), fit[sym]
        phi = np.array(r.coef)
        assert r.n_train == len(w)
        best = _dense_loglik(phi, r.sigma, w)
        assert r.loglik == pytest.approx(best, rel=1e-6)
        for _ in range(6):  # no neighbour is better
            other = phi + rng.normal(scale=1e-3, size=5)
            assert _dense_loglik(other, r.sigma, w) <= best + 1e-9 * abs(best)
        assert _dense_loglik(phi, r.sigma * 1.001, w) < best and _dense_loglik(phi, r.sigma * 0.999, w) < best


def test_exact_ar_recovers_a_simulated_series_and_its_edges():
    rng = np.random.default_rng(3)
    phi = np.array([0.5, -0.3, 0.2, 0.1, -0.2])
    w = np.zeros(20_000)
    e = rng.normal(scale=2.0, size=len(w))
    for t in range(5, len(w)):
        w[t] = phi @ w[t - 5:t][::-1] + e[t]
    for n in (11, 40, 20_000):
        x = w[100:100 + n]
        got, sigma, loglik = ar.exact_fit(np.array([x[: len(x) - k] @ x[k:] for k in range(6)]), len(x), x[:5], x[::-1][:5])
        assert loglik == pytest.approx(_dense_loglik(got, sigma, x), rel=1e-6) if n < 100 else np.allclose(got, phi, atol=0.03)
    flat = ar.exact_fit(np.zeros(6), 50, np.zeros(5), np.zeros(5))
    assert flat[0].tolist() == [0.0] * 5 and flat[1] == 0.0


def test_long_forecast_equals_the_loop(spark):
    coef, diffs, close, h = [0.4, -0.2, 0.1, 0.05, -0.1], [1.0, -0.5, 0.3, 0.2, -0.1], 100.0, 100_000
    hist, lvl, want = list(diffs), close, []
    for _ in range(h):
        dy = float(np.dot(coef, hist))
        lvl += dy
        want.append(lvl)
        hist = [dy] + hist[:4]
    df = spark.createDataFrame([("A", coef, diffs, close, h), ("B", coef, diffs, close, 3)],
                               "symbol string, coef array<double>, last_diffs array<double>, last_close double, h int")
    got = ar.forecast_steps(df, block=7000).orderBy("symbol", "step").toPandas()
    assert np.allclose(got[got["symbol"] == "A"]["yhat"], want, rtol=1e-10)
    assert got[got["symbol"] == "B"]["step"].tolist() == [1, 2, 3] and np.allclose(got[got["symbol"] == "B"]["yhat"], want[:3])


def test_changepoints_stand_at_row_quantiles(spark):
    ds = TS.ts_dataset(bars_from(spark, SF_SMALL, "orders").unionByName(series(spark, [100.0 + i for i in range(20)], "SHORT")))
    train = _pdf(ds.where(F.col("split") == "train")).sort_values(["symbol", "ds"])
    for sym, g in train.groupby("symbol"):
        hist = len(g) * 80 // 100
        count = min(TS.N_CHANGEPOINTS, hist - 1)
        at = np.linspace(0, hist - 1, count + 1).round().astype(int)[1:]
        days = np.array([d.toordinal() for d in g["ds"]], float)
        want = (days[at] - days[0]) / (days[-1] - days[0])
        assert np.allclose(g["knots"].iloc[0][:count], want) and set(g["knots"].iloc[0][count:]) <= {TS.FAR}


def _posterior(X, y, beta, s):
    rest = np.r_[beta[:2] / TS.TREND_PRIOR_SCALE, beta[TS.N_TREND:] / TS.SEASONALITY_PRIOR_SCALE]
    return (len(y) * np.log(s) + ((y - X @ beta) ** 2).sum() / (2 * s * s) + np.abs(beta[2:TS.N_TREND]).sum() / TS.CHANGEPOINT_PRIOR_SCALE
            + (rest**2).sum() / 2 + s * s / (2 * TS.NOISE_PRIOR_SCALE**2))


def test_laplace_fit_meets_its_conditions(spark):
    ds = TS.ts_dataset(bars_from(spark, SF_SMALL, "brands"))
    fit = {r.symbol: r for r in TS.fit_trend_seasonal(ds).collect()}
    train = _pdf(ds.where(F.col("split") == "train"))
    rng = np.random.default_rng(7)
    zeros = 0
    for sym, g in train.groupby("symbol"):
        X, y = np.vstack(g["x"].to_numpy()), (g["y"] / g["y_scale"]).to_numpy()
        beta, s = np.array(fit[sym].coef), fit[sym].sigma
        slope = X.T @ (y - X @ beta)  # of the squares; at the optimum the priors balance it
        weight = s * s / TS.CHANGEPOINT_PRIOR_SCALE
        change, live = slope[2:TS.N_TREND], beta[2:TS.N_TREND] != 0
        assert np.allclose(change[live], weight * np.sign(beta[2:TS.N_TREND][live]), atol=1e-5 * weight + 1e-8)
        assert (np.abs(change[~live]) <= weight * (1 + 1e-5) + 1e-8).all()
        prior = np.r_[[TS.TREND_PRIOR_SCALE] * 2, [TS.SEASONALITY_PRIOR_SCALE] * (TS.K - TS.N_TREND)]
        rest = np.r_[0, 1, np.arange(TS.N_TREND, TS.K)]
        assert np.allclose(slope[rest], s * s * beta[rest] / prior**2, atol=1e-7)
        best = _posterior(X, y, beta, s)
        for _ in range(10):
            assert _posterior(X, y, beta + rng.normal(scale=1e-3, size=TS.K), s * np.exp(rng.normal(scale=1e-3))) >= best - 1e-7 * abs(best)
        zeros += int((~live).sum())
    assert zeros > 0


def test_l1_solve_equals_coordinate_descent():
    rng = np.random.default_rng(9)
    for _ in range(40):
        k = int(rng.integers(1, 9))
        x = rng.normal(size=(40, k)) @ rng.normal(size=(k, k))
        g, c, weight = x.T @ x, x.T @ rng.normal(size=40) * 3, float(rng.uniform(0.1, 30))
        b = np.zeros(k)
        for _ in range(20_000):
            old = b.copy()
            for j in range(k):
                r = c[j] - g[j] @ b + g[j, j] * b[j]
                b[j] = np.sign(r) * max(abs(r) - weight, 0) / g[j, j]
            if np.abs(b - old).max() < 1e-14:
                break
        for start in (np.zeros(k), rng.normal(size=k)):
            assert np.allclose(TS.l1_solve(g, c, weight, start), b, atol=1e-6)


def test_sampled_band_is_the_same_under_any_partitioning(spark):
    ds = TS.ts_dataset(bars_from(spark, SF_SMALL, "orders"))
    fit = TS.fit_trend_seasonal(ds)
    days = TS.future_frame(fit, 40)
    a = TS.forecast_frame(fit, days.coalesce(1)).orderBy("symbol", "ds").toPandas()
    b = TS.forecast_frame(fit, days.repartition(13)).orderBy("symbol", "ds").toPandas()
    assert a.equals(b) and len(a) == 200
    assert (a["yhat_lower"] < a["yhat"]).all() and (a["yhat"] < a["yhat_upper"]).all()
    plain = TS.forecast_frame(fit, days, band="analytic").orderBy("symbol", "ds").toPandas()
    assert np.allclose(a["yhat"], plain["yhat"])


def test_sampled_band_covers_simulated_futures():
    """Series whose slope changes at the model's own rate, with noise: about 80 % lie inside the band, near and far."""
    rng = np.random.default_rng(11)
    sigma, scale, knots = 0.1, 0.3, 25
    changes = rng.laplace(0, scale, 4000)[:knots]
    scale = np.abs(changes).mean()
    for t in (1.02, 1.5, 2.7):
        low, high = np.quantile(TS.sampled_deviations("X", 20_000, t, sigma, changes), [0.1, 0.9])
        inside = 0
        for _ in range(4000):
            at = 1 + rng.random(rng.poisson(knots * (t - 1))) * (t - 1)
            y = (rng.laplace(0, scale, len(at)) * (t - at)).sum() + rng.normal(0, sigma)
            inside += low <= y <= high
        assert 0.76 <= inside / 4000 <= 0.84, t


@pytest.mark.parametrize("carry", ["roll", "last"])
def test_long_rollout_equals_the_loop(spark, carry):
    L, nf, h = 60, 7, 3000
    rng = np.random.default_rng(4)
    coef = rng.normal(scale=0.01, size=1 + L * nf)
    cur = rng.uniform(size=(L, nf))
    windows = spark.createDataFrame([("A", cur.reshape(-1).tolist(), 10.0, 30.0)], "symbol string, window array<double>, close_min double, close_max double")
    fit = spark.createDataFrame([("A", coef.tolist(), None)], "symbol string, coef array<double>, error string")
    want = []
    for _ in range(h):
        p = coef[0] + coef[1:] @ cur.reshape(-1)
        want.append(p * 20 + 10)
        cur = np.vstack([cur[1:], np.r_[p, cur[0, 1:] if carry == "roll" else cur[-1, 1:]]])
    got = sequence.rollout_steps(fit, windows, h, carry).orderBy("step").toPandas()
    assert got["step"].tolist() == list(range(1, h + 1)) and np.allclose(got["yhat"], want, rtol=1e-9)
    short = sequence.rollout_steps(fit, windows, 5, carry).orderBy("step").toPandas()
    assert np.allclose(short["yhat"], want[:5])
