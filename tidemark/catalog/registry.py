"""Run tracking and registry queries (R1-R10, U1-U2) over the baseline runs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.catalog import register
from tidemark.catalog.models import BASELINES, _BASE_PRED_SQL, baseline_predictions, closes_from
from tidemark import oracle_sql as O
from tidemark.functions.presentation import round_col, rounded
from tidemark.models import linear
from tidemark.operators.evaluate import regression_metrics, with_metrics
from tidemark.plans import registry as RG
from tidemark.session import cut_lineage

AS_OF, ENDED = "2024-01-02 00:00:00", "2024-01-02 00:05:00"
R = O.round_all
TSFMT = "yyyy-MM-dd HH:mm:ss"


def _predictions(spark: SparkSession, sf: str) -> DataFrame:
    return baseline_predictions(linear.linear_dataset(closes_from(spark, sf, "suppliers")))


def _evals(spark: SparkSession, sf: str) -> DataFrame:
    return regression_metrics(_predictions(spark, sf), ("symbol", "model_type"))


def run_metrics(spark: SparkSession, sf: str) -> DataFrame:
    """Final metrics (step 0) plus the MAE curve over the test rows (step s =
    mean absolute error of the first s test predictions), in one pass over the predictions: the
    last row of a run brings its final metrics along."""
    w = Window.partitionBy("symbol", "model_type").orderBy("date")
    so_far = F.avg(F.abs(F.col("y") - F.col("yhat"))).over(w.rowsBetween(Window.unboundedPreceding, 0))
    rows = with_metrics(_predictions(spark, sf), ("symbol", "model_type")).select(
        "symbol", "model_type", "n", "mae", "rmse", "r2", F.row_number().over(w).alias("at"), so_far.alias("so_far"))

    def entry(metric, step, value):
        return F.struct(F.lit(metric).alias("metric"), step.alias("step"), value.alias("value"))

    final = F.array(*[entry(m, F.lit(0), F.col(m)) for m in ("mae", "rmse", "r2")])
    curve = F.array(entry("mae", F.col("at"), F.col("so_far")))
    return rows.select(F.concat_ws("-", "model_type", "symbol").alias("run_id"),
                       F.inline(F.when(F.col("at") == F.col("n"), F.concat(final, curve)).otherwise(curve))).select(
        "run_id", "metric", "step", F.to_timestamp(F.lit(AS_OF)).alias("ts"), "value")


_CTE = f"""{_BASE_PRED_SQL},
  m AS ({O.metrics('SELECT * FROM p', 'symbol, model_type')}),
  rm AS (SELECT model_type || '-' || symbol AS run_id, 'mae' AS metric, 0 AS step, mae AS value FROM m
         UNION ALL SELECT model_type || '-' || symbol, 'rmse', 0, rmse FROM m
         UNION ALL SELECT model_type || '-' || symbol, 'r2', 0, r2 FROM m
         UNION ALL SELECT model_type || '-' || symbol, 'mae',
           CAST(row_number() OVER (PARTITION BY symbol, model_type ORDER BY date) AS INTEGER),
           avg(abs(y - yhat)) OVER (PARTITION BY symbol, model_type ORDER BY date ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
           FROM (SELECT * FROM p WHERE y IS NOT NULL AND yhat IS NOT NULL) pp),
  latest AS (SELECT run_id, metric, arg_max(value, (step, value)) AS value FROM rm GROUP BY run_id, metric),
  ord AS (SELECT * FROM (VALUES {', '.join(f"({i}, '{b}')" for i, b in enumerate(BASELINES))}) o(ord, model_type)),
  cand AS (SELECT 'stock_predictor_' || m.symbol AS model, m.model_type || '-' || m.symbol AS run_id, ord.ord, m.mae
           FROM m JOIN ord USING (model_type)),
  reg AS (SELECT model, run_id, mae, CAST(row_number() OVER (PARTITION BY model ORDER BY ord) AS INTEGER) AS version FROM cand),
  ev0 AS (SELECT model, version, 'None' AS stage, TIMESTAMP '{AS_OF}' AS ts, 0 AS seq, run_id FROM reg
          UNION ALL SELECT model, version, 'Staging', TIMESTAMP '{AS_OF}', 1, run_id FROM reg),
  pr AS (SELECT model, version, 'Production' AS to_stage,
           TIMESTAMP '{AS_OF}' + INTERVAL 10 MINUTE + to_seconds(CAST(row_number() OVER (PARTITION BY model ORDER BY mae DESC NULLS FIRST, version) AS BIGINT)) AS ts
         FROM reg),
  prl AS (SELECT *, lag(version) OVER (PARTITION BY model ORDER BY ts) AS prev FROM pr),
  runsv AS (SELECT DISTINCT model, version, run_id FROM ev0),
  ev1 AS (SELECT p.model, p.prev AS version, 'Archived' AS stage, p.ts, 2 AS seq, r.run_id FROM prl p
            LEFT JOIN runsv r ON r.model = p.model AND r.version = p.prev WHERE p.prev IS NOT NULL AND p.prev <> p.version
          UNION ALL SELECT p.model, p.version, p.to_stage, p.ts, 3, r.run_id FROM prl p
            LEFT JOIN runsv r ON r.model = p.model AND r.version = p.version),
  ev AS (SELECT * FROM ev0 UNION ALL SELECT * FROM ev1),
  state AS (SELECT model, version, arg_max(stage, (ts, seq)) AS stage, arg_max(run_id, (ts, seq)) AS run_id
            FROM ev GROUP BY model, version)
"""


def _registry(spark: SparkSession, sf: str):
    ev = cut_lineage(_evals(spark, sf))  # small (symbols × 4), reused by every registry step
    order = F.array_position(F.array(*[F.lit(b) for b in BASELINES]), F.col("model_type")) - 1
    cand = ev.select(F.concat(F.lit("stock_predictor_"), F.col("symbol")).alias("model"),
                     F.concat_ws("-", "model_type", "symbol").alias("run_id"), order.alias("ord"), "mae")
    created = RG.register_versions(cand.select("model", "run_id", "ord"), None, AS_OF)
    ver = created.where(F.col("stage") == "None").select("model", "version", "run_id").join(
        cand.select("run_id", "mae"), "run_id")
    k = F.row_number().over(Window.partitionBy("model").orderBy(F.col("mae").desc_nulls_first(), "version"))
    promos = ver.select("model", "version", F.lit("Production").alias("to_stage"),
                        (F.to_timestamp(F.lit(AS_OF)) + F.make_dt_interval(mins=F.lit(10), secs=k)).alias("ts"))
    promoted = RG.promote(created, promos)
    return created, promoted, created.unionByName(promoted), ev


def _ts(df: DataFrame, col: str = "ts") -> DataFrame:
    return df.withColumn(col, F.date_format(col, TSFMT))


_TS_SQL = "strftime(ts, '%Y-%m-%d %H:%M:%S') AS ts"


@register("run_tags", f"""{_CTE}
  SELECT model_type || '-' || symbol AS run_id, t.key, t.value FROM m,
    (VALUES ('project', 'stock_prediction'), ('environment', 'dev'), ('version', '1.0.0')) t(key, value)
  UNION ALL SELECT model_type || '-' || symbol, 'symbol', symbol FROM m""")
def q_run_tags(spark, sf):
    ev = _evals(spark, sf)
    return RG.log_runs(ev, AS_OF, ENDED)[1]


@register("runs", f"""{_CTE}
  SELECT model_type || '-' || symbol AS run_id, symbol, model_type,
    model_type || '_training_20240102_000000' AS run_name,
    '{AS_OF}' AS start_time, '{ENDED}' AS end_time, CASE WHEN mae IS NULL THEN 'FAILED' ELSE 'FINISHED' END AS status FROM m""")
def q_runs(spark, sf):
    ev = _evals(spark, sf)
    runs = RG.log_runs(ev, AS_OF, ENDED)[0]
    return _ts(_ts(runs, "start_time"), "end_time")


@register("run_metrics", R(f"{_CTE} SELECT *, '{AS_OF}' AS ts FROM rm", ["value"], ["run_id", "metric", "step", "ts"]))
def q_run_metrics(spark, sf):
    return rounded(_ts(run_metrics(spark, sf)))


def _params(ev: DataFrame) -> DataFrame:
    return RG.log_params(ev, F.create_map(F.lit("type"), F.col("model_type"), F.lit("test_rows"), F.col("n").cast("string")))


@register("run_params", f"""{_CTE} SELECT model_type || '-' || symbol AS run_id, 'model_type' AS key, model_type AS value FROM m
  UNION ALL SELECT model_type || '-' || symbol, 'model_test_rows', CAST(n AS VARCHAR) FROM m""")
def q_run_params(spark, sf):
    return _params(_evals(spark, sf))


@register("latest_metrics", R(f"{_CTE} SELECT * FROM latest", ["value"], ["run_id", "metric"]))
def q_latest_metrics(spark, sf):
    return rounded(RG.latest_metrics(run_metrics(spark, sf)))


@register("metric_history", f"""{_CTE}
  SELECT run_id, metric, count(*) AS n_steps,
    list(CASE WHEN round(value, 4) = 0 THEN CAST(0 AS DOUBLE) ELSE round(value, 4) END ORDER BY step) AS values
  FROM rm GROUP BY run_id, metric""")
def q_metric_history(spark, sf):
    h = RG.metric_history(run_metrics(spark, sf))
    return h.select("run_id", "metric", F.col("n_steps").cast("long").alias("n_steps"),
                    F.transform("values", lambda v: round_col(v)).alias("values"))


@register("metric_history_pages", f"""{_CTE}
  SELECT run_id, metric, CAST(step // 32 AS INTEGER) AS page, count(*) AS n_steps,
    list(CASE WHEN round(value, 4) = 0 THEN CAST(0 AS DOUBLE) ELSE round(value, 4) END ORDER BY step) AS values
  FROM rm GROUP BY run_id, metric, page""")
def q_metric_history_pages(spark, sf):
    h = RG.metric_history_pages(run_metrics(spark, sf), 32)
    return h.select("run_id", "metric", "page", F.col("n_steps").cast("long").alias("n_steps"),
                    F.transform("values", lambda v: round_col(v)).alias("values"))


@register("metric_universe", f"{_CTE} SELECT DISTINCT metric FROM rm")
def q_metric_universe(spark, sf):
    return RG.metric_universe(run_metrics(spark, sf))


def _groups(symbols: DataFrame) -> DataFrame:
    return symbols.select("symbol").distinct().select(
        F.col("symbol").alias("group"),
        F.array(*[F.concat(F.lit(f"{b}-"), F.col("symbol")) for b in BASELINES]).alias("run_ids"))


@register("compare_run_rows", f"""{_CTE} SELECT m.symbol, ord.ord AS pos, m.model_type || '-' || m.symbol AS run_id,
    m.model_type || '_training_20240102_000000' AS run_name, '{AS_OF}' AS start_time, '{ENDED}' AS end_time,
    CASE WHEN mae IS NULL THEN 'FAILED' ELSE 'FINISHED' END AS status,
    'model_test_rows=' || n || ',model_type=' || m.model_type AS params FROM m JOIN ord USING (model_type)""")
def q_compare_run_rows(spark, sf):
    ev = cut_lineage(_evals(spark, sf))
    rows = RG.compare_run_rows(RG.log_runs(ev, AS_OF, ENDED)[0], _params(ev), _groups(ev))
    text = F.array_join(F.transform(F.array_sort(F.map_entries("params")), lambda e: F.concat_ws("=", e["key"], e["value"])), ",")
    return _ts(_ts(rows, "start_time"), "end_time").withColumn("params", text).withColumnRenamed("group", "symbol")


@register("compare_runs", f"""{_CTE},
  slots AS (SELECT s.symbol, o.ord AS pos, o.model_type || '-' || s.symbol AS run_id
            FROM (SELECT DISTINCT symbol FROM m) s, ord o),
  mets AS (SELECT DISTINCT s.symbol, l.metric FROM slots s JOIN latest l USING (run_id))
  SELECT x.symbol, x.metric,
    list(CASE WHEN round(l.value, 4) = 0 THEN CAST(0 AS DOUBLE) ELSE round(l.value, 4) END ORDER BY s.pos) AS values
  FROM mets x JOIN slots s ON s.symbol = x.symbol
  LEFT JOIN latest l ON l.run_id = s.run_id AND l.metric = x.metric
  GROUP BY x.symbol, x.metric""")
def q_compare_runs(spark, sf):
    latest = cut_lineage(RG.latest_metrics(run_metrics(spark, sf)))  # a few values per run, read twice
    groups = _groups(latest.select(F.regexp_extract("run_id", "^[^-]*-(.*)$", 1).alias("symbol")))
    out = RG.compare_runs(latest, groups)
    return out.select(F.col("group").alias("symbol"), "metric",
                      F.transform("values", lambda v: round_col(v)).alias("values"))


@register("register_versions", f"{_CTE} SELECT model, version, stage, {_TS_SQL}, run_id FROM ev0")
def q_register_versions(spark, sf):
    return _ts(_registry(spark, sf)[0].drop("seq"))


@register("next_version", f"{_CTE} SELECT model, max(version) + 1 AS next_version FROM ev GROUP BY model")
def q_next_version(spark, sf):
    return RG.next_version(_registry(spark, sf)[2])


@register("promote_events", f"{_CTE} SELECT model, version, stage, {_TS_SQL}, run_id FROM ev1")
def q_promote_events(spark, sf):
    return _ts(_registry(spark, sf)[1].drop("seq"))


@register("registry_state", f"{_CTE} SELECT model, version, stage, run_id FROM state")
def q_registry_state(spark, sf):
    return RG.registry_state(_registry(spark, sf)[2]).drop("last_updated")


def _staged(spark: SparkSession, sf: str, moves: list[tuple[int, str, str | None]]):
    """All versions in Staging, then the same moves (version, to, from) for every model, a minute apart."""
    created = _registry(spark, sf)[0]
    steps = F.array(*[F.struct(F.lit(v).alias("version"), F.lit(to).alias("to_stage"), F.lit(frm).cast("string").alias("from_stage"),
                               (F.to_timestamp(F.lit(AS_OF)) + F.make_dt_interval(mins=F.lit(i + 1))).alias("ts"))
                      for i, (v, to, frm) in enumerate(moves)])
    return created, created.select("model").distinct().select("model", F.inline(steps))


@register("registry_demoted", f"""{_CTE} SELECT model, version, CASE WHEN version = 2 THEN 'Production' ELSE 'Staging' END AS stage, run_id FROM reg""")
def q_registry_demoted(spark, sf):
    """A version that left Production before the next promotion is not archived by it."""
    ev, moves = _staged(spark, sf, [(1, "Production", None), (1, "Staging", None), (2, "Production", "Staging")])
    return RG.registry_state(ev.unionByName(RG.promote(ev, moves))).drop("last_updated")


@register("next_version_live", f"{_CTE} SELECT DISTINCT model, 1 AS next_version FROM reg")
def q_next_version_live(spark, sf):
    """With every version archived, no version is in a live stage."""
    ev, moves = _staged(spark, sf, [(v, "Archived", None) for v in range(1, len(BASELINES) + 1)])
    return RG.next_version(ev.unionByName(RG.promote(ev, moves)), ("Production", "Staging"))


@register("promotions_rejected", f"""{_CTE} SELECT model, 1 AS version, 'Archived' AS stage, 'stage is Staging' AS rejected FROM reg WHERE version = 1
  UNION ALL SELECT model, 99, 'Production', 'unknown version' FROM reg WHERE version = 1""")
def q_promotions_rejected(spark, sf):
    ev, moves = _staged(spark, sf, [(1, "Archived", "Production"), (99, "Production", None), (2, "Production", "Staging")])
    return RG.fold_promotions(ev, moves).where(F.col("rejected").isNotNull()).select("model", "version", "stage", "rejected")


@register("model_info", f"""{_CTE} SELECT model, version, stage, run_id FROM (
    SELECT *, row_number() OVER (PARTITION BY model ORDER BY version DESC) AS rn FROM state WHERE stage = 'Production') s
  WHERE rn = 1""")
def q_model_info(spark, sf):
    return RG.model_info(RG.registry_state(_registry(spark, sf)[2])).drop("last_updated")


@register("stage_models", R(f"""{_CTE} SELECT s.model, s.version, s.run_id, m.symbol, m.model_type, m.mae, m.r2
  FROM state s JOIN m ON s.run_id = m.model_type || '-' || m.symbol WHERE s.stage = 'Production'""",
                            ["mae", "r2"], ["model", "version", "run_id", "symbol", "model_type"]))
def q_stage_models(spark, sf):
    _, _, events, ev = _registry(spark, sf)
    models = ev.select(F.concat_ws("-", "model_type", "symbol").alias("run_id"), "symbol", "model_type", "mae", "r2")
    state = RG.registry_state(events)
    return rounded(RG.load_stage_models(state, models).select(
        "model", "version", "run_id", "symbol", "model_type", "mae", "r2"))


@register("model_dirs", f"""{_CTE} SELECT DISTINCT 'models/' || model_type AS prefix FROM m""")
def q_model_dirs(spark, sf):
    ev = _evals(spark, sf)
    paths = ev.select(F.concat_ws("/", F.lit("models"), "model_type", "symbol",
                                  RG.stamp(F.to_timestamp(F.lit(AS_OF)))).alias("key"))
    return paths.select(F.array_join(F.slice(F.split("key", "/"), 1, 2), "/").alias("prefix")).distinct()
