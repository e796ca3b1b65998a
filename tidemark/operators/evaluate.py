"""Evaluation and summaries."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.session import cut_lineage


def align_actual_predicted(actual: DataFrame, predicted: DataFrame,
                           on=("symbol", "date"), how: str = "inner") -> DataFrame:
    """Equi-join actuals ``(…, y)`` and forecasts ``(…, yhat)`` on keys.

    Joining on ``(symbol, date)`` is the correct alignment; the positional mode
    of the reference is ``on=("symbol", "step")`` with both sides numbered.
    """
    return actual.join(predicted, list(on), how)


def regression_metrics(df: DataFrame, keys=("symbol",), y: str = "y", yhat: str = "yhat") -> DataFrame:
    """A1: n, MAE, MSE, RMSE, R² per key.

    R² = 1 − SSres/SStot with SStot = n·var_pop(y) (a stable one-pass moment,
    merged across partial aggregates); SStot = 0 → 1 when SSres = 0, else 0.
    """
    sums = _metric_sums(y, yhat)
    agg = (df.where(F.col(y).isNotNull() & F.col(yhat).isNotNull())
           .groupBy(*keys).agg(*[c.alias(k) for k, c in sums.items()]))
    return agg.select(*keys, "n", "mae", "mse", *_rmse_r2())


def with_metrics(df: DataFrame, keys=("symbol",), y: str = "y", yhat: str = "yhat") -> DataFrame:
    """The rows that count for ``regression_metrics``, each with the metrics of its key."""
    w, sums = Window.partitionBy(*keys), _metric_sums(y, yhat)
    rows = df.where(F.col(y).isNotNull() & F.col(yhat).isNotNull())
    rows = rows.select("*", *[c.over(w).alias(k) for k, c in sums.items()])
    return rows.select(*df.columns, "n", "mae", "mse", *_rmse_r2())


def _metric_sums(y: str, yhat: str) -> dict[str, Column]:
    e = F.col(y) - F.col(yhat)
    return {"n": F.count(F.lit(1)), "mae": F.avg(F.abs(e)), "mse": F.avg(e * e), "_ssres": F.sum(e * e), "_var": F.var_pop(y)}


def _rmse_r2() -> list[Column]:
    total = F.col("_var") * F.col("n")
    r2 = (F.when(total > 0, F.lit(1.0) - F.col("_ssres") / total)
          .when(F.col("_ssres") == 0, F.lit(1.0)).otherwise(F.lit(0.0)))
    return [F.sqrt("mse").alias("rmse"), r2.alias("r2")]


def metrics_of(y: np.ndarray, yhat: np.ndarray) -> dict[str, float] | None:
    """``regression_metrics`` of one key's rows; None without a row."""
    if not len(y):
        return None
    e, total = y - yhat, len(y) * y.var()
    rss = float(e @ e)
    r2 = 1.0 - rss / total if total > 0 else float(rss == 0)
    return {"mae": float(np.abs(e).mean()), "mse": rss / len(e), "rmse": float(np.sqrt(rss / len(e))), "r2": float(r2)}


def dataset_profile(df: DataFrame, date: str = "date") -> DataFrame:
    """A3: rows, columns and 'first to last' date range per symbol."""
    ncols = len([c for c in df.columns if c not in ("symbol", date)])
    return df.groupBy("symbol").agg(
        F.count(F.lit(1)).alias("data_rows"),
        F.lit(ncols).alias("data_columns"),
        F.concat_ws(" to ", F.date_format(F.min(date), "yyyy-MM-dd"),
                    F.date_format(F.max(date), "yyyy-MM-dd")).alias("date_range"))


def price_summary(df: DataFrame, col: str = "close") -> DataFrame:
    """A4: min, max, sample std ("volatility") and row count per symbol."""
    return df.groupBy("symbol").agg(
        F.min(col).alias("min_price"), F.max(col).alias("max_price"),
        F.stddev_samp(col).alias("volatility"), F.count(F.lit(1)).alias("n"))


def training_summary(metrics: DataFrame, keys=("symbol",)) -> DataFrame:
    """A5: one row per fitted symbol with mae and r2; failed fits are absent."""
    ok = metrics.where(F.col("mae").isNotNull())
    return ok.select(*keys, "mae", "r2")


def rank_models(metrics: DataFrame, score: str = "r2", partition=(), ascending: bool = False,
                tie: str = "symbol") -> DataFrame:
    """Rank by ``score`` (within ``partition``); rank 1 is 'Best', others 'Good'.
    Ties broken by ``tie`` so the ranking is deterministic. Without a partition the ranking is
    over all rows: range-partitioned, each partition's ranks offset by the rows before it."""
    order = F.col(score).asc_nulls_last() if ascending else F.col(score).desc_nulls_last()
    if partition:
        ranked = metrics.withColumn("rank", F.row_number().over(Window.partitionBy(*partition).orderBy(order, F.col(tie))))
    else:
        # the borders of a range partitioning are sampled, so it must be drawn once only
        placed = cut_lineage(metrics.repartitionByRange(order, F.col(tie)).sortWithinPartitions(order, F.col(tie))
                             .withColumn("_at", F.monotonically_increasing_id()))
        part = F.shiftright("_at", 33)
        rows = sorted((r["p"], r["n"]) for r in placed.groupBy(part.alias("p")).agg(F.count(F.lit(1)).alias("n")).collect())
        before, offsets = 0, [F.lit(-1).cast("long"), F.lit(0).cast("long")]
        for p, n in rows:
            offsets += [F.lit(p).cast("long"), F.lit(before).cast("long")]
            before += n
        rank = F.element_at(F.create_map(*offsets), part) + F.col("_at").bitwiseAND((1 << 33) - 1) + 1
        ranked = placed.withColumn("rank", rank.cast("int")).drop("_at")
    return ranked.withColumn("label", F.when(F.col("rank") == 1, F.lit("Best")).otherwise(F.lit("Good")))


def collect_stats(bars: DataFrame) -> DataFrame:
    """Number of symbols processed and the status message."""
    return bars.agg(F.count_distinct("symbol").alias("symbols")).select(
        "symbols", F.format_string("Successfully processed %d symbols", F.col("symbols")).alias("message"),
        F.lit(200).alias("status_code"))
