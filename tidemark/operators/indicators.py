"""Per-symbol rolling indicators over daily bars.

All rolling windows are full-window only: a value exists once the frame holds
``n`` non-NULL inputs, matching a rolling mean with ``min_periods = n``. Every
indicator is computed over one window specification, so the plan has a single
exchange on ``symbol`` and a single sort on ``date`` for all of them.

Two physical strategies produce identical rows:

* ``block_rows=None`` — one window partition per symbol. Daily bars hold at most
  one row per (symbol, day), so a partition is bounded by the calendar (about
  25k rows per century) no matter how large the input tick table is.
* ``block_rows=B`` — blocked windows for long intraday series or hot symbols:
  see ``blocks``; the last ``HALO`` rows of every chunk are copied into the next one.
"""

from __future__ import annotations

import numpy as np
from numpy.lib.stride_tricks import sliding_window_view
from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from tidemark.operators.blocks import chunk_window, in_chunks, own_rows, positioned

# Fixed values of the reference's indicator set.
MA_WINDOWS = (5, 20, 50)
RSI_WINDOW = 14
BB_WINDOW = 20
BB_K = 2.0
VOLUME_WINDOW = 20

INDICATOR_COLUMNS = ["MA_5", "MA_20", "MA_50", "RSI", "BB_Middle", "BB_Upper",
                     "BB_Lower", "Volume_MA"]
# Rows of history a frame may reach back: MA_50 needs 49; RSI needs 13 gains
# plus the lag of the oldest one (14).
HALO = max(max(MA_WINDOWS), BB_WINDOW, VOLUME_WINDOW, RSI_WINDOW + 1) - 1


def symbol_window(order: str = "date") -> WindowSpec:
    return Window.partitionBy("symbol").orderBy(order)


def rolling(c: Column | str, n: int, w: WindowSpec, fn=F.avg) -> Column:
    """``fn`` over the last ``n`` rows, NULL unless all ``n`` inputs are non-NULL."""
    c = F.col(c) if isinstance(c, str) else c
    frame = w.rowsBetween(-(n - 1), 0)
    return F.when(F.count(c).over(frame) == n, fn(c).over(frame))


def moving_average(c: Column | str, n: int, w: WindowSpec) -> Column:
    """W1."""
    return rolling(c, n, w, F.avg)


def diff(c: Column | str, w: WindowSpec) -> Column:
    """Current minus previous row; NULL on the first row."""
    c = F.col(c) if isinstance(c, str) else c
    return c - F.lag(c, 1).over(w)


def gain_loss(delta: Column) -> tuple[Column, Column]:
    """Positive and negative parts; a NULL delta counts as 0 in both."""
    return (F.when(delta > 0, delta).otherwise(F.lit(0.0)),
            F.when(delta < 0, -delta).otherwise(F.lit(0.0)))


def rsi_from_means(avg_gain: Column, avg_loss: Column) -> Column:
    """W4 ratio: 100 - 100/(1+g/l); l = 0 → 100 when g > 0, NULL when both 0."""
    return (F.when(avg_loss > 0, F.lit(100.0) - F.lit(100.0) / (F.lit(1.0) + avg_gain / avg_loss))
            .when(avg_gain > 0, F.lit(100.0)))


def _indicators(df: DataFrame, w: WindowSpec, keep: list[str]) -> DataFrame:
    """W8 over one window spec; two projections because RSI averages a windowed delta."""
    gain, loss = gain_loss(diff("close", w))
    step1 = df.select(*keep, gain.alias("_gain"), loss.alias("_loss"))
    rsi_frame = w.rowsBetween(-(RSI_WINDOW - 1), 0)
    enough = F.count("_gain").over(rsi_frame) == RSI_WINDOW
    mid = moving_average("close", BB_WINDOW, w)
    std = rolling("close", BB_WINDOW, w, F.stddev_samp)
    out = step1.select(
        *keep,
        *[moving_average("close", n, w).alias(f"MA_{n}") for n in MA_WINDOWS],
        F.when(enough, rsi_from_means(F.avg("_gain").over(rsi_frame),
                                      F.avg("_loss").over(rsi_frame))).alias("RSI"),
        mid.alias("BB_Middle"),
        (mid + F.lit(BB_K) * std).alias("BB_Upper"),
        (mid - F.lit(BB_K) * std).alias("BB_Lower"),
        moving_average("volume", VOLUME_WINDOW, w).alias("Volume_MA"),
    )
    return out


def add_indicators(bars: DataFrame, block_rows: int | None = None,
                   block_days: int = 256) -> DataFrame:
    """MA_5/20/50, RSI(14), Bollinger(20, 2), Volume_MA(20) for all symbols."""
    keep = bars.columns
    if block_rows is None:
        return _indicators(bars, symbol_window("date"), keep)
    rows = in_chunks(positioned(bars, block_days), block_rows, before=HALO)
    return own_rows(_indicators(rows, chunk_window(), keep + ["_own", "_chunk", "_rn"]), "_rn")


def envelope(close: Column | str = "close", pct: float = 0.02) -> tuple[Column, Column]:
    """Simplified bands close·(1±pct)."""
    c = F.col(close) if isinstance(close, str) else close
    return (c * F.lit(1.0 + pct)).alias("BB_Upper"), (c * F.lit(1.0 - pct)).alias("BB_Lower")


def simple_features(bars: DataFrame) -> DataFrame:
    """W6 + W7 feature set: MA_5, MA_20, constant RSI 50, Volume_MA and
    envelope bands (the simplified training/demo features)."""
    w = symbol_window()
    up, lo = envelope()
    return bars.select(*bars.columns,
                       moving_average("close", 5, w).alias("MA_5"),
                       moving_average("close", 20, w).alias("MA_20"),
                       F.lit(50.0).alias("RSI"),
                       moving_average("volume", VOLUME_WINDOW, w).alias("Volume_MA"),
                       up, lo)


def next_target(df: DataFrame, col: str = "close", name: str = "target", block_rows: int | None = None) -> DataFrame:
    """Next row's value; rows without a next row are dropped."""
    if block_rows is None:
        return df.withColumn(name, F.lead(col, 1).over(symbol_window())).where(F.col(name).isNotNull())
    rows = in_chunks(positioned(df), block_rows, after=1)
    return own_rows(rows.withColumn(name, F.lead(col, 1).over(chunk_window())), "_rn", "_n").where(F.col(name).isNotNull())


def latest_row(df: DataFrame, cols=("close",)) -> DataFrame:
    """Last value per symbol by date (a partial aggregate, no sort)."""
    return df.groupBy("symbol").agg(
        F.max("date").alias("as_of"),
        *[F.max_by(c, "date").alias(f"last_{c}") for c in cols])


# ------------------------------------------------------------------ the same on the arrays of one symbol
def trailing(x: np.ndarray, n: int, fn=np.mean, **args) -> np.ndarray:
    """``rolling`` of one symbol's rows: ``fn`` over the last ``n`` values, NaN (null) unless all are there."""
    out = np.full(len(x), np.nan)
    if len(x) >= n:
        out[n - 1:] = fn(sliding_window_view(x, n), axis=-1, **args)
    return out


def indicator_arrays(close: np.ndarray, volume: np.ndarray) -> dict[str, np.ndarray]:
    """``add_indicators`` of one symbol's rows in date order; NaN is null."""
    delta = np.diff(close, prepend=np.nan)
    gain, loss = (trailing(np.where(d > 0, d, 0.0), RSI_WINDOW) for d in (delta, -delta))
    with np.errstate(divide="ignore", invalid="ignore"):
        rsi = np.where(loss > 0, 100.0 - 100.0 / (1.0 + gain / loss), np.where(gain > 0, 100.0, np.nan))
    mid, std = trailing(close, BB_WINDOW), trailing(close, BB_WINDOW, np.std, ddof=1)
    return {**{f"MA_{n}": trailing(close, n) for n in MA_WINDOWS}, "RSI": rsi, "BB_Middle": mid, "BB_Upper": mid + BB_K * std,
            "BB_Lower": mid - BB_K * std, "Volume_MA": trailing(volume, VOLUME_WINDOW)}


def simple_feature_arrays(close: np.ndarray, volume: np.ndarray) -> dict[str, np.ndarray]:
    """The columns that ``simple_features`` adds, of one symbol's rows in date order (its bands are null where close is)."""
    return {"MA_5": trailing(close, 5), "MA_20": trailing(close, 20), "RSI": np.full(len(close), 50.0),
            "Volume_MA": trailing(volume, VOLUME_WINDOW)}
