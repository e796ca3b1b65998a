"""Supervised datasets.

Positional semantics follow the reference: rows are numbered after incomplete
rows are dropped; the split is by position, per symbol. All windows use
``partitionBy("symbol")`` so they share one exchange with the indicators.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.operators.blocks import chunk_window, in_chunks, own_rows, positioned
from tidemark.operators.cleaning import SEQUENCE_FEATURES

# Fixed values of the reference: look-back length and train share.
LOOKBACK = 60
TRAIN_NUM, TRAIN_DEN = 4, 5  # int(n * 0.8) as exact integer arithmetic


def by_symbol(order: str | None = "date"):
    w = Window.partitionBy("symbol")
    return w.orderBy(order) if order else w


def minmax_scale(x: Column, lo: Column, hi: Column) -> Column:
    """(x-min)/(max-min); a constant column scales to 0."""
    return F.when(hi > lo, (x - lo) / (hi - lo)).otherwise(F.lit(0.0))


def minmax_inverse(y: Column, lo: Column, hi: Column) -> Column:
    """y·(max-min)+min."""
    return y * (hi - lo) + lo


def train_size(n: Column) -> Column:
    return F.floor(n * F.lit(TRAIN_NUM) / F.lit(TRAIN_DEN)).cast("long")


def chronological_split(df: DataFrame, order: str = "date", blocked: bool = False) -> DataFrame:
    """``split`` = train for the first int(0.8·n) rows of each symbol, else test.

    Adds ``rn`` (1-based position) and ``n`` (rows of the symbol). ``blocked`` takes both from
    per-block counts (see ``blocks``), so no task holds a symbol."""
    if blocked:
        numbered = positioned(df, order=order)
        rn, n = F.col("_rn").cast("int"), F.col("_n")
    else:
        numbered, rn, n = df, F.row_number().over(by_symbol(order)), F.count(F.lit(1)).over(by_symbol(None))
    return (numbered.withColumn("rn", rn).withColumn("n", n).drop("_rn", "_n")
            .withColumn("split", F.when(F.col("rn") <= train_size(F.col("n")), F.lit("train"))
                        .otherwise(F.lit("test"))))


def tail_n(df: DataFrame, n: int, order: str = "date") -> DataFrame:
    """The last ``n`` rows of each symbol."""
    return (df.withColumn("_rn", F.row_number().over(by_symbol(order)))
            .withColumn("_cnt", F.count(F.lit(1)).over(by_symbol(None)))
            .where(F.col("_rn") > F.col("_cnt") - n).drop("_rn", "_cnt"))


def minmax_fit(df: DataFrame, features=SEQUENCE_FEATURES, fit_on: str = "all") -> DataFrame:
    """A2: per-symbol, per-feature min and max, long form ``(symbol, feature, min, max)``.

    ``fit_on="all"`` fits on every row (the reference's behaviour, which leaks
    test rows into the scaler); ``"train"`` fits on the train split only.
    A partial aggregate: one row per symbol leaves each map task.
    """
    src = df
    if fit_on == "train":
        src = chronological_split(df).where(F.col("split") == "train")
    aggs = []
    for c in features:
        aggs += [F.min(c).alias(f"{c}__min"), F.max(c).alias(f"{c}__max")]
    wide = src.groupBy("symbol").agg(*aggs)
    pairs = F.array(*[F.struct(F.lit(c).alias("feature"), F.col(f"{c}__min").alias("min"),
                               F.col(f"{c}__max").alias("max")) for c in features])
    return wide.select("symbol", F.inline(pairs))


def scale_features(df: DataFrame, features=SEQUENCE_FEATURES, fit_on: str = "all") -> DataFrame:
    """F1 applied per symbol with the A2 parameters, computed as window
    aggregates on the same ``symbol`` partitioning (no extra exchange).
    Adds ``<feature>_min``/``_max`` so predictions can be inverted (F2)."""
    w = by_symbol(None)
    if fit_on == "train":
        df = chronological_split(df)
        cond = F.col("split") == "train"
        lo = {c: F.min(F.when(cond, F.col(c))).over(w) for c in features}
        hi = {c: F.max(F.when(cond, F.col(c))).over(w) for c in features}
    else:
        lo = {c: F.min(c).over(w) for c in features}
        hi = {c: F.max(c).over(w) for c in features}
    keep = [c for c in df.columns if c not in features]
    return df.select(*keep,
                     *[minmax_scale(F.col(c), lo[c], hi[c]).alias(c) for c in features],
                     *[lo[c].alias(f"{c}_min") for c in features],
                     *[hi[c].alias(f"{c}_max") for c in features])


def lookback_sequences(scaled: DataFrame, features=SEQUENCE_FEATURES, lookback: int = LOOKBACK,
                       target: str = "close", block_rows: int | None = None) -> DataFrame:
    """For row i ≥ L, ``x`` = the L previous rows' features (array of structs),
    ``y`` = row i's (scaled) target. Exactly n − L samples per symbol.

    Input must already be complete (P2) and scaled (F1). Built over a bounded
    frame of L rows, so memory per row is fixed (L × features doubles).
    """
    step = F.struct(*[F.col(c).alias(c) for c in features])
    keep = [c for c in scaled.columns if c not in features]
    if block_rows is None:
        rows, w, marks = scaled, by_symbol(), []
    else:
        rows, w, marks = in_chunks(positioned(scaled), block_rows, before=lookback), chunk_window(), ["_own", "_chunk"]
    out = rows.select(*keep, *marks, F.collect_list(step).over(w.rowsBetween(-lookback, -1)).alias("x"), F.col(target).alias("y"))
    return (own_rows(out) if marks else out).where(F.size("x") == lookback)
