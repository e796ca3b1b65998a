"""Snapshot, quote, model-table and inventory queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark import oracle_sql as O
from tidemark.catalog import register
from tidemark.functions.presentation import rounded
from tidemark.plans.train import train_many
from tidemark.schemas import BARS
from tidemark.session import cut_lineage
from tidemark.sources import quotes as Q
from tidemark.sources import snapshots as S
from tidemark.sources.bars import bars_from
from tidemark.sources.tables import TABLES, event_ticks, read_table

R = O.round_all
BAR_D = ["open", "high", "low", "close"]
BAR_O = ["symbol", "date", "volume"]


def _stored_bars(spark, bars) -> str:
    """Two snapshots of one bar table, the older of its earlier days only."""
    root, bars = S.shared_path(spark, "snapshots"), cut_lineage(bars)
    S.write_snapshot(bars.where(F.col("date") < F.lit("1997-01-01").cast("date")), root, "20240101_090000")
    S.write_snapshot(bars, root, "20240102_090000")
    return root


def _snapshot_latest(spark, sf, prune=True):
    root = _stored_bars(spark, bars_from(spark, sf, "suppliers"))
    requested = read_table(spark, sf, "supplier").select(F.col("s_suppkey").cast("string").alias("symbol"))
    return S.read_latest_snapshot(spark, root, BARS, requested, prune)[0]


def _bar_columns(df):
    return rounded(df.select("symbol", "date", "open", "high", "low", "close", "volume"))


@register("snapshot_latest", R(O.bars("suppliers"), BAR_D, BAR_O))
def q_snapshot_latest(spark, sf):
    return _bar_columns(_snapshot_latest(spark, sf))


@register("snapshot_latest_join", R(O.bars("suppliers"), BAR_D, BAR_O))
def q_snapshot_latest_join(spark, sf):
    return _bar_columns(_snapshot_latest(spark, sf, prune=False))


def _split_history(spark, bars):
    """Symbols whose newest snapshots differ: an old one of all, a new one of the later days'
    symbols alone (those with a bar after 2000-01-01)."""
    root, bars = S.shared_path(spark, "snapshots"), cut_lineage(bars)
    S.write_snapshot(bars, root, "20240101_090000")
    S.write_snapshot(bars.where(F.col("date") >= F.lit("2000-01-01").cast("date")), root, "20240102_090000")
    return S.read_latest_snapshot(spark, root, BARS)[0]


def _split_sql(bars: str) -> str:
    return R(f"""SELECT b.* FROM ({bars}) b LEFT JOIN
      (SELECT DISTINCT symbol FROM ({bars}) n WHERE date >= DATE '2000-01-01') r ON r.symbol = b.symbol
      WHERE r.symbol IS NULL OR b.date >= DATE '2000-01-01'""", BAR_D, BAR_O)


@register("snapshot_latest_orders", _split_sql(
    f"SELECT replace(symbol, '-', '/') AS symbol, * EXCLUDE (symbol) FROM ({O.bars('orders')}) o"))
def q_snapshot_latest_orders(spark, sf):
    """Symbols with blanks and slashes."""
    bars = bars_from(spark, sf, "orders").withColumn("symbol", F.translate("symbol", "-", "/"))
    return _bar_columns(_split_history(spark, bars))


@register("snapshot_latest_brands", _split_sql(O.bars("brands")))
def q_snapshot_latest_brands(spark, sf):
    """Symbols with a number sign."""
    return _bar_columns(_split_history(spark, bars_from(spark, sf, "brands")))


@register("snapshot_missing", """SELECT DISTINCT event_type AS symbol FROM events
  WHERE event_type NOT IN (SELECT o_orderpriority FROM orders WHERE o_totalprice IS NOT NULL)""")
def q_snapshot_missing(spark, sf):
    """Event types and order priorities are asked for, only the latter have snapshots."""
    root = _stored_bars(spark, bars_from(spark, sf, "orders"))
    asked = read_table(spark, sf, "events").select(F.col("event_type").alias("symbol")).unionByName(
        read_table(spark, sf, "orders").select(F.col("o_orderpriority").alias("symbol")))
    return S.read_latest_snapshot(spark, root, BARS, asked)[1]


@register("quotes_json_roundtrip", """SELECT event_type AS symbol, strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') AS timestamp,
    value AS price, CAST(1 AS BIGINT) AS volume, 'collected' AS status FROM events""")
def q_quotes_json(spark, sf):
    root = S.shared_path(spark, "quotes")
    Q.write_quotes_json(Q.quotes_from_ticks(event_ticks(spark, sf)), root)
    return Q.read_quotes_json(spark, root).select("symbol", "timestamp", "price", "volume", "status")


@register("models_latest", """SELECT t.model_type, o.symbol, 'none' AS error,
    CASE WHEN t.model_type = 'linear' THEN '2024-01-02 00:00:00' ELSE '2024-01-01 00:00:00' END AS created_at
  FROM (SELECT DISTINCT o_orderpriority AS symbol FROM orders) o, (VALUES ('linear'), ('arima'), ('prophet'), ('lstm')) t(model_type)""")
def q_models_latest(spark, sf):
    """All types trained, the linear ones again a day later."""
    newest = _models_latest(spark, sf)
    return newest.select("model_type", "symbol", F.coalesce("error", F.lit("none")).alias("error"),
                         F.date_format("created_at", "yyyy-MM-dd HH:mm:ss").alias("created_at"))


def _models_latest(spark, sf):
    bars = bars_from(spark, sf, "orders")
    root = S.shared_path(spark, "models")
    S.write_models(train_many(bars, created_at="2024-01-01 00:00:00"), root)
    S.write_models(train_many(bars, ("linear",), "2024-01-02 00:00:00"), root)
    return S.load_latest_model(spark.read.parquet(root))


@register("file_inventory")
def q_file_inventory(spark, sf):
    out = None
    for t in TABLES:
        inv = S.file_inventory(spark, f"{sf.rstrip('/')}/{t}.parquet", t)
        out = inv if out is None else out.unionByName(inv)
    return out


@register("lifecycle_tiers", """SELECT symbol, CASE WHEN age >= 365 THEN 'DEEP_ARCHIVE' WHEN age >= 90 THEN 'GLACIER'
      WHEN age >= 30 THEN 'STANDARD_IA' ELSE 'STANDARD' END AS tier,
    count(*) AS objects, sum(volume) AS volume
  FROM (SELECT *, date_diff('day', date, DATE '2002-01-01') AS age FROM (""" + O.bars("brands") + """) b) a
  GROUP BY 1, 2""")
def q_lifecycle_tiers(spark, sf):
    b = bars_from(spark, sf, "brands")
    age = F.datediff(F.lit("2002-01-01").cast("date"), F.col("date"))
    return b.groupBy("symbol", S.lifecycle_tier(age).alias("tier")).agg(
        F.count(F.lit(1)).alias("objects"), F.sum("volume").alias("volume"))


# Snapshot days of the lifecycle query and the year whose bars each of them holds.
_RUNS = [("20240101_090000", 1995), ("20240915_090000", 1996), ("20241125_090000", 1997), ("20241230_090000", 1998)]
_AS_OF = "2025-01-01"


def _yearly_snapshots(spark, sf) -> str:
    """A snapshot per year of bars, the last one written twice (a run that was repeated)."""
    root, bars = S.shared_path(spark, "snapshots"), cut_lineage(bars_from(spark, sf, "brands"))
    for stamp, year in [*_RUNS, _RUNS[-1]]:
        S.write_snapshot(bars.where(F.year("date") == year), root, stamp)
    return root


_RUNS_SQL = ", ".join(f"('{stamp}', {year})" for stamp, year in _RUNS)


@register("snapshot_log", f"""SELECT stamp AS snapshot_ts, CASE WHEN count(symbol) > 0 THEN 1 ELSE 0 END AS has_bytes,
    count(symbol) AS n_rows, min(symbol) AS min_symbol, max(symbol) AS max_symbol
  FROM (VALUES {_RUNS_SQL}) r(stamp, y) LEFT JOIN ({O.bars('brands')}) b ON year(b.date) = r.y GROUP BY stamp""")
def q_snapshot_log(spark, sf):
    """Rows, bytes and symbol ranges of the snapshots, without reading their data."""
    log = S.snapshot_log(spark, _yearly_snapshots(spark, sf))
    return log.select("snapshot_ts", (F.col("bytes") > 0).cast("int").alias("has_bytes"), "n_rows", "min_symbol", "max_symbol")


@register("lifecycle_snapshots", f"""SELECT tier, count(DISTINCT stamp) AS snapshots, CASE WHEN count(symbol) > 0 THEN 1 ELSE 0 END AS has_bytes,
    count(symbol) AS n_rows
  FROM (SELECT stamp, y, CASE WHEN age >= 365 THEN 'DEEP_ARCHIVE' WHEN age >= 90 THEN 'GLACIER' WHEN age >= 30 THEN 'STANDARD_IA' ELSE 'STANDARD' END AS tier
        FROM (SELECT stamp, y, date_diff('day', CAST(strptime(stamp, '%Y%m%d_%H%M%S') AS DATE), DATE '{_AS_OF}') AS age
              FROM (VALUES {_RUNS_SQL}) r(stamp, y)) a) t
  LEFT JOIN ({O.bars('brands')}) b ON year(b.date) = t.y GROUP BY tier""")
def q_lifecycle_snapshots(spark, sf):
    """A9 on stored snapshots: how many, how many rows and whether any bytes are in each tier."""
    tiers = S.lifecycle_tiers(S.snapshot_log(spark, _yearly_snapshots(spark, sf)), _AS_OF)
    return tiers.select("tier", "snapshots", (F.col("bytes") > 0).cast("int").alias("has_bytes"), "n_rows")


@register("snapshot_symbols", R(f"SELECT * FROM ({O.bars('brands')}) b WHERE year(date) = 1997 AND symbol IN (SELECT DISTINCT p_brand FROM part WHERE p_size = 7)", BAR_D, BAR_O))
def q_snapshot_symbols(spark, sf):
    """One snapshot's bars of some symbols (the brands that have parts of one size), from the files whose range holds them."""
    brands = [r["p_brand"] for r in read_table(spark, sf, "part").where("p_size = 7").select("p_brand").distinct().collect()]
    return _bar_columns(S.read_snapshot(spark, _yearly_snapshots(spark, sf), BARS, "20241125_090000", brands))
