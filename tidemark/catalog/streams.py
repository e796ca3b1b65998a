"""Streaming queries (T1-T5) and their batch forms."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark import oracle_sql as O
from tidemark.catalog import register
from tidemark.catalog.models import AS_OF, order_requests
from tidemark.functions.presentation import rounded
from tidemark.plans import predict as P
from tidemark.plans.train import train_many
from tidemark.sources import quotes as Q
from tidemark.session import cut_lineage
from tidemark.sources.bars import bars_from
from tidemark.sources.snapshots import shared_path
from tidemark.sources.tables import event_ticks, read_table
from tidemark.streaming import streams as ST


def _two_runs(spark, sf, run, replay: bool = False) -> None:
    """Quote files of ``events`` in two scheduled runs on one checkpoint: first the later half
    of the time span, then the earlier half, all of it late (and, with ``replay``, the first
    files once more)."""
    root = shared_path(spark, "quotes-in")
    ticks = event_ticks(spark, sf)
    lo, hi = ticks.agg(F.min("ts"), F.max("ts")).first()
    middle = F.lit(lo + (hi - lo) / 2) if lo is not None else F.lit(None)
    late = F.coalesce(F.col("ts") < middle, F.lit(False))
    quotes = Q.quotes_from_ticks(ticks.where(~late))
    Q.write_quotes_json(quotes, root)
    run(root)
    Q.write_quotes_json(Q.quotes_from_ticks(ticks.where(late)), root)
    if replay:
        Q.write_quotes_json(quotes, root)
    run(root)


_TUMBLE_SQL = O.round_all("""SELECT strftime(to_timestamp(floor(epoch_us(ts) / 300000000) * 300), '%Y-%m-%d %H:%M:%S') AS window_start,
    event_type AS symbol, count(*) AS invocations,
    count(*) - count(value) AS errors, avg(value) AS avg_value, sum(value) AS sum_value
  FROM events GROUP BY 1, 2""", ["avg_value", "sum_value"], ["window_start", "symbol", "invocations", "errors"])


@register("tumbling_metrics", _TUMBLE_SQL)
def q_tumbling_metrics(spark, sf):
    e = event_ticks(spark, sf).withColumn("ts", F.col("ts").cast("timestamp"))
    out = ST.tumbling_metrics(e, "ts", "symbol", "price", 5)
    return rounded(out.withColumn("window_start", F.date_format("window_start", "yyyy-MM-dd HH:mm:ss")))


@register("tumbling_metrics_stream", _TUMBLE_SQL)
def q_tumbling_metrics_stream(spark, sf):
    root, ck = shared_path(spark, "tumble"), shared_path(spark, "tumble-ck")

    _two_runs(spark, sf, lambda src: ST.run_fold(ST.quote_stream(spark, src), root, ck, ST.tumbling_partials, ST.merge_tumbling))
    out = ST.finished_tumbling(spark.read.parquet(f"{root}/state"))
    return rounded(out.withColumn("window_start", F.date_format("window_start", "yyyy-MM-dd HH:mm:ss")))


_DEDUP_SQL = """SELECT event_type AS symbol, strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS ts, value AS price, event_id AS tick_id
  FROM (SELECT *, row_number() OVER (PARTITION BY event_type, ts ORDER BY event_id) AS rn
        FROM (SELECT * FROM events UNION ALL SELECT * FROM events) d) x WHERE rn = 1"""


@register("dedup_quotes", _DEDUP_SQL)
def q_dedup_quotes(spark, sf):
    t = event_ticks(spark, sf)
    d = ST.dedup_quotes(t.unionByName(t))
    return d.select("symbol", F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("ts"), "price", "tick_id")


@register("dedup_quotes_stream", """SELECT DISTINCT event_type AS symbol,
    strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS ts, value AS price FROM events""")
def q_dedup_quotes_stream(spark, sf):
    root, ck = shared_path(spark, "dedup"), shared_path(spark, "dedup-ck")
    _two_runs(spark, sf, lambda src: ST.run_dedup(ST.quote_stream(spark, src), root, ck, ("symbol", "ts", "price")), replay=True)
    out = spark.read.parquet(f"{root}/kept")
    return out.select("symbol", F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("ts"), "price")


@register("ingest_quotes_stream", """SELECT event_type AS symbol, strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS ts,
    value AS price, CAST(1 AS BIGINT) AS volume FROM events""")
def q_ingest_quotes_stream(spark, sf):
    bronze, ck = shared_path(spark, "bronze"), shared_path(spark, "bronze-ck")
    _two_runs(spark, sf, lambda src: ST.ingest_quotes_stream(spark, src, bronze, ck))
    b = spark.read.parquet(bronze)
    return b.select("symbol", F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("ts"), "price", "volume")


@register("stream_bars", O.round_all(f"""SELECT symbol, date, open, high, low, close, volume
  FROM ({O.bars('events')}) b""", ["open", "high", "low", "close"], ["symbol", "date", "volume"]))
def q_stream_bars(spark, sf):
    root, ck = shared_path(spark, "bars"), shared_path(spark, "bars-ck")

    def run(src):
        ticks = ST.quote_stream(spark, src).withColumn("tick_id", F.lit(0).cast("long"))
        ST.run_fold(ticks, root, ck, ST.bar_partials, ST.merge_bars)

    _two_runs(spark, sf, run)
    out = ST.finished_bars(spark.read.parquet(f"{root}/state"))
    return rounded(out.select("symbol", F.col("day").alias("date"), "open", "high", "low", "close", "volume"))


@register("score_requests_stream")
def q_score_requests_stream(spark, sf):
    """Requests in two runs, each answered from the forecasts of all model types."""
    bars = cut_lineage(bars_from(spark, sf, "orders"))
    fc = cut_lineage(P.forecast_table(cut_lineage(train_many(bars, created_at=AS_OF)), bars))
    src, sink, ck = (shared_path(spark, n) for n in ("requests-in", "responses", "responses-ck"))
    schema = "request_id string, symbol string, model_type string, days_ahead int"
    requests = order_requests(spark, sf)
    events = F.col("request_id").startswith("evt-")
    for part in (requests.where(~events), requests.where(events)):
        part.write.mode("append").json(src)
        ST.run_to_sink(spark.readStream.schema(schema).json(src), sink, ck,
                       transform=lambda b: P.predict_batch(b, fc, AS_OF))
    return ST.read_sink(spark, sink)
