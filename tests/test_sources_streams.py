import pytest
from pyspark.sql import functions as F

from tests.conftest import SF_SMALL
from tidemark.schemas import BARS
from tidemark.sources import snapshots as S
from tidemark.sources.bars import bars_from, ticks_to_bars
from tidemark.sources.tables import event_ticks
from tidemark.sources import quotes as Q
from tidemark.streaming import streams as ST


def test_f4_snapshot_roundtrip(spark):
    df = spark.createDataFrame([("AAPL", 100, 1000), ("AAPL", 101, 1100), ("AAPL", 102, 1200)],
                               "symbol string, close long, volume long")
    root = S.shared_path(spark, "test-snap")
    S.write_snapshot(df, root, "20240101_000000")
    back = spark.read.parquet(f"{root}/data")
    assert back.count() == 3
    assert back.select("symbol", "snapshot_ts").distinct().count() == 1


def test_latest_snapshot_and_missing(spark):
    bars = bars_from(spark, SF_SMALL, "orders")
    root = S.shared_path(spark, "test-snap2")
    S.write_snapshot(bars.where(F.col("date") < F.lit("1996-01-01").cast("date")), root, "20240101_000000")
    S.write_snapshot(bars, root, "20240102_000000")
    req = spark.createDataFrame([("1-URGENT",), ("INVALID",)], "symbol string")
    latest, missing = S.read_latest_snapshot(spark, root, BARS, req)
    assert [r.symbol for r in missing.collect()] == ["INVALID"]
    assert latest.count() == bars.where(F.col("symbol") == "1-URGENT").count()
    assert {r.snapshot_ts for r in latest.select("snapshot_ts").distinct().collect()} == {"20240102_000000"}


def test_latest_snapshot_keeps_every_name(spark):
    names = ["4-NOT SPECIFIED", "Brand#12", "a/b", "x=y", "%20", "", "é:*?"]
    rows = [(n, i) for i, n in enumerate(names)]
    root = S.shared_path(spark, "test-names")
    schema = "symbol string, close int"
    S.write_snapshot(spark.createDataFrame(rows, schema), root, "20240101_000000")
    S.write_snapshot(spark.createDataFrame([(n, i + 100) for n, i in rows[::2]], schema), root, "20240102_000000")
    asked = spark.createDataFrame([(n,) for n in [*names, "gone"]], "symbol string")
    for prune in (True, False):
        latest, missing = S.read_latest_snapshot(spark, root, spark.createDataFrame([], schema).schema, asked, prune)
        assert {r.symbol: r.close for r in latest.collect()} == {n: i + 100 * (i % 2 == 0) for n, i in rows}
        assert [r.symbol for r in missing.collect()] == ["gone"]


_CLOSES = "symbol string, close long"


def _closes(spark, *rows):
    return spark.createDataFrame(rows, _CLOSES)


def _latest(spark, root):
    got, _ = S.read_latest_snapshot(spark, root, spark.createDataFrame([], _CLOSES).schema)
    return sorted((r.symbol, r.close, r.snapshot_ts) for r in got.collect())


def test_repeated_stamp_is_one_snapshot(spark):
    root = S.shared_path(spark, "test-repeat")
    for close in (1, 2, 2):
        S.write_snapshot(_closes(spark, ("A", close), ("B", close)), root, "20240101_000000")
    assert _latest(spark, root) == [("A", 2, "20240101_000000"), ("B", 2, "20240101_000000")]
    log = S.snapshot_log(spark, root).collect()
    assert [(r.snapshot_ts, r.version, r.n_rows, r.min_symbol, r.max_symbol) for r in log] == [("20240101_000000", 2, 2, "A", "B")]
    assert log[0].bytes > 0


def test_half_failed_write_is_never_seen(spark, monkeypatch):
    root = S.shared_path(spark, "test-crash")
    S.write_snapshot(_closes(spark, ("A", 1)), root, "20240101_000000")

    def crash(*args):
        raise OSError("lost")

    with monkeypatch.context() as m:  # data and manifest are written, the commit is not
        m.setattr(S.commits, "append", crash)
        with pytest.raises(OSError):
            S.write_snapshot(_closes(spark, ("A", 9), ("C", 9)), root, "20240102_000000")
    assert _latest(spark, root) == [("A", 1, "20240101_000000")]
    S.write_snapshot(_closes(spark, ("A", 2)), root, "20240102_000000")
    assert _latest(spark, root) == [("A", 2, "20240102_000000")]
    assert S.remove_uncommitted(spark, root, 0) == []
    assert len(S.remove_uncommitted(spark, root, 1 << 62)) == 1
    assert _latest(spark, root) == [("A", 2, "20240102_000000")]


def test_writers_never_share_a_version(spark):
    root = S.shared_path(spark, "test-race")
    one = [{"file": "f", "bytes": 1, "n_rows": 1, "min_symbol": "A", "max_symbol": "A"}]
    assert S.commits.append(spark, root, "20240101_000000", "x", one) == 0
    listed = S.commits._versions
    try:
        S.commits._versions = lambda *a: []  # a writer that has not seen the other's commit
        assert S.commits.append(spark, root, "20240102_000000", "y", one) == 1
    finally:
        S.commits._versions = listed
    assert {(r.version, r.id) for r in S.commits.live(spark, root).collect()} == {(0, "x"), (1, "y")}


def test_symbol_ranges_skip_files(spark):
    root = S.shared_path(spark, "test-ranges")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        S.write_snapshot(_closes(spark, *[(f"S{i:03d}", i) for i in range(400)]), root, "20240101_000000")
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    schema = spark.createDataFrame([], _CLOSES).schema
    got = S.read_snapshot(spark, root, schema, "20240101_000000", ["S007", "S390", "none"])
    assert sorted((r.symbol, r.close) for r in got.collect()) == [("S007", 7), ("S390", 390)]
    assert len(S.commits.live(spark, root).collect()) > 4
    assert len(got.inputFiles()) == 2
    asked = spark.createDataFrame([("S007",), ("S008",)], "symbol string")
    latest, _ = S.read_latest_snapshot(spark, root, schema, asked)
    assert latest.count() == 2 and len(latest.inputFiles()) == 1


def test_empty_store_and_empty_snapshot(spark):
    root = S.shared_path(spark, "test-empty")
    asked = spark.createDataFrame([("A",)], "symbol string")
    schema = spark.createDataFrame([], _CLOSES).schema
    for _ in range(2):
        latest, missing = S.read_latest_snapshot(spark, root, schema, asked)
        assert latest.count() == 0 and [r.symbol for r in missing.collect()] == ["A"]
        S.write_snapshot(_closes(spark), root, "20240101_000000")
    assert [(r.files, r.bytes, r.n_rows) for r in S.snapshot_log(spark, root).collect()] == [(0, 0, 0)]


def _late_quotes(spark, src, rows):
    Q.write_quotes_json(spark.createDataFrame(rows, "symbol string, timestamp string, price double, volume long, status string"), src)


def test_streams_lose_nothing_that_comes_late(spark):
    src, bars, tumble, dedup = (S.shared_path(spark, f"test-{n}") for n in ("quotes", "bars", "tumble", "dedup"))

    def run():
        s = ST.quote_stream(spark, src)
        ST.run_merge(s.withColumn("tick_id", F.lit(0).cast("long")), bars, f"{bars}-ck", ST.daily_bars)
        ST.run_merge(s, tumble, f"{tumble}-ck", lambda r: ST.tumbling_metrics(r).withColumn("day", F.to_date("window_start")))
        ST.run_dedup(s, dedup, f"{dedup}-ck")

    day = [("A", "2024-03-02T10:00:00.000000", 5.0, 1, "collected"), ("A", "2024-03-02T23:59:00.000000", 7.0, 2, "collected"),
           ("B", "2024-03-02T10:01:00.000000", None, 1, "error")]
    _late_quotes(spark, src, day)
    run()
    _late_quotes(spark, src, day[:2] + [("A", "2024-03-02T09:00:00.000000", 9.0, 4, "collected"),
                                        ("A", "2020-01-01T00:00:00.000000", 1.0, 1, "collected"), ("A", "not a time", 1.0, 1, "collected")])
    run()
    run()  # nothing new
    got = {(r.symbol, str(r.day)): (r.open, r.high, r.low, r.close, r.volume) for r in spark.read.parquet(f"{bars}/state").collect()}
    assert got == {("A", "2024-03-02"): (9.0, 9.0, 5.0, 7.0, 10), ("A", "2020-01-01"): (1.0, 1.0, 1.0, 1.0, 1)}
    n = spark.read.parquet(f"{tumble}/state").groupBy("symbol").agg(F.sum("invocations").alias("n"), F.sum("errors").alias("e")).collect()
    assert {(r.symbol, r.n, r.e) for r in n} == {("A", 6, 0), ("B", 1, 1)}
    kept = spark.read.parquet(f"{dedup}/kept")
    assert kept.count() == 5 and kept.select("symbol", "ts").distinct().count() == 5
    assert spark.read.parquet(f"{tumble}/rejected").count() == 1

def test_ingest_stream_is_incremental(spark):
    src = S.shared_path(spark, "test-in")
    q = Q.quotes_from_ticks(event_ticks(spark, SF_SMALL))
    Q.write_quotes_json(q, src)
    bronze, ck = S.shared_path(spark, "test-bronze"), S.shared_path(spark, "test-bronze-ck")
    ST.ingest_quotes_stream(spark, src, bronze, ck)
    ST.ingest_quotes_stream(spark, src, bronze, ck)
    assert spark.read.parquet(bronze).count() == q.count()


def _quote(symbol, ts, price, status="collected"):
    return (symbol, ts, price, 1, status)


def test_fold_keeps_one_row_per_key_and_recovers_late_rows(spark):
    src, root = S.shared_path(spark, "test-fold-in"), S.shared_path(spark, "test-fold")
    sent = []

    def run(*rows):
        _late_quotes(spark, src, list(rows))
        sent.extend(rows)
        ST.run_fold(ST.quote_stream(spark, src), root, f"{root}-ck", lambda r: ST.tumbling_partials(r, minutes=7),
                    ST.merge_tumbling, compact_every=2)
        got = ST.finished_tumbling(spark.read.parquet(f"{root}/state"))
        rows = spark.createDataFrame(sent, "symbol string, timestamp string, price double, volume long, status string")
        want = ST.tumbling_metrics(rows.withColumn("ts", F.try_to_timestamp("timestamp")).where("ts is not null"), minutes=7)
        text = lambda df: sorted(str((r.window_start, r.symbol, r.invocations, r.errors, round(r.avg_value or 0, 9))) for r in df.collect())
        assert text(got) == text(want)

    run(*[_quote("A", f"2024-03-02T23:5{i}:00.000000", float(i)) for i in range(10)])  # windows of 7 minutes cross midnight
    run(_quote("A", "2024-03-03T10:01:00.000000", 5.0), _quote("A", "not a time", 1.0), _quote("B", "2024-03-03T00:01:00.000000", None, "error"))
    run(*[_quote("A", f"2024-03-02T23:5{i}:30.000000", 1.0) for i in range(4)])  # late
    run(_quote("C", "2024-03-01T10:00:00.000000", 2.0))
    run(*[_quote("A", "2024-03-03T00:01:00.000000", float(i)) for i in range(50)])
    late = spark.read.parquet(f"{root}/late").groupBy("batch").agg(F.sum("n_rows").alias("n")).collect()
    assert {r.batch: r.n for r in late} == {2: 4, 3: 1}
    assert spark.read.parquet(f"{root}/rejected").count() == 1
    # what is kept follows the keys: a base, and the partials since
    kept = [p for p, _ in S.commits.names_in(spark, f"{root}/partials")]
    assert sorted(kept) == ["batch=2", "batch=3", "batch=4"]
    state = spark.read.parquet(f"{root}/state").count()
    assert spark.read.parquet(f"{root}/base/upto=3").count() <= state < len(sent)


def test_replayed_batch_changes_nothing(spark):
    src, root = S.shared_path(spark, "test-replay-in"), S.shared_path(spark, "test-replay")

    def run(checkpoint):
        stream = ST.quote_stream(spark, src).withColumn("tick_id", F.lit(0).cast("long"))
        ST.run_fold(stream, root, checkpoint, ST.bar_partials, ST.merge_bars, compact_every=1)
        return sorted(map(tuple, ST.finished_bars(spark.read.parquet(f"{root}/state")).collect()))

    _late_quotes(spark, src, [_quote("A", "2024-03-02T10:00:00.000000", 5.0), _quote("A", "2024-03-02T11:00:00.000000", 7.0)])
    first = run(f"{root}-ck")
    assert run(f"{root}-other") == first  # batch 0 once more, as after a lost checkpoint
    _late_quotes(spark, src, [_quote("A", "2024-03-02T09:00:00.000000", 9.0)])
    assert [r[2:] for r in run(f"{root}-other")] == [(9.0, 9.0, 5.0, 7.0, 3)]
