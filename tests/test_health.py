import datetime as dt

from pyspark.sql import functions as F

from tidemark.plans import health as H
from tidemark.sources import snapshots as S


def test_f11_health_and_alert(spark):
    expected = spark.createDataFrame([("s3",), ("lambda",), ("eventbridge",)], "resource string")
    inventory = spark.createDataFrame(
        [("s3", 3, 2048, 2.0, dt.datetime(2024, 1, 1)), ("eventbridge", 1, 10, 0.01, dt.datetime(2024, 1, 1))],
        "resource string, files long, bytes long, size_kb double, latest_modified timestamp")
    rows, summary = H.health_report(H.expected_vs_present(expected, inventory))
    status = {r.resource: r.status for r in rows.collect()}
    assert status == {"s3": "healthy", "lambda": "missing", "eventbridge": "healthy"}
    assert summary.first().resources_healthy is False
    alert = H.alerts(rows, "2024-01-02 10:30:00").first()
    assert alert.missing == ["LAMBDA"] and alert.message.endswith("- LAMBDA is missing")
    assert H.alerts(rows.where("status = 'healthy'"), "2024-01-02 10:30:00").count() == 0


def test_empty_stale_and_absent(spark):
    root = S.shared_path(spark, "test-health")
    none = spark.createDataFrame([], "ts timestamp")
    none.write.parquet(f"{root}/empty.parquet")
    spark.createDataFrame([(dt.datetime(2020, 1, 1),)], "ts timestamp").write.parquet(f"{root}/old.parquet")
    spark.createDataFrame([(dt.datetime(2024, 1, 1),)], "ts timestamp").write.parquet(f"{root}/new.parquet")
    data = H.freshness({n: (spark.read.parquet(f"{root}/{n}.parquet"), "ts") for n in ("empty", "old", "new")})
    expected = spark.createDataFrame([("empty",), ("old",), ("new",), ("gone",)], "resource string")
    per = H.expected_vs_present(expected, S.table_inventory(spark, root), data, "2024-01-02 00:00:00", 30)
    assert {r.resource: r.status for r in per.collect()} == {"empty": "empty", "old": "stale", "new": "healthy", "gone": "missing"}
    gone = S.file_inventory(spark, f"{root}/nowhere", "x").first()
    assert (gone.files, gone.bytes) == (0, 0) and S.table_inventory(spark, f"{root}/nowhere").count() == 0


def test_next_occurrence(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 1, 2, 10, 30),), (dt.datetime(2024, 1, 2, 8, 0),)], "ts timestamp")
    out = df.select(H.next_occurrence(F.col("ts"), 0).alias("d"), H.next_occurrence(F.col("ts"), 9).alias("c")).collect()
    assert out[0].d == dt.datetime(2024, 1, 3, 0, 0) and out[0].c == dt.datetime(2024, 1, 3, 9, 0)
    assert out[1].d == dt.datetime(2024, 1, 3, 0, 0) and out[1].c == dt.datetime(2024, 1, 2, 9, 0)
