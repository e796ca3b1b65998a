"""Health, alert and schedule queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark import oracle_sql as O
from tidemark.catalog import register
from tidemark.catalog.dataset import event_requests
from tidemark.functions.presentation import rounded
from tidemark.plans import health as H
from tidemark.sources import snapshots as S
from tidemark.sources.bars import bars_from
from tidemark.sources.tables import TABLES, read_table

AS_OF = "2024-01-02 10:30:00"
MAX_AGE_DAYS = 730
EVENT_TIME = {"orders": "o_orderdate", "lineitem": "l_shipdate", "events": "ts"}
EXPECTED = list(TABLES) + ["models", "forecasts"]


def _report(spark, sf):
    inventory = S.table_inventory(spark, sf)
    data = H.freshness({t: (read_table(spark, sf, t), EVENT_TIME.get(t)) for t in TABLES})
    expected = spark.createDataFrame([(r,) for r in EXPECTED], "resource string")
    return H.health_report(H.expected_vs_present(expected, inventory, data, AS_OF, MAX_AGE_DAYS))


_DATA_SQL = " UNION ALL ".join(
    f"SELECT '{t}' AS resource, count(*) AS n_rows, {f'max({EVENT_TIME[t]})' if t in EVENT_TIME else 'CAST(NULL AS TIMESTAMP)'} AS newest FROM {t}"
    for t in TABLES) + " UNION ALL SELECT 'models', NULL, NULL UNION ALL SELECT 'forecasts', NULL, NULL"
_REPORT_SQL = f"""SELECT resource, CASE WHEN n_rows IS NULL THEN 'missing' WHEN n_rows = 0 THEN 'empty'
      WHEN newest < TIMESTAMP '{AS_OF}' - INTERVAL {MAX_AGE_DAYS} DAY THEN 'stale' ELSE 'healthy' END AS status,
    n_rows, strftime(newest, '%Y-%m-%d %H:%M:%S') AS newest FROM ({_DATA_SQL}) d"""
_ALERT_SQL = f"""SELECT string_agg(upper(resource), ',' ORDER BY upper(resource)) AS missing,
    count(*) || ' datasets need attention at {AS_OF} UTC' || chr(10)
      || string_agg('- ' || upper(resource) || ' is ' || status, chr(10) ORDER BY upper(resource)) AS message
  FROM ({_REPORT_SQL}) r WHERE status <> 'healthy' HAVING count(*) > 0"""


def _text(rows):
    return rows.withColumn("newest", F.date_format("newest", "yyyy-MM-dd HH:mm:ss"))


@register("health_report", _REPORT_SQL)
def q_health_report(spark, sf):
    return _text(_report(spark, sf)[0].drop("details"))


@register("health_summary", f"""SELECT bool_and(status = 'healthy') AS resources_healthy, count(*) AS resources,
    count(*) FILTER (WHERE status <> 'healthy') AS unhealthy FROM ({_REPORT_SQL}) r""")
def q_health_summary(spark, sf):
    return _report(spark, sf)[1]


@register("alerts", _ALERT_SQL)
def q_alerts(spark, sf):
    return H.alerts(_report(spark, sf)[0], AS_OF).withColumn("missing", F.array_join("missing", ","))


@register("dashboard_status", f"""SELECT bool_and(status = 'healthy') AS overall_healthy,
    string_agg(resource || '=' || status, ',' ORDER BY resource) AS status_by_resource,
    string_agg(resource || '=' || coalesce(CAST(n_rows AS VARCHAR), '0'), ',' ORDER BY resource) AS rows_by_resource,
    '2024-01-03 00:00:00' AS next_deployment, '2024-01-03 09:00:00' AS next_collection,
    CAST(48600 AS DOUBLE) AS deployment_in_s, CAST(81000 AS DOUBLE) AS collection_in_s FROM ({_REPORT_SQL}) r""")
def q_dashboard_status(spark, sf):
    d = H.dashboard_status(_report(spark, sf)[0], AS_OF)

    def joined(c):
        return F.array_join(F.transform(F.array_sort(F.map_entries(c)), lambda e: F.concat_ws("=", e["key"], e["value"])), ",").alias(c)

    fmt = "yyyy-MM-dd HH:mm:ss"
    return d.select("overall_healthy", joined("status_by_resource"), joined("rows_by_resource"),
                    F.date_format("next_deployment", fmt).alias("next_deployment"),
                    F.date_format("next_collection", fmt).alias("next_collection"), "deployment_in_s", "collection_in_s")


@register("status_history", f"""SELECT resource, status, '{AS_OF}' AS timestamp, CAST(NULL AS VARCHAR) AS message FROM ({_REPORT_SQL}) r
  UNION ALL SELECT 'alert', 'raised', '{AS_OF}', message FROM ({_ALERT_SQL}) a""")
def q_status_history(spark, sf):
    rows, _ = _report(spark, sf)
    root = S.shared_path(spark, "status")
    at = F.lit(AS_OF).alias("timestamp")
    S.write_status_history(rows.select("resource", "status", "details", at), root + "/status")
    S.write_alerts(H.alerts(rows, AS_OF).select(F.lit("alert").alias("resource"), F.lit("raised").alias("status"), at, "message"),
                   root + "/alerts")
    schema = "resource string, status string, timestamp string, message string"
    return spark.read.schema(schema).json(root + "/status").unionByName(spark.read.schema(schema).json(root + "/alerts"))


@register("last_event_by_group", """SELECT event_type, strftime(max(ts), '%Y-%m-%d %H:%M:%S.%f') AS last_event,
    count(*) AS events FROM events GROUP BY event_type""")
def q_last_event(spark, sf):
    out = H.last_event_by_group(read_table(spark, sf, "events"), "event_type")
    return out.withColumn("last_event", F.date_format("last_event", "yyyy-MM-dd HH:mm:ss.SSSSSS"))


@register("next_runs", O.round_all("""SELECT event_id,
    strftime(nd, '%Y-%m-%d %H:%M:%S') AS next_deployment, strftime(nc, '%Y-%m-%d %H:%M:%S') AS next_collection,
    (epoch_us(nd) - epoch_us(ts)) / 1e6 AS deployment_in_s, (epoch_us(nc) - epoch_us(ts)) / 1e6 AS collection_in_s,
    strftime(make_timestamp((epoch_us(ts) // 1000) * 1000), '%Y-%m-%d %H:%M:%S.%f') AS ts_from_ms
  FROM (SELECT event_id, ts,
      CASE WHEN hour(ts) >= 0 THEN date_trunc('day', ts) + INTERVAL 1 DAY ELSE date_trunc('day', ts) END AS nd,
      CASE WHEN hour(ts) >= 9 THEN date_trunc('day', ts) + INTERVAL 33 HOUR ELSE date_trunc('day', ts) + INTERVAL 9 HOUR END AS nc
    FROM events) e""", ["deployment_in_s", "collection_in_s"],
                                  ["event_id", "next_deployment", "next_collection", "ts_from_ms"]))
def q_next_runs(spark, sf):
    e = read_table(spark, sf, "events").select("event_id", F.col("ts").cast("timestamp").alias("ts"))
    nd, nc = H.next_occurrence(F.col("ts"), H.DEPLOY_HOUR_UTC), H.next_occurrence(F.col("ts"), H.COLLECT_HOUR_UTC)
    fmt = "yyyy-MM-dd HH:mm:ss"
    return rounded(e.select(
        "event_id", F.date_format(nd, fmt).alias("next_deployment"), F.date_format(nc, fmt).alias("next_collection"),
        H.seconds_until(nd, F.col("ts")).alias("deployment_in_s"),
        H.seconds_until(nc, F.col("ts")).alias("collection_in_s"),
        F.date_format(H.millis_to_time(F.unix_millis("ts")), "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("ts_from_ms")))


@register("missing_symbols", f"""SELECT DISTINCT upper(lower(event_type)) AS symbol FROM events
  WHERE upper(lower(event_type)) NOT IN (SELECT DISTINCT symbol FROM ({O.bars('orders')}) b)""")
def q_missing_symbols(spark, sf):
    from tidemark.operators.cleaning import validate_requests
    req = validate_requests(event_requests(spark, sf))
    return H.missing_symbols(req, bars_from(spark, sf, "orders"))
