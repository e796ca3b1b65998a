"""Health report, alerts and dashboard status over datasets (H1-H4, J3, J4,
F5, F6, F9, F14).

The reference checks cloud resources; here the resources are datasets: an
expected list is matched against an inventory of what exists.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed values of the reference's schedule: deployment 00:00 UTC, collection 09:00 UTC.
DEPLOY_HOUR_UTC = 0
COLLECT_HOUR_UTC = 9


def freshness(tables: dict[str, tuple[DataFrame, str | None]]) -> DataFrame:
    """``(resource, n_rows, newest)`` of each given table: its rows and its newest event time
    (NULL for tables without one)."""
    out = None
    for name, (df, ts) in tables.items():
        newest = F.max(F.col(ts).cast("timestamp")) if ts else F.lit(None).cast("timestamp")
        one = df.agg(F.count(F.lit(1)).alias("n_rows"), newest.alias("newest")).select(
            F.lit(name).alias("resource"), "n_rows", "newest")
        out = one if out is None else out.unionByName(one)
    return out


def expected_vs_present(expected: DataFrame, inventory: DataFrame, data: DataFrame | None = None,
                        as_of: str | None = None, max_age_days: int | None = None) -> DataFrame:
    """Every expected resource with its status and details: ``missing`` without files,
    ``empty`` without rows (or with no file in its folder), ``stale`` when its newest event is
    more than ``max_age_days`` before ``as_of``, else ``healthy``."""
    j = expected.join(inventory, "resource", "left")
    if data is None:
        data = inventory.select("resource", F.lit(None).cast("long").alias("n_rows"), F.lit(None).cast("timestamp").alias("newest"))
    j = j.join(data, "resource", "left")
    status = F.when(F.col("files").isNull(), "missing").when((F.col("files") == 0) | (F.col("n_rows") == 0), "empty")
    if as_of is not None and max_age_days is not None:
        limit = F.to_timestamp(F.lit(as_of)) - F.make_dt_interval(days=F.lit(max_age_days))
        status = status.when(F.col("newest") < limit, "stale")
    return j.select("resource", status.otherwise("healthy").alias("status"), "files", "bytes", "size_kb",
                    "latest_modified", "n_rows", "newest")


def health_report(per: DataFrame) -> tuple[DataFrame, DataFrame]:
    """H1: per-resource rows (details as a string map) and one summary row."""
    names = ("files", "size_kb", "latest_modified", "n_rows", "newest")
    details = F.map_filter(F.create_map(*[x for c in names for x in (F.lit(c), F.col(c).cast("string"))]),
                           lambda _k, v: v.isNotNull())
    rows = per.select("resource", "status", "n_rows", "newest", details.alias("details"))
    summary = per.agg(F.bool_and(F.col("status") == "healthy").alias("resources_healthy"),
                      F.count(F.lit(1)).alias("resources"),
                      F.sum(F.when(F.col("status") != "healthy", 1).otherwise(0)).alias("unhealthy"))
    return rows, summary


def alerts(rows: DataFrame, as_of: str) -> DataFrame:
    """One alert when any dataset is not healthy, none otherwise; its message has a line
    per dataset, by name, with its status."""
    bad = rows.where(F.col("status") != "healthy")
    found = bad.agg(F.array_sort(F.collect_list(F.struct(F.upper("resource").alias("r"), "status"))).alias("f"))
    lines = F.transform("f", lambda x: F.concat(F.lit("- "), x["r"], F.lit(" is "), x["status"]))
    return found.where(F.size("f") > 0).select(
        F.col("f.r").alias("missing"),
        F.concat_ws("\n", F.concat(F.size("f").cast("string"), F.lit(f" datasets need attention at {as_of} UTC")), lines).alias("message"))


def next_occurrence(now: Column, hour_utc: int) -> Column:
    """next time of day ``hour_utc``:00 strictly after the current hour rule
    (if the current hour ≥ target → tomorrow)."""
    today = F.date_trunc("day", now) + F.make_dt_interval(hours=F.lit(hour_utc))
    return F.when(F.hour(now) >= hour_utc, today + F.make_dt_interval(days=F.lit(1))).otherwise(today)


def seconds_until(later: Column, now: Column) -> Column:
    return (F.unix_micros(later) - F.unix_micros(now)) / F.lit(1e6)


def millis_to_time(ms: Column) -> Column:
    """epoch milliseconds → timestamp, missing → epoch."""
    return F.timestamp_millis(F.coalesce(ms, F.lit(0)).cast("long"))


def get_default(m: Column, key: str, default) -> Column:
    """map lookup with a default."""
    return F.coalesce(F.try_element_at(m, F.lit(key)), F.lit(default))


def dashboard_status(rows: DataFrame, now: str) -> DataFrame:
    """H3: one flattened row: status per resource (pivot over the known
    resources), their rows, and the schedule countdowns."""
    ts = F.to_timestamp(F.lit(now))
    st = rows.groupBy().agg(F.map_from_entries(F.collect_list(F.struct("resource", "status"))).alias("s"),
                            F.map_from_entries(F.collect_list(F.struct("resource", "details"))).alias("d"),
                            F.bool_and(F.col("status") == "healthy").alias("overall_healthy"))
    nd, nc = next_occurrence(ts, DEPLOY_HOUR_UTC), next_occurrence(ts, COLLECT_HOUR_UTC)
    return st.select(
        "overall_healthy", F.col("s").alias("status_by_resource"),
        F.transform_values("d", lambda _k, v: get_default(v, "n_rows", "0")).alias("rows_by_resource"),
        nd.alias("next_deployment"), nc.alias("next_collection"),
        seconds_until(nd, ts).alias("deployment_in_s"), seconds_until(nc, ts).alias("collection_in_s"))


def last_event_by_group(df: DataFrame, group: str, ts: str = "ts") -> DataFrame:
    """H4."""
    return df.groupBy(group).agg(F.max(ts).alias("last_event"), F.count(F.lit(1)).alias("events"))


def missing_symbols(requested: DataFrame, present: DataFrame) -> DataFrame:
    """Requested symbols that have no data."""
    return requested.select("symbol").distinct().join(present.select("symbol").distinct(), "symbol", "left_anti")
