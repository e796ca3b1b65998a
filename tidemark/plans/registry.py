"""Run tracking and model registry as append-only tables.

``runs``, ``run_tags``, ``run_params``, ``run_metrics`` and ``model_stage_events``
are plain long tables; every "current state" is derived from them with
aggregates and windows partitioned by run or model, never by a global order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.session import cut_lineage

# Fixed values of the reference: default run tags and registry stages.
DEFAULT_TAGS = {"project": "stock_prediction", "environment": "dev", "version": "1.0.0"}
STAGES = ("None", "Staging", "Production", "Archived")


def stamp(ts: Column, fmt: str = "yyyyMMdd_HHmmss") -> Column:
    """run/snapshot stamp."""
    return F.date_format(ts, fmt)


def merge_tags(defaults: dict, user: Column) -> Column:
    """defaults overridden by user tags (last wins) without duplicate keys."""
    items = []
    for k, v in defaults.items():
        items += [F.lit(k), F.lit(v)]
    d = F.create_map(*items)
    kept = F.map_filter(d, lambda k, _v: ~F.coalesce(F.array_contains(F.map_keys(user), k), F.lit(False)))
    return F.map_concat(kept, F.coalesce(user, F.create_map().cast("map<string,string>")))


def prefix_params(params: Column, prefix: str = "model_") -> Column:
    """``model_{key}`` parameter names."""
    return F.transform_keys(params, lambda k, _v: F.concat(F.lit(prefix), k))


def log_runs(evals: DataFrame, started: str, ended: str, user_tags: Column | None = None) -> tuple[DataFrame, DataFrame]:
    """One run per (symbol, model_type) evaluation → ``runs`` and ``run_tags``.

    A run without a metric (nothing could be evaluated) has status FAILED.
    """
    start, end = F.to_timestamp(F.lit(started)), F.to_timestamp(F.lit(ended))
    run_id = F.concat_ws("-", "model_type", "symbol")
    runs = evals.select(run_id.alias("run_id"), "symbol", "model_type",
                        F.concat(F.col("model_type"), F.lit("_training_"), stamp(start)).alias("run_name"),
                        start.alias("start_time"), end.alias("end_time"),
                        F.when(F.col("mae").isNull(), F.lit("FAILED")).otherwise(F.lit("FINISHED")).alias("status"))
    user = user_tags if user_tags is not None else F.create_map(F.lit("symbol"), F.col("symbol"))
    tags = runs.select("run_id", F.explode(merge_tags(DEFAULT_TAGS, user)).alias("key", "value"))
    return runs, tags


def log_params(evals: DataFrame, params: Column, prefix: str = "model_") -> DataFrame:
    """R2: long ``(run_id, key, value)`` of each run's parameters under prefixed names."""
    run_id = F.concat_ws("-", "model_type", "symbol")
    return evals.select(run_id.alias("run_id"), F.explode(prefix_params(params, prefix)).alias("key", "value"))


def log_metrics(evals: DataFrame, logged_at: str, metrics=("mae", "rmse", "r2"), step: int = 0) -> DataFrame:
    """R2: long ``(run_id, metric, step, ts, value)`` from wide metric columns."""
    run_id = F.concat_ws("-", "model_type", "symbol")
    pairs = F.array(*[F.struct(F.lit(m).alias("metric"), F.col(m).cast("double").alias("value")) for m in metrics])
    return evals.select(run_id.alias("run_id"), F.inline(pairs)).select(
        "run_id", "metric", F.lit(step).alias("step"), F.to_timestamp(F.lit(logged_at)).alias("ts"), "value")


def latest_metrics(run_metrics: DataFrame) -> DataFrame:
    """Last value per (run, metric) by step (value breaks ties)."""
    return run_metrics.groupBy("run_id", "metric").agg(
        F.max_by("value", F.struct("step", "value")).alias("value"))


def metric_history(run_metrics: DataFrame) -> DataFrame:
    """Step-ordered values per (run, metric)."""
    return run_metrics.groupBy("run_id", "metric").agg(
        F.sort_array(F.collect_list(F.struct("step", "value"))).alias("_h")).select(
        "run_id", "metric", F.size("_h").alias("n_steps"),
        F.transform("_h", lambda s: s["value"]).alias("values"))


def metric_history_pages(run_metrics: DataFrame, page_steps: int = 256) -> DataFrame:
    """R4 in pages of ``page_steps`` steps: (run_id, metric, page, n_steps, values), so that the curve of a
    long run is many bounded rows."""
    paged = run_metrics.withColumn("page", F.floor(F.col("step") / page_steps).cast("int"))
    return paged.groupBy("run_id", "metric", "page").agg(
        F.sort_array(F.collect_list(F.struct("step", "value"))).alias("_h")).select(
        "run_id", "metric", "page", F.size("_h").alias("n_steps"), F.transform("_h", lambda s: s["value"]).alias("values"))


def metric_universe(run_metrics: DataFrame) -> DataFrame:
    """U1."""
    return run_metrics.select("metric").distinct()


def compare_runs(latest: DataFrame, groups: DataFrame) -> DataFrame:
    """For each group's ordered run list ``groups(group, run_ids array)``, every
    metric any of its runs has, with one value per run in the given order
    (NULL where a run lacks the metric). Values are gathered per (group, metric)
    into a position → value map and laid out by position, so no run × metric
    pairs are materialised."""
    slots = groups.select("group", F.size("run_ids").alias("n_runs"),
                          F.posexplode("run_ids").alias("pos", "run_id"))
    have = slots.join(latest, "run_id")
    agg = have.groupBy("group", "metric", "n_runs").agg(
        F.map_from_entries(F.collect_list(F.struct("pos", "value"))).alias("_m"))
    return agg.select("group", "metric", F.transform(
        F.sequence(F.lit(0), F.col("n_runs") - 1), lambda i: F.try_element_at(F.col("_m"), i)).alias("values"))


def compare_run_rows(runs: DataFrame, params: DataFrame, groups: DataFrame) -> DataFrame:
    """Beside the metrics, the compared runs themselves in the given order: name, start,
    end, status and parameters."""
    own = params.groupBy("run_id").agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("key", "value")))).alias("params"))
    slots = groups.select("group", F.posexplode("run_ids").alias("pos", "run_id"))
    return (slots.join(runs.select("run_id", "run_name", "start_time", "end_time", "status"), "run_id")
            .join(own, "run_id", "left").select("group", "pos", "run_id", "run_name", "start_time", "end_time", "status", "params"))


def register_versions(candidates: DataFrame, existing: DataFrame | None, registered_at: str,
                      stage: str = "Staging") -> DataFrame:
    """New versions = max(existing version)+1 … in candidate order, each with a
    'None' (created) and a ``stage`` event at the same instant. ``candidates(model, run_id, ord)``.

    ``seq`` numbers a model's events; events are ordered by (ts, seq)."""
    base = candidates
    if existing is not None:
        mx = existing.groupBy("model").agg(F.max(F.col("version").cast("int")).alias("_mx"), F.max("seq").alias("_seq"))
        base = base.join(mx, "model", "left")
    else:
        base = base.withColumn("_mx", F.lit(None).cast("int")).withColumn("_seq", F.lit(None).cast("long"))
    k = F.row_number().over(Window.partitionBy("model").orderBy("ord"))
    first = F.coalesce(F.col("_seq") + 1, F.lit(0)) + 2 * (F.col("_k") - 1)
    base = base.withColumn("_k", k).withColumn("version", (F.coalesce("_mx", F.lit(0)) + F.col("_k")).cast("int"))
    steps = F.array(F.struct(F.lit("None").alias("stage"), first.cast("long").alias("seq")),
                    F.struct(F.lit(stage).alias("stage"), (first + 1).cast("long").alias("seq")))
    return base.select("model", "version", "run_id", F.inline(steps)).select(
        "model", "version", "stage", F.to_timestamp(F.lit(registered_at)).alias("ts"), "seq", "run_id")


def next_version(events: DataFrame, stages=None) -> DataFrame:
    """R6 lookup: max(version)+1 per model over the versions that are in ``stages`` now (all by default)."""
    state = registry_state(events)
    live = F.lit(True) if stages is None else F.col("stage").isin(list(stages))
    return state.groupBy("model").agg((F.coalesce(F.max(F.when(live, F.col("version").cast("int"))), F.lit(0)) + 1)
                                      .alias("next_version"))


def registry_state(events: DataFrame) -> DataFrame:
    """Current stage per (model, version) = stage of its latest event by (ts, seq)."""
    return events.groupBy("model", "version").agg(
        F.max_by(F.struct("stage", "run_id", "ts"), F.struct("ts", "seq")).alias("_s")).select(
        "model", "version", F.col("_s.stage").alias("stage"), F.col("_s.run_id").alias("run_id"),
        F.col("_s.ts").alias("last_updated"))


def latest_per_stage(state: DataFrame) -> DataFrame:
    """Latest version per (model, stage)."""
    w = Window.partitionBy("model", "stage").orderBy(F.col("version").desc())
    return state.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") == 1).drop("_rn")


def _last_production(w) -> Column:
    """Position and time of the nearest accepted move to Production in the frame before a row of ``w``."""
    entry = F.when(F.col("ok") & F.col("moves") & (F.col("stage") == "Production"), F.struct("pos", "ts"))
    return F.last(entry, ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, -1))


def _stage_before(rows: DataFrame) -> DataFrame:
    """rows with ``before``: the version's stage just before each row, given the accepted ones (``ok``)."""
    own = F.last(F.when(F.col("ok"), F.struct("pos", "stage")), ignorenulls=True).over(
        Window.partitionBy("model", "version").orderBy("pos").rowsBetween(Window.unboundedPreceding, -1))
    rows = rows.withColumn("_production", _last_production(Window.partitionBy("model").orderBy("pos"))).withColumn("_own", own)
    archived = (F.col("_own.stage") == "Production") & (F.col("_production.pos") > F.col("_own.pos"))
    return rows.withColumn("before", F.when(archived, "Archived").otherwise(F.col("_own.stage"))).drop("_production", "_own")


def _accepted(rows: DataFrame) -> DataFrame:
    """rows with ``ok`` settled: a row that names a stage to come from is accepted where its version
    has that stage. Whether it does depends on earlier rows alone, so repeating the scan settles at
    least one more row of each model's chain of such dependencies; mostly the first scan settles all."""
    rows = rows.withColumn("ok", F.col("why").isNull())
    if rows.where(F.col("from_stage").isNotNull() & F.col("ok")).isEmpty():
        return rows.withColumn("before", F.lit(None).cast("string"))
    while True:
        holds = F.col("why").isNull() & (F.col("from_stage").isNull() | F.col("from_stage").eqNullSafe(F.col("before")))
        rows = cut_lineage(_stage_before(rows).withColumn("_holds", holds))
        settled = rows.where("ok != _holds").isEmpty()
        rows = rows.withColumn("ok", F.col("_holds")).drop("_holds")
        if settled:
            return rows
        rows = rows.drop("before")


def fold_promotions(events: DataFrame, promotions: DataFrame) -> DataFrame:
    """Promotions ``(model, version, to_stage, ts[, from_stage])`` applied one after another
    by (ts, version) to the registry's state: events, and rejected ones with their reason.

    A promotion to Production first archives every other version that is Production at that
    moment. It is rejected when the version is unknown, the stage is none of ``STAGES``, or
    ``from_stage`` is given and is not the version's stage at that moment.

    Segmented scans per model, in order: a version's stage is that of its own last move, or
    Archived where that is Production and another version went to Production since; it is
    archived by the next move to Production unless its own next move comes first. Windows by
    model (and by version inside the same distribution), so one exchange carries them all.
    """
    if "from_stage" not in promotions.columns:
        promotions = promotions.withColumn("from_stage", F.lit(None).cast("string"))
    state = registry_state(events).select("model", "version", F.col("stage").alias("now"), "run_id")
    order = Window.partitionBy("model").orderBy("ts", "version", "to_stage", "from_stage")
    batch = (promotions.select("model", "version", "to_stage", "ts", "from_stage").withColumn("pos", F.row_number().over(order))
             .join(state, ["model", "version"], "left"))
    why = F.when(F.col("now").isNull(), "unknown version").when(~F.col("to_stage").isin(*STAGES), "unknown stage")
    batch = batch.select("model", "version", F.col("to_stage").alias("stage"), "ts", "from_stage", "pos", "run_id",
                         F.lit(True).alias("moves"), why.alias("why"))
    start = state.select("model", "version", F.col("now").alias("stage"), F.lit(None).cast("timestamp").alias("ts"),
                         F.lit(None).cast("string").alias("from_stage"), F.lit(0).alias("pos"), "run_id",
                         F.lit(False).alias("moves"), F.lit(None).cast("string").alias("why"))
    rows = _accepted(cut_lineage(start.unionByName(batch)))
    # the next accepted move to Production, and the version's own next move
    back = F.col("pos").desc()
    own = F.last(F.when(F.col("ok"), F.col("pos")), ignorenulls=True).over(
        Window.partitionBy("model", "version").orderBy(back).rowsBetween(Window.unboundedPreceding, -1))
    ahead = rows.withColumn("_next", _last_production(Window.partitionBy("model").orderBy(back))).withColumn("_own", own)
    archived = ahead.where(F.col("ok") & (F.col("stage") == "Production") & (F.col("_next.pos") < F.coalesce("_own", F.lit(2**31 - 1))))
    archived = archived.select("model", "version", F.lit("Archived").alias("stage"), "_next.ts", "_next.pos", "run_id", F.lit(0).alias("kind"))
    moved = rows.where("ok and moves").select(*archived.columns[:-1], F.lit(1).alias("kind"))
    top = events.groupBy("model").agg(F.max("seq").alias("top"))
    place = F.row_number().over(Window.partitionBy("model").orderBy("pos", "kind", "version"))
    applied = archived.unionByName(moved).withColumn("_n", place).join(top, "model").select(
        "model", "version", "stage", "ts", (F.col("top") + F.col("_n")).alias("seq"), "run_id", F.lit(None).cast("string").alias("rejected"))
    reason = F.coalesce("why", F.concat(F.lit("stage is "), F.col("before")))
    refused = rows.where("not ok").sortWithinPartitions("model", "pos").select("model", "version", "stage", "ts", F.lit(None).cast("long").alias("seq"), "run_id", reason.alias("rejected"))
    return applied.unionByName(refused)


def promote(events: DataFrame, promotions: DataFrame) -> DataFrame:
    """The events of a batch of promotions (see ``fold_promotions``)."""
    return fold_promotions(events, promotions).where(F.col("rejected").isNull()).drop("rejected")


def model_info(state: DataFrame, stage: str = "Production") -> DataFrame:
    """Record of the latest version in ``stage`` per model (no row when none)."""
    return latest_per_stage(state.where(F.col("stage") == stage))


def load_stage_models(state: DataFrame, models: DataFrame, stage: str = "Production") -> DataFrame:
    """Models serving from ``stage``: registry state ⋈ the run's model row."""
    return model_info(state, stage).join(models, "run_id")
