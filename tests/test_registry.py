import datetime as dt

from pyspark.sql import functions as F

from tidemark.plans import registry as RG

EV = "model string, version int, stage string, ts timestamp, seq long, run_id string"


def test_compare_runs_order_and_nulls(spark):
    latest = spark.createDataFrame([("A", "mae", 1.0), ("A", "r2", 0.5), ("B", "mae", 2.0)],
                                   "run_id string, metric string, value double")
    groups = spark.createDataFrame([("g", ["B", "A"])], "group string, run_ids array<string>")
    out = {r.metric: r["values"] for r in RG.compare_runs(latest, groups).collect()}
    assert out == {"mae": [2.0, 1.0], "r2": [None, 0.5]}


def test_promote_archives_current_production(spark):
    t = dt.datetime(2024, 1, 1)
    ev = spark.createDataFrame([("m", 1, "Production", t, 0, "r1"), ("m", 2, "Staging", t, 1, "r2")], EV)
    promos = spark.createDataFrame([("m", 2, "Production", t + dt.timedelta(hours=1))],
                                   "model string, version int, to_stage string, ts timestamp")
    all_ev = ev.unionByName(RG.promote(ev, promos))
    state = {r.version: r.stage for r in RG.registry_state(all_ev).collect()}
    assert state == {1: "Archived", 2: "Production"}
    assert RG.next_version(all_ev).first().next_version == 3


def test_exactly_one_production_after_promote_sequence(spark):
    t = dt.datetime(2024, 1, 1)
    cand = spark.createDataFrame([("m", f"r{i}", i) for i in range(5)], "model string, run_id string, ord int")
    created = RG.register_versions(cand, None, "2024-01-01 00:00:00")
    promos = spark.createDataFrame([("m", v, "Production", t + dt.timedelta(days=1, seconds=k))
                                    for k, v in enumerate([3, 1, 5, 2])],
                                   "model string, version int, to_stage string, ts timestamp")
    state = RG.registry_state(created.unionByName(RG.promote(created, promos)))
    prod = [r.version for r in state.where(F.col("stage") == "Production").collect()]
    assert prod == [2]
    assert RG.model_info(state).first().version == 2


def test_merge_tags_last_wins(spark):
    df = spark.createDataFrame([({"environment": "test", "symbol": "AAPL"},)], "u map<string,string>")
    m = df.select(RG.merge_tags(RG.DEFAULT_TAGS, F.col("u")).alias("m")).first().m
    assert m == {"project": "stock_prediction", "environment": "test", "version": "1.0.0", "symbol": "AAPL"}


def _run(spark, moves):
    t = dt.datetime(2024, 1, 1)
    cand = spark.createDataFrame([("m", f"r{i}", i) for i in range(3)], "model string, run_id string, ord int")
    ev = RG.register_versions(cand, None, "2024-01-01 00:00:00")
    promos = spark.createDataFrame([("m", v, to, t + dt.timedelta(minutes=10 * k), frm) for k, (v, to, frm) in enumerate(moves)],
                                   "model string, version int, to_stage string, ts timestamp, from_stage string")
    folded = RG.fold_promotions(ev, promos).collect()
    all_ev = ev.unionByName(RG.promote(ev, promos))
    return {r.version: r.stage for r in RG.registry_state(all_ev).collect()}, [r.rejected for r in folded if r.rejected], all_ev


def test_promotion_at_and_soon_after_registration(spark):
    assert _run(spark, [(1, "Production", None)])[0] == {1: "Production", 2: "Staging", 3: "Staging"}


def test_demoted_version_stays_and_all_productions_go(spark):
    state, _, ev = _run(spark, [(1, "Production", None), (1, "Staging", None), (2, "Production", None)])
    assert state == {1: "Staging", 2: "Production", 3: "Staging"}
    t = dt.datetime(2024, 2, 1)
    twice = ev.unionByName(spark.createDataFrame([("m", 1, "Production", t, 50, "r0")], EV))
    promos = spark.createDataFrame([("m", 3, "Production", t)], "model string, version int, to_stage string, ts timestamp")
    state = {r.version: r.stage for r in RG.registry_state(twice.unionByName(RG.promote(twice, promos))).collect()}
    assert state == {1: "Archived", 2: "Archived", 3: "Production"}


def test_preconditions_and_next_version_by_current_stage(spark):
    state, rejected, ev = _run(spark, [(1, "Archived", "Production"), (9, "Production", None), (2, "Live", None)])
    assert state == {1: "Staging", 2: "Staging", 3: "Staging"}
    assert rejected == ["stage is Staging", "unknown version", "unknown stage"]
    _, _, ev = _run(spark, [(v, "Archived", None) for v in (1, 2, 3)])
    assert RG.next_version(ev, ("Production", "Staging")).first().next_version == 1
    assert RG.next_version(ev).first().next_version == 4


def _one_by_one(events, promotions):
    """The registry's rules, applied move by move."""
    out = []
    for model in {p[0] for p in promotions}:
        state = {}
        for m, v, stage, _ts, _seq, run in sorted((e for e in events if e[0] == model), key=lambda e: (e[3], e[4])):
            state[v] = [stage, run]
        seq = max((e[4] for e in events if e[0] == model), default=None)
        for m, v, to, ts, frm in sorted((p for p in promotions if p[0] == model), key=lambda p: (p[3], p[1], p[2], p[4] is not None, p[4] or "")):
            why = ("unknown version" if v not in state else "unknown stage" if to not in RG.STAGES
                   else f"stage is {state[v][0]}" if frm is not None and state[v][0] != frm else None)
            if why:
                out.append((m, v, to, ts, None, state.get(v, [None, None])[1], why))
                continue
            moves = [(w, "Archived") for w in sorted(state) if to == "Production" and state[w][0] == "Production" and w != v]
            for w, stage in [*moves, (v, to)]:
                seq += 1
                state[w][0] = stage
                out.append((m, w, stage, ts, seq, state[w][1], None))
    return out


def test_fold_equals_move_by_move(spark):
    import random
    rng = random.Random(8)
    t = dt.datetime(2024, 1, 1)
    events, promotions = [], []
    for m in range(40):
        model = f"m{m}"
        for v in range(1, rng.randint(1, 6)):
            events.append((model, v, rng.choice(RG.STAGES), t, len([e for e in events if e[0] == model]), f"{model}-r{v}"))
        for _ in range(rng.randint(0, 25)):
            promotions.append((model, rng.randint(1, 6), rng.choice([*RG.STAGES, "Production", "Production", "Live"]),
                               t + dt.timedelta(minutes=rng.randint(1, 12)), rng.choice([None, None, *RG.STAGES])))
    cols = "model string, version int, to_stage string, ts timestamp, from_stage string"
    got = RG.fold_promotions(spark.createDataFrame(events, EV), spark.createDataFrame(promotions, cols)).collect()
    assert sorted(map(str, map(tuple, got))) == sorted(str(x) for x in _one_by_one(events, promotions))
    assert sum(r.rejected is not None and r.rejected.startswith("stage is") for r in got) > 20
    free = [p for p in promotions if p[4] is None]
    got = RG.fold_promotions(spark.createDataFrame(events, EV), spark.createDataFrame(free, cols).drop("from_stage")).collect()
    assert sorted(map(str, map(tuple, got))) == sorted(str(x) for x in _one_by_one(events, free))


def test_fold_of_empty_tables(spark):
    cols = "model string, version int, to_stage string, ts timestamp"
    t = dt.datetime(2024, 1, 1)
    events = spark.createDataFrame([("m", 1, "Staging", t, 0, "r")], EV)
    assert RG.fold_promotions(events, spark.createDataFrame([], cols)).count() == 0
    none = RG.fold_promotions(spark.createDataFrame([], EV), spark.createDataFrame([("m", 1, "Staging", t)], cols)).collect()
    assert [r.rejected for r in none] == ["unknown version"]
