"""Plan properties that matter at scale: broadcast only under a bound, theta join semantics,
file layout of the day-partitioned table, one exchange for the stored readings."""

import glob
import os

from pyspark.sql import functions as F

from conftest import SF_SMALL
from dockcast.operators import curate as cur
from dockcast.operators import scenario as sc
from dockcast.operators import sinks as sk
from dockcast.operators.joins import bounded_broadcast
from dockcast.plans import catalog as cat
from dockcast.sources.adapter import snapshot_elements


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_broadcast_only_under_bound(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        big = spark.range(100000).withColumnRenamed("id", "k")
        small = spark.range(50).withColumnRenamed("id", "k")
        assert "BroadcastHashJoin" in _plan(big.join(bounded_broadcast(small, 100), "k"))
        assert "BroadcastHashJoin" not in _plan(big.join(bounded_broadcast(small, 10), "k"))
        assert "BroadcastHashJoin" not in _plan(big.join(bounded_broadcast(small, 1000, known_rows=5000), "k"))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_text_match_returns_every_station(spark):
    stations = spark.createDataFrame([(1, "1 - NATION_1"), (10, "10 - NATION_10"), (2, "2 - NATION_2")],
                                     "id bigint, name string")
    req = spark.createDataFrame([(7, "NATION_1")], "req_id bigint, station string")
    joined = sc.resolve_requests(req, stations)
    assert sorted(r.id for r in joined.collect()) == [1, 10]
    plan = _plan(joined)
    assert "NestedLoop" not in plan and "Cartesian" not in plan
    by_id = sc.resolve_requests(spark.createDataFrame([(7, 2)], "req_id bigint, station_id bigint"), stations)
    assert [r.id for r in by_id.collect()] == [2]


def test_day_partitioned_table_layout(spark, workdir):
    """Distinct with map-side combine, then REBALANCE on the day: few files per day."""
    w, n = cat.weather_table(spark, SF_SMALL)
    df = cur.curate_by_day(snapshot_elements(spark, SF_SMALL), w, weather_rows=n)
    path = sk.store_readings(df, os.path.join(workdir, "t"), mode="errorifexists")
    days = glob.glob(os.path.join(path, "obs_day=*"))
    assert days and all(len(glob.glob(os.path.join(d, "*.parquet"))) <= 2 for d in days)
    assert spark.read.parquet(path).count() == cat.readings(spark, SF_SMALL).count()


def test_copies_combine_before_the_shuffle(spark):
    """A row copied many times is reduced in every map task: the distinct's exchange receives at
    most one copy per task."""
    base = spark.range(0, 60000, numPartitions=6).select((F.col("id") % 3 == 0).cast("int").alias("hot"),
                                                         F.col("id"))
    copies = base.select(F.when(F.col("hot") == 1, F.lit(-1)).otherwise(F.col("id")).alias("v"))
    d = cur.distinct_readings(copies)
    d.collect()
    plan = d._jdf.queryExecution().executedPlan().toString()
    # a partial aggregate stands below the exchange (deeper in the tree: after it in the text)
    exchange, below = plan.index("Exchange hashpartitioning"), plan.rindex("HashAggregate(keys=[v")
    assert below > exchange
    assert d.where("v = -1").count() == 1
    combined = copies.groupBy(F.spark_partition_id().alias("task"), "v").count()
    assert combined.where("v = -1").count() == 6            # what the exchange gets of the hot row: one for each task


def test_scans_are_pruned(spark):
    import re
    plan = _plan(cat.QUERIES["time_features"](spark, SF_SMALL))
    schemas = [set(c.split(":")[0] for c in m.split(",")) for m in re.findall(r"ReadSchema: struct<([^>]*)>", plan)]
    events = [s for s in schemas if "ts" in s][0]
    # time features never need the value or props columns
    assert events <= {"user_id", "ts", "event_type"}, events
    assert any(s <= {"n_nationkey", "n_name"} and "n_nationkey" in s for s in schemas)


def test_hot_station_results(spark):
    """One station holds a third of all rows: per-key picks stay exact."""
    n = 30000
    rows = spark.range(n).select(
        F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id") % 1000 + 100).cast("bigint").alias("id"),
        (F.col("id") * 1000).alias("dtUpdate"), (F.col("id") % 20).cast("int").alias("bikes"),
        (F.col("id") % 13).cast("int").alias("places"), F.lit("s").alias("name"))
    from dockcast.operators import lookup as lk
    latest = {r.id: r.dtUpdate for r in lk.latest_per_station(rows).collect()}
    assert latest[7] == (n - 3) * 1000          # the hot station's last row: id 29997
    assert len(latest) == 1 + 1000


def test_text_match_equals_a_scan(spark):
    """Every pair that a nested loop would find, for texts of any length, and no other."""
    import random
    rng = random.Random(3)
    names = [f"{k} - " + "".join(rng.choices("ABÉ ", k=rng.randint(0, 6))) for k in range(60)]
    texts = ["", "1", "- ", "A", "ÉA", "AB", "ABA", "A B", "zz", "5 - ", "7", "names"] + [n[rng.randint(0, 3):][:rng.randint(1, 6)] for n in names[:25]]
    stations = spark.createDataFrame(list(enumerate(names)), "id long, name string")
    requests = spark.createDataFrame(list(enumerate(texts)) + [(999, None)], "req_id long, station string")
    got = sorted((r.req_id, r.id) for r in sc.resolve_requests(requests, stations).collect())
    assert got == sorted((q, i) for q, t in enumerate(texts) for i, n in enumerate(names) if t in n)


def test_building_lookups_runs_no_job(spark):
    tracker = spark.sparkContext.statusTracker()
    readings = cat.stored_readings(spark, SF_SMALL)
    requests = spark.createDataFrame([(1, "NATION_1")], "req_id long, station string")
    spark.sparkContext.setJobGroup("lookup-plans", "")
    from dockcast.operators import lookup as lk
    lk.station_lookup(readings, "NATION_1")
    sc.resolve_requests(requests, lk.latest_per_station(readings))
    assert list(tracker.getJobIdsForGroup("lookup-plans")) == []
    spark.sparkContext.setJobGroup("", "")


def test_first_rows_equal_a_full_sort(spark):
    from dockcast.operators import lookup as lk
    readings = cat.stored_readings(spark, SF_SMALL)
    for n in (1, 7, 300, 10 ** 6):
        want = lk.natural_order(readings).limit(n).collect()
        assert lk.first_rows(readings, n, [F.col("id"), F.floor(F.col("dtUpdate") / 86_400_000)], lk.NATURAL_ORDER).collect() == want


def test_global_rank(spark):
    from dockcast.operators.rank import global_rank
    df = spark.range(0, 5000, numPartitions=7).select(F.col("id"), (F.col("id") % 13).alias("n"))
    rows = global_rank(df, [F.desc("n"), F.asc("id")], "rank").orderBy("rank").collect()
    assert [r["rank"] for r in rows] == list(range(5000))
    assert [r.id for r in rows] == [r.id for r in df.orderBy(F.desc("n"), "id").collect()]


def test_a_changed_input_is_seen(spark, workdir):
    """Stored tables belong to the state of their input: growing it in one session grows the results."""
    import shutil
    for name in ("events", "nation"):
        os.mkdir(os.path.join(workdir, f"{name}.parquet"))
        shutil.copy(os.path.join(SF_SMALL, f"{name}.parquet"), os.path.join(workdir, f"{name}.parquet", "part-0.parquet"))
    before = cat.QUERIES["reading_count"](spark, workdir).first().n_readings
    ev = spark.read.parquet(os.path.join(SF_SMALL, "events.parquet"))
    ev.withColumns({"event_id": F.col("event_id") + 10 ** 6, "ts": F.col("ts") + F.expr("interval 60 days")}) \
        .write.mode("append").parquet(os.path.join(workdir, "events.parquet"))
    assert cat.QUERIES["reading_count"](spark, workdir).first().n_readings == 2 * before
    later = cat.QUERIES["load_latest"](spark, workdir).select(F.max("dtUpdate")).first()[0]
    assert later > ev.select(F.unix_millis(F.max("ts").cast("timestamp"))).first()[0]


def test_scratch_uses_the_session_checkpoint_dir(spark):
    from dockcast.session import scratch_path, scratch_root
    configured = spark.sparkContext.getConf().get("spark.checkpoint.dir")
    root = scratch_root(spark)
    assert configured and root.replace("file:", "").startswith(configured.rstrip("/"))
    assert scratch_path(spark, "tables/x").startswith(root) and scratch_path(spark, "x") != scratch_path(spark, "x")


def test_hot_texts_are_spread_over_tasks(spark):
    """A text that many requests share and many stations hold: its pairs are made by several tasks, each once."""
    left = spark.createDataFrame([("hot", i) for i in range(300)] + [("cold", 1), ("alone", 2), (None, 3)], "station STRING, id INT").repartition(1)
    right = spark.createDataFrame([("hot", r) for r in range(200)] + [("cold", 1), ("cold", 1), ("none", 5), (None, 6)], "station STRING, req_id INT")
    joined = sc.spread_join(left, right, "station", part_rows=5_000)
    wanted = left.join(right, "station")
    assert joined.count() == 300 * 200 + 2 and joined.exceptAll(wanted.select(*joined.columns)).count() == 0
    by_task = [r.n for r in joined.groupBy(F.spark_partition_id()).agg(F.count(F.lit(1)).alias("n")).collect()]
    assert len(by_task) > 3 and max(by_task) < 60_000 / 2


def test_requests_of_one_text_are_resolved_by_several_tasks(spark, monkeypatch):
    stations = spark.createDataFrame([(i, f"{i} - NATION_{i % 5}") for i in range(400)], "id BIGINT, name STRING")
    requests = spark.createDataFrame([(r, " - NATION_") for r in range(100)], "req_id BIGINT, station STRING")
    monkeypatch.setattr(sc.spread_join, "__defaults__", (2_000,))
    found = sc.resolve_requests(requests, stations, spread=True)
    assert found.columns == ["id", "station_name", "station", "req_id"] and found.distinct().count() == 40_000
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin [station" not in plan.split("SortMergeJoin")[0] and "SortMergeJoin" in plan
    assert found.select(F.spark_partition_id()).distinct().count() > 3


def test_names_grams_are_never_shipped_whole(spark):
    stations = spark.createDataFrame([(i, f"{i} - NATION_{i % 5}") for i in range(400)], "id BIGINT, station_name STRING")
    found = sc.text_matches(spark.createDataFrame([("17 - N",), ("no such",), ("5",)], "text STRING"), stations, sized=True)
    assert sorted(r.id for r in found.where("text = '17 - N'").collect()) == [17, 117, 217, 317] and found.where("text = 'no such'").count() == 0
    join = next(line for line in found._jdf.queryExecution().executedPlan().toString().splitlines() if "BroadcastHashJoin [gram" in line)
    assert "BuildLeft" in join


def test_a_grid_of_parts_copies_few_rows(spark):
    """A hot text's rows are copied along one side of a grid, not to every part."""
    left = spark.createDataFrame([("hot", i) for i in range(300)], "station STRING, id INT")
    right = spark.createDataFrame([("hot", r) for r in range(300)], "station STRING, req_id INT")
    joined = sc.spread_join(left, right, "station", part_rows=900)      # a hundred parts
    assert joined.distinct().count() == joined.count() == 90_000
    exchanged = {}

    def walk(node):
        kind = node.getClass().getSimpleName()
        if kind == "ShuffleExchangeExec":
            exchanged[node.toString()] = node.metrics().get("shuffleRecordsWritten").get().value()
        if kind == "AdaptiveSparkPlanExec" or kind.endswith("QueryStageExec"):
            walk(node.executedPlan() if kind == "AdaptiveSparkPlanExec" else node.plan())
        it = node.children().iterator()
        while it.hasNext():
            walk(it.next())

    joined.collect()
    walk(joined._jdf.queryExecution().executedPlan())
    assert sorted(exchanged.values()) == [3_000, 3_000], exchanged       # a hundred parts of one side alone: 300 and 30,000


def test_weights_of_right_rows_make_the_parts(spark):
    left = spark.createDataFrame([("hot", i) for i in range(40)], "station STRING, id INT")
    right = spark.createDataFrame([("hot", r, 50) for r in range(8)] + [("none", 9, 0)], "station STRING, req_id INT, w INT")
    joined = sc.spread_join(left, right, "station", part_rows=1_000, weight="w")
    assert joined.count() == 320 and joined.select(F.spark_partition_id()).distinct().count() > 3


def test_bundles_hold_every_request(spark, monkeypatch):
    """Requests that are alike stand in bounded arrays: none is lost, with null or repeated ids, or null texts and times."""
    rows = [(i, "a", 1) for i in range(50)] + [(None, "a", 1), (None, "a", 1), (7, "a", 1), (8, "b", None), (9, None, 2), (9, None, 2), (10, None, None)]
    requests = spark.createDataFrame(rows, "req_id BIGINT, station STRING, t INT")
    monkeypatch.setattr(sc, "BUNDLE_ROWS", 4)
    for group in (1 << 20, 10):
        monkeypatch.setattr(sc, "GROUP_ROWS", group)
        bundles = sc.bundled(requests)
        assert bundles.agg(F.max(F.size("req_id"))).first()[0] <= 4 and bundles.agg(F.sum(sc.BUNDLED)).first()[0] == len(rows)
        back = sc.unbundled(bundles.drop(sc.BUNDLED)).select(*requests.columns)
        assert back.exceptAll(requests).count() == 0 and requests.exceptAll(back).count() == 0


def test_scenarios_by_bundle_equal_those_by_request(spark):
    for delay, scenario in ((True, sc.scenario_delay), (False, sc.scenario_explicit)):
        one_by_one = scenario(cat._resolved(spark, SF_SMALL, upper=delay))
        bundles = cat._scenarios(spark, SF_SMALL, delay)
        assert bundles.columns == one_by_one.columns and 0 < bundles.count() <= one_by_one.count()
        rows = sc.unbundled(bundles)
        assert rows.exceptAll(one_by_one).count() == 0 and one_by_one.exceptAll(rows).count() == 0


def test_a_time_of_a_station_is_scored_once(spark, monkeypatch):
    """Requests that ask for the same station and time share a row where the model scores: before, each had its own."""
    from dockcast.operators import model as mo
    from dockcast.sources import adapter
    many = lambda s, d: adapter.forecast_requests(s, d).crossJoin(s.range(5)).drop("id")
    monkeypatch.setattr(cat, "forecast_requests", many)
    seen = []

    def predict(model, rows, was=mo.predict):
        seen.append(rows.count())
        return was(model, rows)

    monkeypatch.setattr(mo, "predict", predict)
    answers = cat.QUERIES["forecast"](spark, SF_SMALL)
    assert answers.count() >= 5 * seen[-1] > 0 and answers.columns[0] == "req_id"


def test_stations_bring_their_index_to_the_forecast(spark):
    """The index joins stations, of which there are few, and not each station of each request."""
    model, _ = cat.trained_model(spark, SF_SMALL)
    scenarios = cat._scenarios(spark, SF_SMALL, True, model)
    assert "id_index" in scenarios.columns
    scored = model.transform(scenarios)
    assert _plan(scored).count("Join") == _plan(scenarios).count("Join")
    again = model.transform(scenarios.drop("id_index"))
    assert scored.select("id", "day", "hour", "prediction").exceptAll(again.select("id", "day", "hour", "prediction")).count() == 0
