"""Streaming (T1, T2, T4): batch result equals availableNow result; reruns add nothing."""

import os

from conftest import SF_SMALL
from dockcast.operators import curate as cur
from dockcast.plans import catalog as cat
from dockcast.sources.adapter import snapshot_elements
from dockcast.sources.snapshots import scan_snapshots, write_landing
from dockcast.streaming import ingest as st
from pyspark.sql import functions as F


def _land(spark, root, copies=1):
    el = snapshot_elements(spark, SF_SMALL, nested=True)
    for i in range(copies):
        write_landing(el, os.path.join(root, f"copy={i}"))
    return root


def test_stream_equals_batch_and_rerun_adds_nothing(spark, workdir):
    land = _land(spark, os.path.join(workdir, "landing"))
    weather = cat.weather_days(spark, SF_SMALL)
    sink, ck = os.path.join(workdir, "sink"), os.path.join(workdir, "ck")
    s = st.stream_readings(st.stream_elements(spark, land), weather).drop("event_time")
    st.run_available_now(s, sink, ck, ["obs_day"])
    got = spark.read.parquet(sink).select(*cur.READING_COLUMNS)
    batch = cur.readings_from_elements(scan_snapshots(spark, land, multi_line=False), weather) \
        .select(*cur.READING_COLUMNS)
    assert got.count() > 0
    assert got.exceptAll(batch).count() == 0 and batch.exceptAll(got).count() == 0
    n = got.count()
    st.run_available_now(st.stream_readings(st.stream_elements(spark, land), weather).drop("event_time"),
                         sink, ck, ["obs_day"])
    assert spark.read.parquet(sink).count() == n


def test_ingest_into_table_sized_and_exactly_once(spark, workdir):
    import glob
    land = _land(spark, os.path.join(workdir, "landing"))
    weather = cat.weather_days(spark, SF_SMALL)
    sink, ck = os.path.join(workdir, "sink"), os.path.join(workdir, "ck")
    st.ingest_into_table(st.stream_readings(st.stream_elements(spark, land), weather), sink, ck)
    got = spark.read.parquet(sink)
    batch = cur.readings_from_elements(scan_snapshots(spark, land, multi_line=False), weather) \
        .select(*cur.READING_COLUMNS)
    assert got.count() == batch.count() > 0
    assert got.select(*cur.READING_COLUMNS).exceptAll(batch).count() == 0
    days = glob.glob(os.path.join(sink, "batch=*", "obs_day=*"))
    assert days and all(len(glob.glob(os.path.join(d, "*.parquet"))) <= 2 for d in days)
    # rerun: nothing new to read, nothing new written
    st.ingest_into_table(st.stream_readings(st.stream_elements(spark, land), weather), sink, ck)
    assert spark.read.parquet(sink).count() == got.count()


def test_stream_dedup_removes_overlap(spark, workdir):
    land = _land(spark, os.path.join(workdir, "landing"), copies=2)
    weather = cat.weather_days(spark, SF_SMALL)
    sink = os.path.join(workdir, "sink")
    s = st.dedup_stream(st.stream_readings(st.stream_elements(spark, land), weather))
    st.run_available_now(s.drop("event_time"), sink, os.path.join(workdir, "ck"))
    got = spark.read.parquet(sink)
    expected = cat.readings(spark, SF_SMALL).select("id", "dtUpdate").distinct().count()
    assert got.count() == expected > 0


def test_table_backed_dedup_is_exact_and_idempotent(spark, workdir):
    land = _land(spark, os.path.join(workdir, "landing"), copies=2)
    weather = cat.weather_days(spark, SF_SMALL)
    sink, ck = os.path.join(workdir, "sink"), os.path.join(workdir, "ck")
    st.dedup_into_table(st.stream_readings(st.stream_elements(spark, land, max_files=3), weather), sink, ck)
    got = spark.read.parquet(sink)
    keys = cat.readings(spark, SF_SMALL).select("id", "dtUpdate").distinct()
    assert got.count() == keys.count() > 0
    assert got.select("id", "dtUpdate").distinct().count() == got.count()
    # a third landing of the same rows, picked up by the same stream: nothing new
    write_landing(snapshot_elements(spark, SF_SMALL, nested=True), os.path.join(land, "copy=9"))
    st.dedup_into_table(st.stream_readings(st.stream_elements(spark, land), weather), sink, ck)
    assert spark.read.parquet(sink).count() == keys.count()


def test_stream_scoring_equals_batch(spark, workdir):
    from dockcast.operators import model as mo
    from dockcast.operators import features as fe
    rows = fe.usable(cat.stored_readings(spark, SF_SMALL))
    model = mo.train(rows, mo.topology("10"), 3, seed=1).model
    land = _land(spark, os.path.join(workdir, "landing"))
    weather = cat.weather_days(spark, SF_SMALL)
    sink = os.path.join(workdir, "sink")
    s = st.score_stream(st.stream_readings(st.stream_elements(spark, land), weather), model)
    st.run_available_now(s.select("id", "dtUpdate", "prediction"), sink, os.path.join(workdir, "ck"))
    got = spark.read.parquet(sink)
    batch = st.score_stream(cur.readings_from_elements(scan_snapshots(spark, land, multi_line=False), weather)
                            .select(*cur.READING_COLUMNS), model).select("id", "dtUpdate", "prediction")
    assert got.count() > 0 and got.exceptAll(batch).count() == 0 and batch.exceptAll(got).count() == 0


def test_dedup_survives_an_empty_first_batch(spark, workdir):
    """A first micro-batch of closed stations alone, then rows: the stream goes on, also after a rerun."""
    import json
    land = os.path.join(workdir, "landing")
    os.mkdir(land)

    def file(name, status, n):
        rows = [{"fields": {"number": str(k), "name": "s", "last_update": "2024-01-05T10:00:00", "available_bikes": "3",
                            "available_bike_stands": "4", "position": [1.0, 2.0], "status": status}} for k in range(n)]
        with open(os.path.join(land, name), "w") as f:
            f.write("\n".join(map(json.dumps, rows)))

    weather = cat.weather_days(spark, SF_SMALL)
    sink, ck = os.path.join(workdir, "sink"), os.path.join(workdir, "ck")
    run = lambda: st.dedup_into_table(st.stream_readings(st.stream_elements(spark, land, max_files=1), weather), sink, ck)
    file("a.json", "CLOSED", 4)
    run()
    file("b.json", "OPEN", 5)
    run()
    assert spark.read.parquet(sink).count() == 5
    file("c.json", "OPEN", 7)
    run()
    assert spark.read.parquet(sink).count() == 7


def test_a_replayed_batch_adds_nothing(spark, workdir):
    """The same files through a new checkpoint, as a batch is run again after a failure."""
    land = _land(spark, os.path.join(workdir, "landing"))
    weather = cat.weather_days(spark, SF_SMALL)
    sink = os.path.join(workdir, "sink")
    for ck in ("ck1", "ck2"):
        st.dedup_into_table(st.stream_readings(st.stream_elements(spark, land), weather), sink, os.path.join(workdir, ck))
    got = spark.read.parquet(sink)
    assert got.count() == got.select("id", "dtUpdate").distinct().count() > 0


def test_max_files_bounds_a_batch(spark, workdir):
    land = os.path.join(workdir, "landing")
    write_landing(snapshot_elements(spark, SF_SMALL, nested=True).repartition(4), land)
    sink = os.path.join(workdir, "sink")
    s = st.stream_readings(st.stream_elements(spark, land, max_files=1), cat.weather_days(spark, SF_SMALL))
    st.ingest_into_table(s, sink, os.path.join(workdir, "ck"))
    assert len([n for n in os.listdir(sink) if n.startswith("batch=")]) == 4


def _split(spark, workdir, landing):
    """One run of both steps of the state-store dedup; the paths, and what the second step dropped by its own watermark."""
    paths = {n: os.path.join(workdir, n) for n in ("on_time", "late", "marks", "log_split", "sink", "log_state")}
    stream = st.stream_readings(st.stream_elements(spark, landing), cat.weather_days(spark, SF_SMALL))
    st.split_late(stream, paths["on_time"], paths["late"], paths["marks"], paths["log_split"])
    q = st.dedup_with_state(spark, paths["on_time"], stream.schema, paths["sink"], paths["log_state"])
    dropped = sum(op["numRowsDroppedByWatermark"] for p in q.recentProgress for op in p["stateOperators"])
    return paths, dropped, [m for p in q.recentProgress for op in p["stateOperators"] for m in op["customMetrics"]]


def test_state_store_dedup_sends_late_rows_aside(spark, workdir):
    """Days land out of order: rows behind the watermark are all in the side table, all others once in the sink; the state store's
    own watermark drops none of them."""
    el = snapshot_elements(spark, SF_SMALL, nested=True)
    day = F.substring("fields.last_update", 9, 2).cast("int")
    landing = os.path.join(workdir, "landing")
    seen, late_wanted, newest, stores = set(), 0, None, []
    for k, (first, last) in enumerate([(1, 9), (12, 20), (10, 11), (17, 20), (19, 25)]):
        write_landing(el.where(day.between(first, last)), os.path.join(landing, f"part={k}"))
        rows = [(r.id, r.dtUpdate) for r in cur.readings_from_elements(el.where(day.between(first, last)), None).select("id", "dtUpdate").collect()]
        late = [r for r in rows if newest is not None and r[1] < newest - 2 * 86_400_000]
        late_wanted += len(late)
        seen |= set(rows) - set(late)
        newest = max([newest or 0, *(t for _, t in rows)])
        paths, dropped, metrics = _split(spark, workdir, landing)
        assert dropped == 0
        stores += metrics
    assert any(m.startswith("rocksdb") for m in stores)
    got = [(r.id, r.dtUpdate) for r in spark.read.parquet(paths["sink"]).select("id", "dtUpdate").collect()]
    assert len(got) == len(set(got)) and set(got) == seen
    assert spark.read.parquet(paths["late"]).count() == late_wanted > 0


def test_split_batch_run_again_changes_nothing(spark, workdir):
    """A batch lost before its commit runs again: the same rows go the same ways."""
    el = snapshot_elements(spark, SF_SMALL, nested=True)
    day = F.substring("fields.last_update", 9, 2).cast("int")
    landing = os.path.join(workdir, "landing")
    for k, (first, last) in enumerate([(10, 20), (1, 30)]):
        write_landing(el.where(day.between(first, last)), os.path.join(landing, f"part={k}"))
        paths, _, _ = _split(spark, workdir, landing)
    tables = lambda: [sorted(map(str, spark.read.parquet(paths[n]).collect())) for n in ("on_time", "late", "marks")]
    before = tables()
    assert before[1]
    for name in ("1", ".1.crc"):
        os.remove(os.path.join(paths["log_split"], "commits", name))
    stream = st.stream_readings(st.stream_elements(spark, landing), cat.weather_days(spark, SF_SMALL))
    st.split_late(stream, paths["on_time"], paths["late"], paths["marks"], paths["log_split"])
    assert tables() == before


def test_quarantine_names_each_bad_file_once(spark, workdir):
    landing, rows = os.path.join(workdir, "landing"), cat.weather_days(spark, SF_SMALL)
    good = '[{"fields":{"number":"%d","name":"s","last_update":"2024-01-0%dT10:00:00+00:00","available_bike_stands":"4","available_bikes":"3","position":[1.5,2.5],"status":"OPEN"}}]'
    texts = {"poll_a.json": good % (1, 2), "poll_b.json": (good % (2, 3))[:-9], "poll_c.json": '{"note": 1}', "poll_d.json": "[]",
             "poll_e.json": "no json", "poll_f.json": good % (3, 4), "poll_g.json": ""}

    def land(names):
        os.makedirs(landing, exist_ok=True)
        for n in names:
            with open(os.path.join(landing, n), "w") as f:
                f.write(texts[n])

    def run():
        files = st.stream_files(spark, landing, max_files=2)
        curate = lambda e: cur.readings_from_elements(e, rows).select(*cur.READING_COLUMNS, "obs_day")
        st.quarantine_into_tables(files, curate, os.path.join(workdir, "sink"), os.path.join(workdir, "dead"), os.path.join(workdir, "log"))
        return (sorted(r.id for r in spark.read.parquet(os.path.join(workdir, "sink")).collect()),
                sorted((os.path.basename(r.file_path), r.length, r.reason) for r in spark.read.parquet(os.path.join(workdir, "dead")).collect()))

    land(list(texts)[:4])
    run()
    land(texts)
    wanted = sorted([("poll_b.json", len(texts["poll_b.json"]), st.UNREADABLE), ("poll_c.json", 11, st.NO_ELEMENTS), ("poll_e.json", 7, st.UNREADABLE)])
    ids, dead = run()
    assert [i for i in ids if i] == [1, 3] and [d for d in dead if d[0] != "poll_d.json"] == wanted
    assert run() == (ids, dead)


def test_quarantine_batches_follow_the_bytes():
    mib = 1 << 20
    assert cat.quarantine_files(20 * mib, 61) == cat.QUARANTINE_FILES              # five batches of a small landing
    few, many = cat.quarantine_files(1200 * mib, 2700), cat.quarantine_files(7200 * mib, 16200)
    assert few == many == 288 and 16200 / many < 60                                # not 1,350 batches of 12
    assert cat.quarantine_files(12 * 1024 * mib, 12) == cat.QUARANTINE_FILES and cat.quarantine_files(0, 0) == cat.QUARANTINE_FILES
