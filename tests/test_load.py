"""Loads that append: ledger, replacement of touched days, recovery (S5, S6); compaction of the stream's table."""

import glob
import math
import os

import pytest
from conftest import SF_SMALL
from dockcast.operators import curate as cur
from dockcast.operators import load as ld
from dockcast.plans import catalog as cat
from dockcast.session import child_names
from dockcast.sources import snapshots as sn
from dockcast.sources.adapter import poll_files, snapshot_elements
from dockcast.streaming import compaction as cp
from dockcast.streaming import ingest as st
from pyspark.sql import functions as F


def same_rows(a, b):
    assert a.exceptAll(b.select(*a.columns)).count() == 0 and b.select(*a.columns).exceptAll(a).count() == 0


@pytest.fixture
def table(spark, workdir):
    return ld.LoadTable(f"{workdir}/table", cat.stored_readings(spark, SF_SMALL, keep_day=True).schema)


@pytest.fixture(scope="module")
def landing(spark):
    return cat.poll_landing(spark, SF_SMALL)


def polls_of(spark, landing):
    return sorted(n.split("=")[1] for n in child_names(spark, landing) if n.startswith("poll="))


def test_loading_again_adds_nothing(spark, table, landing):
    read, curate = cat._loader(spark, SF_SMALL)
    polls = polls_of(spark, landing)
    first = ld.load_landed(spark, table, landing, read, curate, polls=polls[:5])
    assert (first.load, first.days) == (1, 5) and first.files >= 5
    overlap = ld.load_landed(spark, table, landing, read, curate, polls=polls[3:8])
    assert overlap.load == 2 and overlap.days == 3             # the two polls that overlap were taken already
    assert ld.load_landed(spark, table, landing, read, curate, polls=polls[:8]) == ld.Loaded(None, 0, 0)
    wanted = cat.stored_readings(spark, SF_SMALL, keep_day=True).where(F.date_format("obs_day", "yyyyMMdd").isin(polls[:8]))
    same_rows(ld.table_readings(spark, table), wanted)
    assert ld.loaded_files(spark, table).groupBy("file_path").count().where("count > 1").count() == 0
    newest = ld.load_newest(spark, table, landing, read, curate)
    assert newest.days == 1 and ld.load_newest(spark, table, landing, read, curate).load is None


def test_a_load_replaces_the_touched_days_alone(spark, table, landing):
    read, curate = cat._loader(spark, SF_SMALL)
    polls = polls_of(spark, landing)
    ld.load_landed(spark, table, landing, read, curate, polls=polls[:4])
    files = lambda: {d: sorted(os.listdir(d)) for d in glob.glob(f"{table.data}/obs_day=*")}
    before = files()
    ld.load_landed(spark, table, landing, read, curate, polls=polls[4:5])
    after = files()
    assert len(after) == len(before) + 1 and all(after[d] == before[d] for d in before)


def test_a_file_that_grew_is_new(spark, table, workdir):
    """A poll file that is written anew under its old name with more stations: its day gains them, nothing comes twice."""
    read, curate = cat._loader(spark, SF_SMALL)
    folder = f"{workdir}/landing"
    texts = poll_files(spark, SF_SMALL).orderBy("poll", "chunk").limit(2).collect()
    for r in texts:
        os.makedirs(f"{folder}/poll={r.poll}/chunk={r.chunk}")
        half = "[" + r.value[1:-1].split(',{"fields"')[0] + "]"
        with open(f"{folder}/poll={r.poll}/chunk={r.chunk}/part-0.txt", "w") as f:
            f.write(half)
    ld.load_landed(spark, table, folder, read, curate)
    few = ld.table_readings(spark, table).count()
    for r in texts:
        with open(f"{folder}/poll={r.poll}/chunk={r.chunk}/part-0.txt", "w") as f:
            f.write(r.value)
    assert ld.load_landed(spark, table, folder, read, curate).files == 2
    elements = sn.scan_snapshots(spark, folder, glob=sn.TEXT_GLOB).select("fields")
    same_rows(ld.table_readings(spark, table), curate(elements))
    assert 0 < few < ld.table_readings(spark, table).count()


@pytest.mark.parametrize("lost_at", ["stage", "days", "ledger"])
def test_a_lost_load_is_finished_or_begun_anew(spark, table, landing, monkeypatch, lost_at):
    read, curate = cat._loader(spark, SF_SMALL)
    polls = polls_of(spark, landing)
    ld.load_landed(spark, table, landing, read, curate, polls=polls[:3])
    kept = {"stage": ld.stage, "publish": ld.publish}

    class Lost(Exception):
        pass

    def stage(spark, table, load, merged, files):
        if lost_at != "stage":
            return kept["stage"](spark, table, load, merged, files)
        merged.write.mode("overwrite").partitionBy("obs_day").parquet(f"{table.staged(load)}/data")     # the files are missing
        raise Lost

    def publish(spark, table, load):
        if lost_at == "ledger":                                # days are replaced, the ledger entry is missing
            staged = spark.read.schema(table.schema).parquet(f"{table.staged(load)}/data")
            staged.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("obs_day").parquet(table.data)
        raise Lost

    monkeypatch.setattr(ld, "stage", stage)
    monkeypatch.setattr(ld, "publish", publish)
    with pytest.raises(Lost):
        ld.load_landed(spark, table, landing, read, curate, polls=polls[2:6])
    monkeypatch.setattr(ld, "stage", kept["stage"])
    monkeypatch.setattr(ld, "publish", kept["publish"])
    assert ld.unfinished_loads(spark, table) == ([] if lost_at == "stage" else [2])
    after = ld.load_landed(spark, table, landing, read, curate, polls=polls[2:6])
    assert after.load == (2 if lost_at == "stage" else None)
    wanted = cat.stored_readings(spark, SF_SMALL, keep_day=True).where(F.date_format("obs_day", "yyyyMMdd").isin(polls[:6]))
    same_rows(ld.table_readings(spark, table), wanted)
    assert ld.loaded_files(spark, table).groupBy("file_path").count().where("count > 1").count() == 0


def test_late_weather_replaces_its_days(spark, table, landing):
    read, curate = cat._loader(spark, SF_SMALL, weather=False)
    ld.load_landed(spark, table, landing, read, curate)
    weather = cat.weather_days(spark, SF_SMALL)
    days = [r.obs_day for r in weather.orderBy("obs_day").limit(3).collect()]
    done = ld.backfill_days(spark, table, weather.where(F.col("obs_day").isin(days)))
    assert done.days == 3
    rows = ld.table_readings(spark, table)
    assert rows.where(F.col("obs_day").isin(days) & F.col("soleil").isNull()).count() == 0
    assert rows.where(~F.col("obs_day").isin(days) & F.col("soleil").isNotNull()).count() == 0
    ld.backfill_days(spark, table, weather)
    assert ld.backfill_days(spark, table, weather) == ld.Loaded(None, 0, 0)
    same_rows(ld.table_readings(spark, table), cat.stored_readings(spark, SF_SMALL, keep_day=True))


def test_an_empty_landing_folder(spark, table, workdir):
    os.makedirs(f"{workdir}/landing/poll=20240101")
    read, curate = cat._loader(spark, SF_SMALL)
    assert ld.load_landed(spark, table, f"{workdir}/landing", read, curate) == ld.Loaded(None, 0, 0)
    assert ld.load_newest(spark, table, f"{workdir}/landing", read, curate) == ld.Loaded(None, 0, 0)
    assert ld.table_readings(spark, table).count() == 0


# --- compaction --------------------------------------------------------------------------------

def ingested(spark, workdir, parts):
    """A stream's table of one micro-batch for each landed file; its schema and its landing folder."""
    landing, sink, log = (f"{workdir}/{n}" for n in ("landing", "sink", "log"))
    elements = snapshot_elements(spark, SF_SMALL, nested=True)
    for k in range(parts):
        sn.write_landing(elements.where(F.pmod(F.xxhash64("fields.number", "fields.last_update"), F.lit(parts)) == k).coalesce(1), f"{landing}/part={k}")

    def run():
        stream = st.stream_readings(st.stream_elements(spark, landing, max_files=1), cat.weather_days(spark, SF_SMALL))
        st.ingest_into_table(stream, sink, log)
        return [f for f in stream.schema if f.name != "event_time"]

    from pyspark.sql import types as T
    return sink, T.StructType(run()), landing, run


def expected(spark, landing):
    return cur.readings_from_elements(sn.scan_snapshots(spark, landing, multi_line=False), cat.weather_days(spark, SF_SMALL))


def test_twenty_batches_become_few_files(spark, workdir):
    sink, schema, landing, run = ingested(spark, workdir, 20)
    assert len(glob.glob(f"{sink}/batch=*")) == 20
    target = 40_000
    before = {}
    for f in glob.glob(f"{sink}/batch=*/obs_day=*/*.parquet"):
        before.setdefault(f.split("obs_day=")[1][:10], []).append(os.path.getsize(f))
    assert max(map(len, before.values())) >= 15
    assert cp.compact(spark, sink, schema, target) == 1
    assert cp.compact(spark, sink, schema, target) is None
    for day, sizes in before.items():
        assert 1 <= len(glob.glob(f"{sink}/batch=-1/obs_day={day}/*.parquet")) <= math.ceil(sum(sizes) / target)
    assert cp.file_report(spark, sink, target).where("n_files > most").count() == 0
    same_rows(cp.read_current(spark, sink, schema).select(*cur.READING_COLUMNS), expected(spark, landing).select(*cur.READING_COLUMNS))
    # later batches are read beside the manifest; the next compaction writes only the days that they touch
    one_day = snapshot_elements(spark, SF_SMALL, nested=True).where(F.col("fields.last_update").startswith("2024-01-05"))
    sn.write_landing(one_day.coalesce(1), f"{landing}/part=again")
    run()
    wanted = expected(spark, landing).select(*cur.READING_COLUMNS)
    same_rows(cp.read_current(spark, sink, schema).select(*cur.READING_COLUMNS), wanted)
    version = cp.compact(spark, sink, schema, target)
    assert [os.path.basename(d) for d in glob.glob(f"{sink}/batch=-{version}/obs_day=*")] == ["obs_day=2024-01-05"]
    same_rows(cp.read_current(spark, sink, schema).select(*cur.READING_COLUMNS), wanted)


def test_replayed_batches_and_lost_compactions(spark, workdir):
    sink, schema, landing, _ = ingested(spark, workdir, 4)
    wanted = expected(spark, landing).select(*cur.READING_COLUMNS)
    # a compaction that was lost: its folder has rows, no manifest names it
    spark.read.parquet(f"{sink}/batch=0").write.partitionBy("obs_day").parquet(f"{sink}/batch=-1")
    same_rows(cp.read_current(spark, sink, schema).select(*cur.READING_COLUMNS), wanted)
    assert cp.compact(spark, sink, schema) == 2
    # one whose manifest was begun and not ended
    os.makedirs(f"{sink}/_manifests/v=3")
    assert cp.newest_manifest(spark, sink)[0] == 2
    # the stream runs a covered batch again: it replaces its own folder, which nobody reads any more
    spark.read.schema(schema).parquet(f"{sink}/batch=2").write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(f"{workdir}/copy")
    spark.read.parquet(f"{workdir}/copy").write.mode("overwrite").partitionBy("obs_day").parquet(f"{sink}/batch=2")
    same_rows(cp.read_current(spark, sink, schema).select(*cur.READING_COLUMNS), wanted)
    # a batch that is being written is not read yet
    os.makedirs(f"{sink}/batch=9/obs_day=2024-01-01")
    same_rows(cp.read_current(spark, sink, schema).select(*cur.READING_COLUMNS), wanted)


def test_packing_is_by_bytes(spark):
    files = spark.createDataFrame([(f"f{k:02d}", s, d) for d, sizes in (("a", [10, 10, 10, 10]), ("b", [70, 5, 5]), ("c", [100])) for k, s in enumerate(sizes)],
                                  "file_path STRING, length BIGINT, day STRING")
    bins = {(r.day, r.file_path): r.bin for r in cp.packed_files(files, 25).collect()}
    assert [bins["a", f"f0{k}"] for k in range(4)] == [0, 0, 0, 1]
    assert len({v for (d, _), v in bins.items() if d == "b"}) <= math.ceil(80 / 25) and bins["c", "f00"] == 0


def test_a_load_table_builds_no_other_table(spark):
    cat._TABLES.clear()
    schema = cat._load_table(spark, SF_SMALL).schema
    assert [k[0] for k in cat._TABLES] == ["weather_daily"]
    assert schema == cat.stored_readings(spark, SF_SMALL, keep_day=True).schema
