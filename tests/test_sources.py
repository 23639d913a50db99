"""Snapshot files (S1, F5, S7), weather CSV (S3, F4), curation on files, no lost rows (Q5)."""

import json
import os

from pyspark.sql import functions as F

from dockcast.operators import curate as cur
from dockcast.sources import snapshots as sn
from dockcast.sources import weather as we


def _el(number, name, when, stands, bikes, status="OPEN", pos=(48.8, 2.3)):
    return {"fields": {"number": number, "name": name, "last_update": when, "available_bike_stands": stands,
                       "available_bikes": bikes, "position": list(pos), "status": status}}


def _write(path, name, text):
    with open(os.path.join(path, name), "w") as f:
        f.write(text)


def _landing(d):
    good = [_el(10019, "10019 - PARADIS", "2017-02-26T18:29:59+00:00", 0, 10),
            _el("10020", "10020 - Gare", "2017-02-26T18:31:00+01:00", "4", None),
            _el(10021, "10021 - closed", "2017-02-26T18:31:00+00:00", 3, 3, status="CLOSED"),
            _el(10022, "10022 - zulu", "2017-02-26T19:04:00Z", 9, "junk"),
            {"other": 1}]
    _write(d, "poll_1.json", json.dumps(good))
    _write(d, "poll_2.json", json.dumps(good[:2]))                      # same rows again
    _write(d, "poll_3.json", json.dumps(good)[:-20])                    # truncated
    _write(d, "poll_4.json", "this is not json")
    _write(d, "poll_5.json", "")
    ten = [_el(20000 + i, f"{20000 + i} - Ten", "2017-02-27T08:0%d:00+00:00" % i, i, i) for i in range(10)]
    _write(d, "poll_6.json", json.dumps(ten))
    _write(d, ".json", json.dumps(good))                                 # '.json' at position 0: not a snapshot
    _write(d, "notes.txt", "ignored")
    return d


def test_scan_drops_bad_files_and_keeps_elements(spark, workdir):
    d = _landing(workdir)
    el = sn.scan_snapshots(spark, d)
    # 5 + 2 + 10 elements from the three good files, less the one without fields; the bad files and
    # '.json' are dropped whole
    assert el.count() == 16
    opened = cur.parse_fields(cur.open_elements(el))
    assert opened.count() == 3 + 2 + 10                                  # CLOSED and fields-less dropped
    r = {row.id: row for row in cur.derive(opened).collect()}
    assert (r[10019].places, r[10019].bikes, r[10019].label, r[10019].x) == (0, 10, 6.0, 1105)
    assert (r[10020].places, r[10020].bikes, r[10020].hour) == (4, 0, 18)   # numeric text, null count -> 0
    assert (r[10022].bikes, r[10022].hour, r[10022].minute) == (0, 19, 0)  # junk count -> 0, Z suffix


def test_curate_dedups_and_loses_nothing(spark, workdir):
    d = _landing(workdir)
    readings = cur.curate(sn.scan_snapshots(spark, d), None)
    assert readings.count() == 3 + 10          # second copy of two rows removed, ten-row file intact
    assert readings.where(F.col("name").contains("Ten")).count() == 10


def test_rejected_files_are_reported(spark, workdir):
    d = _landing(workdir)
    bad = {r.file_name for r in sn.rejected_files(spark, d).collect()}
    assert bad == {"poll_3.json", "poll_4.json"}


def test_landed_file_inventory(spark, workdir):
    d = _landing(workdir)
    names = sorted(r.file_name for r in sn.landed_files(spark, d).collect())
    assert names == [f"poll_{i}.json" for i in (1, 2, 3, 4, 6)]           # poll_5 is empty: no snapshot


def test_a_bad_position_costs_itself_alone(spark, workdir):
    """Positions as text, null, junk or of another kind next to good ones: no neighbour is lost."""
    odd = [_el(1, "a", "2017-02-26T18:29:59+00:00", 1, 1), _el(2, "b", "2017-02-26T18:29:59+00:00", 1, 1, pos=("48.8", "2.3")),
           _el(3, "c", "2017-02-26T18:29:59+00:00", 1, 1), _el(4, "d", "2017-02-26T18:29:59+00:00", 1, 1), _el(5, "e", "2017-02-26T18:29:59+00:00", 1, 1)]
    odd[2]["fields"]["position"], odd[3]["fields"]["position"], odd[4]["fields"]["position"] = None, "here", {"lat": 1}
    for name, lines in (("array", False), ("lines", True)):
        d = os.path.join(workdir, name)
        os.mkdir(d)
        _write(d, "poll_1.json", "\n".join(map(json.dumps, odd)) if lines else json.dumps(odd))
        rows = cur.parse_fields(cur.open_elements(sn.scan_snapshots(spark, d, multi_line=not lines))).collect()
        assert {r.id: (r.lt, r.lg) for r in rows} == {1: (48.8, 2.3), 2: (48.8, 2.3), 3: (None, None), 4: (None, None), 5: (None, None)}
        assert sn.rejected_files(spark, d, multi_line=not lines).count() == 0


def test_newest_poll_is_found_by_listing(spark, workdir):
    files = spark.createDataFrame([("20240101", 0, "[]"), ("20240103", 0, "[]"), ("20240102", 1, "[]")], "poll string, chunk int, value string")
    path = sn.write_poll_files(files, os.path.join(workdir, "polls"), ["poll", "chunk"])
    assert sn.newest_poll(spark, path) == "20240103"


def test_append_touches_only_its_days(spark):
    base = spark.createDataFrame([(1, "2024-01-01"), (2, "2024-01-02")], "v int, d string").select("v", F.col("d").cast("date").alias("obs_day"))
    more = spark.createDataFrame([(2, "2024-01-02"), (3, "2024-01-02"), (3, "2024-01-02")], "v int, d string").select("v", F.col("d").cast("date").alias("obs_day"))
    out = cur.append_readings(base, more, ["2024-01-02"])
    assert sorted(r.v for r in out.collect()) == [1, 2, 3]


def test_late_weather_is_filled_in(spark, workdir):
    d = _landing(workdir)
    early = cur.curate(sn.scan_snapshots(spark, d), None)
    days = spark.createDataFrame([("2017-02-26", 1.0)], "d string, soleil double").select(F.col("d").cast("date").alias("obs_day"), "soleil")
    filled = cur.backfill_weather(early, days)
    assert filled.columns == early.columns and filled.count() == early.count()
    assert filled.where("soleil = 1").count() == 3 and filled.where("soleil is null").count() == 10
    assert cur.backfill_weather(filled, days.withColumn("soleil", F.lit(0.0))).where("soleil = 1").count() == 3


def test_name_filter_case_insensitive_and_none(spark, workdir):
    d = _landing(workdir)
    typed = cur.parse_fields(cur.open_elements(sn.scan_snapshots(spark, d)))
    assert cur.filter_name(typed, "paradis").count() == 2      # poll_1 and its copy poll_2
    assert cur.filter_name(typed, None).count() == typed.count()


def test_append_keeps_every_row(spark):
    """Q5: the service lost size % 3 rows when appending; here ten rows stay ten."""
    base = spark.createDataFrame([(i, float(i)) for i in range(10)], "id bigint, v double")
    more = spark.createDataFrame([(i, float(i)) for i in range(10, 20)], "id bigint, v double")
    assert cur.append_readings(base, more).count() == 20


def test_weather_csv_pick_and_daily(spark, workdir):
    head = "numer_sta;date;pmer;tend;cod_tend;dd;ff;t;td;u;vv\n"
    rows = ["07190;20170226090000;1;2;3;4;5;290.15;280;71;1000",
            "07005;20170226090000;1;2;3;4;5;250.00;280;71;1000",
            "07190;20170226120000;1;2;3;4;5;280.15;280;71;1000",
            "07190;20170227090000;1;2;3;4;5;mq;280;71;1000",
            "07190;20170227120000;1;2;3;4;5;285.15;280;71;1000"]
    _write(workdir, "synop.2017022609.csv", head + "\n".join(rows) + "\n")
    obs = we.scan_weather(spark, workdir)
    assert obs.columns == ["numer_sta", "date", "t", "u"]
    days = {r.obs_day.strftime("%Y%m%d"): r for r in we.daily_weather(obs).collect()}
    assert set(days) == {"20170226", "20170227"}
    assert abs(days["20170226"].temperature - 17.0) < 1e-9 and days["20170226"].soleil == 1.0
    assert abs(days["20170227"].temperature - 12.0) < 1e-9 and days["20170227"].soleil == 0.0   # 'mq' skipped


def test_weather_join_missing_day_is_null(spark):
    readings = spark.createDataFrame([(1, "20170226"), (2, "20170228")], "id bigint, obs_day string")
    days = spark.createDataFrame([("20170226", 17.0, 1.0)], "obs_day string, temperature double, soleil double")
    got = {r.id: r.soleil for r in cur.attach_weather(readings, days).collect()}
    assert got == {1: 1.0, 2: None}


def test_inferred_json_scan(spark, workdir):
    d = _landing(workdir)
    df = sn.scan_json_inferred(spark, os.path.join(d, "poll_1.json"))
    assert "fields" in df.columns or "_corrupt_record" in df.columns


def test_documents_are_read_once(spark, workdir):
    """A position is text with another JSON value: it costs no second read of its file."""
    elements = [_el(str(k), "s", "2024-01-01T10:00:00+00:00", 4, 3) for k in range(500)]
    _write(workdir, "poll_a.json", json.dumps(elements, indent=1))
    size = os.path.getsize(os.path.join(workdir, "poll_a.json"))
    read = lambda: sum(s.getBytesRead() for s in spark._jvm.org.apache.hadoop.fs.FileSystem.getAllStatistics() if s.getScheme() == "file")
    before = read()
    rows = sn.scan_snapshots(spark, workdir).select("fields.position", "fields.available_bikes").collect()
    assert len(rows) == 500 and {json.loads(r.position) == [48.8, 2.3] for r in rows} == {True} and {r.available_bikes for r in rows} == {"3"}
    assert read() - before < 3 * size


def test_faulty_documents_are_told_apart(spark, workdir):
    good = json.dumps([_el("1", "s", "x", 4, 3), _el("2", "s", "x", 4, 3)], indent=1)
    for name, text in (("good", good), ("cut", good[:-9]), ("one", json.dumps(_el("3", "s", "x", 4, 3), indent=1)), ("junk", "no json"), ("blank", " \n ")):
        _write(workdir, f"poll_{name}.json", text)
    assert sorted(r.number for r in sn.scan_snapshots(spark, workdir).select("fields.number").collect()) == ["1", "2", "3"]
    assert {r.file_name: r.bad_records for r in sn.rejected_files(spark, workdir).collect()} == {"poll_cut.json": 1, "poll_junk.json": 1}
