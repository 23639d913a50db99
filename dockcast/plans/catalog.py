"""Registered queries: each takes (spark, sf_dir) and returns a DataFrame over the whole tables.

the session's shared checkpoint folder, each run into a new sub-folder.
"""

from __future__ import annotations

import json
import math
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from dockcast.functions import bins as B
from dockcast.functions import text as TX
from dockcast.functions import time as TM
from dockcast.operators import curate as cur
from dockcast.operators import features as fe
from dockcast.operators import load as ld
from dockcast.operators import lookup as lk
from dockcast.operators import metrics as me
from dockcast.operators import model as mo
from dockcast.operators import scenario as sc
from dockcast.operators import sinks as sk
from dockcast.operators import split as sp
from dockcast.operators import training as tr
from dockcast.operators.joins import DIMENSION_MAX_ROWS, bounded_broadcast
from dockcast.session import child_names, input_mark, path_exists, scratch_path, scratch_root, write_table
from dockcast.sources import drift as dr
from dockcast.sources import snapshots as sn
from dockcast.sources.adapter import drifting_files, faulty_lines, forecast_requests, poll_files, snapshot_elements, weather_observations
from dockcast.sources.snapshots import scan_snapshots, write_landing
from dockcast.sources.tables import read_table, table_path
from dockcast.sources.weather import daily_weather, scan_weather, write_synop

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

# Parameters of the registered queries (the source's own defaults where it has one).
NAME_FILTER = "TION_1"       # F2 example; the source default "PA" matches no stand-in name
LOOKUP_TEXT = "NATION_1"     # F3 example (case-sensitive)
DROPPED = ["lg", "lt", "dtUpdate", "nPlace", "nBike"]   # P2, fixed values: the columns createTrain drops


def register(name: str):
    def deco(fn: Query) -> Query:
        QUERIES[name] = fn
        return fn
    return deco


# --- shared building blocks -------------------------------------------------------------------

_TABLES: dict[tuple, tuple] = {}   # (name, input mark, scratch root) -> (path, rows, schema json)


def source_mark(spark: SparkSession, sf_dir: str) -> tuple:
    """The state of the given tables that stored ones are derived from: when they change, the stored
    ones are built anew."""
    return input_mark(spark, table_path(sf_dir, "events"), table_path(sf_dir, "nation"))


def stored(spark: SparkSession, name: str, sf_dir: str, build: Callable[[], DataFrame],
           partition_by: list[str] | None = None) -> tuple[DataFrame, int]:
    """A table derived from the given tables, written once to the shared folder and read back by
    later queries (like the service's loaded and persisted dataset). Returns (table, row count);
    the count comes from parquet metadata right after the write."""
    key = (name, source_mark(spark, sf_dir), scratch_root(spark))
    hit = _TABLES.get(key)
    if hit is None or not path_exists(spark, hit[0]):
        df = build()
        path = scratch_path(spark, f"tables/{name}")
        if partition_by:
            sk.store_readings(df, path, partition_by[0], mode="errorifexists")
        else:
            df.write.mode("errorifexists").parquet(path)
        hit = (path, spark.read.schema(df.schema).parquet(path).count(), df.schema.json())
        _TABLES[key] = hit
    schema = StructType.fromJson(json.loads(hit[2]))
    return spark.read.schema(schema).parquet(hit[0]), hit[1]


def weather_table(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, int]:
    """Per-day weather (F4, C11, C10) as a small dimension table (one row per day)."""
    return stored(spark, "weather_daily", sf_dir, lambda: daily_weather(weather_observations(spark, sf_dir)))


def weather_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    return weather_table(spark, sf_dir)[0]


def readings(spark: SparkSession, sf_dir: str, name_filter: str | None = None, keep_day: bool = False) -> DataFrame:
    """The curated readings, computed from the given tables (A1 applied)."""
    w, n = weather_table(spark, sf_dir)
    return cur.curate(snapshot_elements(spark, sf_dir), w, name_filter, keep_day, n)


def stored_readings(spark: SparkSession, sf_dir: str, keep_day: bool = False) -> DataFrame:
    """The curated readings table, written once (partitioned by day) and read by downstream queries."""
    def build():
        w, n = weather_table(spark, sf_dir)
        return cur.curate_by_day(snapshot_elements(spark, sf_dir), w, weather_rows=n)

    df, _ = stored(spark, "readings", sf_dir, build, ["obs_day"])
    return df.select(*cur.READING_COLUMNS, *(["obs_day"] if keep_day else []))


def raw_readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Readings before the distinct (every open element once)."""
    return cur.readings_from_elements(snapshot_elements(spark, sf_dir), weather_days(spark, sf_dir)) \
              .select(*cur.READING_COLUMNS)


def typed_open(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Open elements with parsed types (id, name, ts, places, bikes, lt, lg)."""
    return cur.parse_fields(cur.open_elements(snapshot_elements(spark, sf_dir)))


def derived_open(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cur.derive(typed_open(spark, sf_dir))


def baseline_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Confusion counts of the deterministic baseline on the held-out part of the hash split."""
    r = stored_readings(spark, sf_dir)
    train, test = sp.split_parts(r)
    return me.confusion_counts(me.baseline_predictions(train, test))


def poll_landing(spark: SparkSession, sf_dir: str) -> str:
    """A landing folder of snapshot files in the service's own form (JSON arrays), a folder for each poll."""
    return sn.write_poll_files(poll_files(spark, sf_dir), scratch_path(spark, "landing/polls"), ["poll", "chunk"])


def load_polls(spark: SparkSession, sf_dir: str, landing: str, polls: list[str]) -> DataFrame:
    """Curated readings (with their day) of some polls: only their folders are scanned."""
    w, n = weather_table(spark, sf_dir)
    loads = [sn.scan_snapshots(spark, f"{landing}/poll={p}", glob=sn.TEXT_GLOB).select("fields") for p in polls]
    elements = loads[0]
    for more in loads[1:]:
        elements = elements.unionByName(more)
    return cur.curate(elements, w, keep_day=True, weather_rows=n)


# --- sources ----------------------------------------------------------------------------------

@register("curate_readings")
def q_curate_readings(spark, sf_dir):
    """Flagship: elements -> P1, F1, C1-C13, J1, A1 over all events."""
    return readings(spark, sf_dir)


@register("scan_snapshots")
def q_scan_snapshots(spark, sf_dir):
    """Land the elements as snapshot files, scan the landing folder, curate."""
    path = write_landing(snapshot_elements(spark, sf_dir, nested=True), scratch_path(spark, "landing"))
    w, n = weather_table(spark, sf_dir)
    return cur.curate(scan_snapshots(spark, path, multi_line=False), w, weather_rows=n)


@register("scan_array_files")
def q_scan_array_files(spark, sf_dir):
    """S1 in the service's own form: every file is one JSON array, read as one record."""
    w, n = weather_table(spark, sf_dir)
    return cur.curate(sn.scan_snapshots(spark, poll_landing(spark, sf_dir), glob=sn.TEXT_GLOB).select("fields"), w, weather_rows=n)


@register("landed_files")
def q_landed_files(spark, sf_dir):
    """How many snapshot files each poll landed, from the scan's own metadata."""
    files = sn.landed_files(spark, poll_landing(spark, sf_dir), "part-")
    poll = F.regexp_extract("file_path", "poll=([0-9]+)", 1)
    return files.where("length > 0").groupBy(poll.alias("poll")).agg(F.count(F.lit(1)).alias("n_files"))


def _faulty_landing(spark, sf_dir) -> str:
    return sn.write_poll_files(faulty_lines(spark, sf_dir), scratch_path(spark, "landing/faulty"), ["poll"])


@register("scan_faulty")
def q_scan_faulty(spark, sf_dir):
    """Elements with text, null and junk positions next to good ones; none is lost."""
    el = scan_snapshots(spark, _faulty_landing(spark, sf_dir), multi_line=False, glob=sn.TEXT_GLOB).select("fields")
    t = cur.parse_fields(cur.open_elements(el))
    return t.select("id", TM.epoch_millis("ts").alias("dtUpdate"), "bikes", "places", "lt", "lg")


@register("rejected_files")
def q_rejected_files(spark, sf_dir):
    """F5 accounting: records that do not parse, by poll."""
    bad = sn.rejected_files(spark, _faulty_landing(spark, sf_dir), multi_line=False, glob=sn.TEXT_GLOB)
    poll = F.regexp_extract("file_path", "poll=([0-9]+)", 1)
    return bad.groupBy(poll.alias("poll")).agg(F.sum("bad_records").alias("bad_records"))


@register("dropped_counts")
def q_dropped_counts(spark, sf_dir):
    """Q13: how many elements each rule of the load leaves out."""
    el = scan_snapshots(spark, _faulty_landing(spark, sf_dir), multi_line=False, glob=sn.TEXT_GLOB).select("fields")
    return cur.dropped_counts(el, weather_days(spark, sf_dir))


def _drifted(spark, sf_dir) -> DataFrame:
    landing = sn.write_poll_files(drifting_files(spark, sf_dir), scratch_path(spark, "landing/drift"), ["poll", "chunk"])
    return write_table(dr.field_types(dr.scan_variants(spark, landing, glob=sn.TEXT_GLOB)), spark, "tables/field_types")


@register("schema_by_poll")
def q_schema_by_poll(spark, sf_dir):
    """The inferred type of each field of each poll, and how many elements hold it."""
    return _drifted(spark, sf_dir).select("poll", "field", "n", F.regexp_extract("type", "^[A-Z]+", 0).alias("kind"))


@register("schema_drift")
def q_schema_drift(spark, sf_dir):
    """Fields that come, go or change their type from one poll to the next."""
    return dr.schema_drift(_drifted(spark, sf_dir))


@register("load_latest")
def q_load_latest(spark, sf_dir):
    """The newest poll of the landing folder (by listing) with its day's weather."""
    landing = poll_landing(spark, sf_dir)
    return load_polls(spark, sf_dir, landing, [sn.newest_poll(spark, landing)]).select(*cur.READING_COLUMNS)


@register("append_readings")
def q_append_readings(spark, sf_dir):
    """S5 + U1: readings up to the third newest day + the three newest polls as they landed, the
    oldest of which overlaps; union, then distinct on the polls' days alone (nothing lost, Q5)."""
    landing = poll_landing(spark, sf_dir)
    polls = [n.split("=")[1] for n in child_names(spark, landing) if n.startswith("poll=")][-3:]
    days = [f"{p[:4]}-{p[4:6]}-{p[6:]}" for p in polls]
    base = stored_readings(spark, sf_dir, keep_day=True).where(F.col("obs_day") <= F.lit(days[0]).cast("date"))
    return cur.append_readings(base, load_polls(spark, sf_dir, landing, polls), days).select(*cur.READING_COLUMNS)


def _load_table(spark, sf_dir) -> ld.LoadTable:
    w, n = weather_table(spark, sf_dir)
    # the plan's schema, nullable as a stored table's: no table is built for it
    schema = cur.curate(snapshot_elements(spark, sf_dir), w, keep_day=True, weather_rows=n).schema
    return ld.LoadTable(scratch_path(spark, "loads"), StructType([StructField(f.name, f.dataType) for f in schema]))


def _loader(spark, sf_dir, weather: bool = True):
    """How a load reads poll folders and curates their elements (before any weather landed, without it)."""
    w, n = weather_table(spark, sf_dir) if weather else (None, None)

    def read(folders: list[str]) -> DataFrame:
        return sn.scan_snapshots(spark, folders, glob=sn.TEXT_GLOB, base=folders[0].rsplit("/", 1)[0]).select("fields", "_metadata.file_path")

    return read, lambda elements: cur.curate(elements, w, keep_day=True, weather_rows=n)


AGAIN = 3                    # polls that are landed a second time


def _loads(spark, sf_dir) -> ld.LoadTable:
    """A table after overlapping loads: all but the two newest polls, the newest one (S6), what is left (S5), the newest
    polls landed once more in other files, and a load that finds nothing."""
    landing, (read, curate) = poll_landing(spark, sf_dir), _loader(spark, sf_dir)
    table = _load_table(spark, sf_dir)
    polls = sorted(n.split("=")[1] for n in child_names(spark, landing) if n.startswith("poll="))     # one for each day
    ld.load_landed(spark, table, landing, read, curate, polls=polls[:-2])
    ld.load_newest(spark, table, landing, read, curate)
    ld.load_landed(spark, table, landing, read, curate)
    again = poll_files(spark, sf_dir).where(F.col("poll").isin(polls[-AGAIN:])).withColumn("chunk", F.col("chunk") + 1_000_000)
    sn.write_poll_files(again, landing, ["poll", "chunk"], mode="append")
    for _ in range(2):
        ld.load_landed(spark, table, landing, read, curate)
    return table


@register("load_append")
def q_load_append(spark, sf_dir):
    """S5 + S6: the table after overlapping loads, read back: every reading once (distinct by touched day, ledger of files)."""
    return ld.table_readings(spark, _loads(spark, sf_dir)).select(*cur.READING_COLUMNS)


@register("load_ledger")
def q_load_ledger(spark, sf_dir):
    """The ledger after those loads: how many files of each poll were taken, and by how many loads."""
    poll = F.regexp_extract("file_path", "poll=([0-9]+)", 1)
    return ld.loaded_files(spark, _loads(spark, sf_dir)).groupBy(poll.alias("poll")).agg(
        F.count(F.lit(1)).alias("n_files"), F.countDistinct("load").alias("n_loads"))


@register("load_backfill")
def q_load_backfill(spark, sf_dir):
    """S5 + J1 late: a load before any weather landed; then the days that have weather now are replaced in the table."""
    landing, (read, curate) = poll_landing(spark, sf_dir), _loader(spark, sf_dir, weather=False)
    table = _load_table(spark, sf_dir)
    ld.load_landed(spark, table, landing, read, curate)
    ld.backfill_days(spark, table, *weather_table(spark, sf_dir))
    return ld.table_readings(spark, table).select(*cur.READING_COLUMNS)


@register("weather_backfill")
def q_weather_backfill(spark, sf_dir):
    """J1 late: readings stored before any weather landed get it from the weather table."""
    early = cur.curate(snapshot_elements(spark, sf_dir), None)
    w, n = weather_table(spark, sf_dir)
    return cur.backfill_weather(early, w, n)


@register("weather_daily")
def q_weather_daily(spark, sf_dir):
    """S3 + F4 + C11 + C10: observations written as synop files, scanned by position, reduced to
    the station's first observation per day."""
    path = write_synop(weather_observations(spark, sf_dir), scratch_path(spark, "landing/synop"))
    days = daily_weather(scan_weather(spark, path))
    return days.select(TM.day_text("obs_day").alias("obs_day"), "temperature", "soleil")


# --- projections, filters, dedup ------------------------------------------------------------------

@register("open_stations")
def q_open_stations(spark, sf_dir):
    """P1 + F1: fields of OPEN elements, as read."""
    f = cur.open_elements(snapshot_elements(spark, sf_dir))
    return f.select("number", "name", "last_update", "available_bike_stands", "available_bikes",
                    F.get("position", 0).alias("lt"), F.get("position", 1).alias("lg"), "status")


@register("name_filter")
def q_name_filter(spark, sf_dir):
    """case-insensitive name filter inside the load."""
    return readings(spark, sf_dir, name_filter=NAME_FILTER)


@register("station_lookup")
def q_station_lookup(spark, sf_dir):
    """stations whose name contains the text, latest reading each."""
    return lk.station_lookup(stored_readings(spark, sf_dir), LOOKUP_TEXT)


@register("drop_columns")
def q_drop_columns(spark, sf_dir):
    """P2."""
    return cur.drop_columns(stored_readings(spark, sf_dir), DROPPED)


@register("distinct_readings")
def q_distinct_readings(spark, sf_dir):
    """A1 over overlapping loads: every reading arrives twice, the distinct keeps one."""
    raw = raw_readings(spark, sf_dir)
    return cur.distinct_readings(raw.unionByName(raw))


@register("dedup_identity")
def q_dedup_identity(spark, sf_dir):
    """A2."""
    return cur.dedup_identity(stored_readings(spark, sf_dir))


@register("reading_count")
def q_reading_count(spark, sf_dir):
    """A3."""
    return cur.reading_count(stored_readings(spark, sf_dir))


@register("natural_order")
def q_natural_order(spark, sf_dir):
    """O2 (order itself is tested in pytest)."""
    return lk.natural_order(stored_readings(spark, sf_dir)).select("id", "dtUpdate", "label")


@register("preview")
def q_preview(spark, sf_dir):
    """K7: the first 1000 rows in natural order, text cut to 100 characters."""
    return lk.preview(stored_readings(spark, sf_dir))


@register("station_list")
def q_station_list(spark, sf_dir):
    """K8: listing text of the first 2000 readings by name, x."""
    return lk.station_listing(stored_readings(spark, sf_dir))


@register("split_train_test")
def q_split_train_test(spark, sf_dir):
    """Repeatable 60/40 hash split."""
    return sp.label_parts(stored_readings(spark, sf_dir)).select("id", "dtUpdate", "bucket", "part")


# --- joins and scenarios ------------------------------------------------------------------------

@register("weather_enrich")
def q_weather_enrich(spark, sf_dir):
    """J1 + C10/C11: each open reading with its day's temperature and warm flag."""
    days, n_days = weather_table(spark, sf_dir)
    w = bounded_broadcast(days, DIMENSION_MAX_ROWS, n_days)
    return derived_open(spark, sf_dir).join(w, "obs_day", "left") \
        .select("id", "dtUpdate", TM.day_text("obs_day").alias("obs_day"), "temperature", "soleil")


def _resolved(spark, sf_dir, upper: bool = False, requests: DataFrame | None = None, model: mo.StationModel | None = None):
    """Requests (all of them, or as given, such as bundles) with their stations, these with the index of ``model`` if one is given."""
    latest = lk.latest_per_station(stored_readings(spark, sf_dir))
    # stored, as the text match reads it for its n-grams and again for its rows
    stations = write_table(model.indexed(latest) if model else latest, spark, "tables/latest")
    return sc.resolve_requests(forecast_requests(spark, sf_dir) if requests is None else requests, stations, upper, spread=True)


def _scenarios(spark, sf_dir, delay: bool, model: mo.StationModel | None = None) -> DataFrame:
    """P4 or P5 with ``req_id`` as bundles: a row for each station, time and bundle of the requests that ask for them."""
    times = (sc.delay_times if delay else sc.explicit_times)(forecast_requests(spark, sf_dir))
    bundles = sc.bundled(times.select("req_id", "station", *[f"at_{c}" for c in sc.AT]))
    return (sc.scenario_delay if delay else sc.scenario_explicit)(_resolved(spark, sf_dir, delay, bundles, model))


@register("request_resolve")
def q_request_resolve(spark, sf_dir):
    """Requests by station text -> all matching stations."""
    bundles = sc.bundled(forecast_requests(spark, sf_dir).select("req_id", "station"))
    return sc.unbundled(_resolved(spark, sf_dir, requests=bundles).select("req_id", "station", "id", "station_name"))


@register("scenario_delay")
def q_scenario_delay(spark, sf_dir):
    """P4 (the delay route upper-cases the station text)."""
    return sc.unbundled(_scenarios(spark, sf_dir, delay=True))


@register("scenario_explicit")
def q_scenario_explicit(spark, sf_dir):
    """P5."""
    return sc.unbundled(_scenarios(spark, sf_dir, delay=False))


# --- scalar functions ---------------------------------------------------------------------------

@register("parse_update_time")
def q_parse_update_time(spark, sf_dir):
    """C1 + C2 on every open element."""
    f = cur.open_elements(snapshot_elements(spark, sf_dir))
    return f.select("number", "last_update", TM.epoch_millis(TM.parse_update_time("last_update")).alias("dtUpdate"))


@register("time_features")
def q_time_features(spark, sf_dir):
    """C3-C6 (+ minute_of_week)."""
    return derived_open(spark, sf_dir).select("id", "dtUpdate", "day", "hour", "minute", "x", "minute_of_week")


@register("availability_bins")
def q_availability_bins(spark, sf_dir):
    """C7-C9."""
    return derived_open(spark, sf_dir).select("id", "dtUpdate", "bikes", "places", "nBike", "nPlace", "label")


@register("on_poll_minute")
def q_on_poll_minute(spark, sf_dir):
    """C22."""
    t = typed_open(spark, sf_dir)
    return t.select("id", TM.epoch_millis("ts").alias("dtUpdate"), TM.on_poll_minute("ts").alias("on_poll"))


@register("label_text")
def q_label_text(spark, sf_dir):
    """C14."""
    return stored_readings(spark, sf_dir).select("id", "dtUpdate", "label", B.label_text("label").alias("label_text"))


@register("clamp")
def q_clamp(spark, sf_dir):
    """C15."""
    return stored_readings(spark, sf_dir).select("id", "dtUpdate", "bikes", "places",
                                          B.clamp("bikes").alias("bikes_clamped"),
                                          B.clamp("places").alias("places_clamped"))


@register("date_text")
def q_date_text(spark, sf_dir):
    """C17."""
    ts = TM.from_epoch_millis("dtUpdate")
    return stored_readings(spark, sf_dir).select("id", "dtUpdate", TM.day_text(ts).alias("day_text"),
                                          TM.short_text(ts).alias("short_text"))


# --- metrics ------------------------------------------------------------------------------------

@register("confusion_pivot")
def q_confusion_pivot(spark, sf_dir):
    """A4 (matrix form): one row per actual class, one column per predicted class."""
    return me.confusion_matrix(baseline_counts(spark, sf_dir))


@register("confusion_matrix")
def q_confusion_matrix(spark, sf_dir):
    """A4 (long form) on the baseline's held-out predictions."""
    return baseline_counts(spark, sf_dir)


@register("accuracy")
def q_accuracy(spark, sf_dir):
    """A5."""
    return me.accuracy(baseline_counts(spark, sf_dir))


@register("class_metrics")
def q_class_metrics(spark, sf_dir):
    """A6."""
    return me.class_metrics(baseline_counts(spark, sf_dir))


@register("weighted_metrics")
def q_weighted_metrics(spark, sf_dir):
    """A7."""
    return me.weighted_metrics(me.class_metrics(baseline_counts(spark, sf_dir)))


# --- features -----------------------------------------------------------------------------------

@register("id_index")
def q_id_index(spark, sf_dir):
    """Frequency order of station ids as the fitted indexer sees it."""
    return fe.id_index_table(fe.usable(stored_readings(spark, sf_dir)))


@register("input_vector")
def q_input_vector(spark, sf_dir):
    """The display vector [id, day, hour, minute, soleil] (as columns)."""
    from pyspark.ml.functions import vector_to_array
    v = vector_to_array(fe.input_vector())
    return fe.usable(stored_readings(spark, sf_dir)).select(
        "id", "dtUpdate", *[v[i].alias(f"i{i}") for i in range(len(fe.INPUT_VECTOR_COLUMNS))])


@register("features_l2")
def q_features_l2(spark, sf_dir):
    """M1-M3 (M5)."""
    return fe.features_l2(fe.usable(stored_readings(spark, sf_dir)))


@register("features_l1")
def q_features_l1(spark, sf_dir):
    """M4."""
    return fe.features_l1(fe.usable(stored_readings(spark, sf_dir)))


@register("features_station")
def q_features_station(spark, sf_dir):
    """M2 with a vector of its own for the station: which positions of the assembled features are not zero."""
    rows = fe.usable(stored_readings(spark, sf_dir))
    index = write_table(fe.id_index_table(rows).select("id", "id_index"), spark, "tables/id_index")
    return fe.features_station(rows, index, float(index.count()))


# --- sinks --------------------------------------------------------------------------------------

@register("export_ordered")
def q_export_ordered(spark, sf_dir):
    """K1/K2: ordered CSV export of the readings, read back with the declared schema."""
    r = stored_readings(spark, sf_dir)
    path = sk.export_ordered(r, scratch_path(spark, "exports/readings"))
    return sk.read_export(spark, path, r.schema)


# --- model: what SQL can state about a fit (a fit's numbers themselves have no SQL form) ---------

TRAIN_HIDDEN = "20-20"     # first topology of the service's search list
TRAIN_ITERS = 100          # the service's default
_MODELS: dict[tuple, str] = {}        # (input mark, hidden, iters, scratch root) -> saved model folder


def split_rows(spark: SparkSession, sf_dir: str):
    """Usable readings split 60/40 by hash (train, test); both lazy."""
    return sp.split_parts(fe.usable(stored_readings(spark, sf_dir)))


def training_rows(spark: SparkSession, sf_dir: str):
    """The split, with the training part written to the shared folder (what the fit iterates on)."""
    train, test = split_rows(spark, sf_dir)
    return mo.materialize(spark, train, "train"), test


def _model_key(spark: SparkSession, sf_dir: str, hidden: str, iters: int) -> tuple:
    return (source_mark(spark, sf_dir), hidden, iters, scratch_root(spark))


def trained_model(spark: SparkSession, sf_dir: str, hidden: str = TRAIN_HIDDEN, iters: int = TRAIN_ITERS):
    """Fit once per (data, topology, iterations) and keep the saved model's folder; later calls load
    it (and write nothing). Returns (StationModel, test rows)."""
    key = _model_key(spark, sf_dir, hidden, iters)
    path = _MODELS.get(key)
    if not path or not path_exists(spark, path):
        train, _ = training_rows(spark, sf_dir)
        res = mo.train(train, mo.topology(hidden), iters)
        path = _MODELS[key] = mo.save(res.model, mo.model_path(spark, res.layers))
    return mo.load(spark, path), split_rows(spark, sf_dir)[1]


def valid_class(c: str = "prediction"):
    """A prediction is one of the nine classes."""
    return (F.col(c) >= 0) & (F.col(c) < B.N_CLASSES) & (F.col(c) == F.floor(F.col(c)))


def fit_summary(spark: SparkSession, res, train_rows: int) -> DataFrame:
    """What holds of any good fit: topology, number of weights, training rows, and whether the loss is
    finite and not above the one it started from."""
    ok = bool(res.objective) and math.isfinite(res.objective[-1]) and res.objective[-1] <= res.objective[0]
    return spark.createDataFrame([("-".join(map(str, res.layers)), mo.n_weights(res.layers), train_rows, ok)],
                                 "layers STRING, n_weights INT, train_rows BIGINT, loss_ok BOOLEAN")


@register("train_model")
def q_train_model(spark, sf_dir):
    """M6 (+K4): fit index and MLP on the training part, save; one summary row."""
    train, _ = training_rows(spark, sf_dir)
    res = mo.train(train, mo.topology(TRAIN_HIDDEN), TRAIN_ITERS)
    _MODELS[_model_key(spark, sf_dir, TRAIN_HIDDEN, TRAIN_ITERS)] = mo.save(res.model, mo.model_path(spark, res.layers))
    return fit_summary(spark, res, train.count())


@register("model_weights")
def q_model_weights(spark, sf_dir):
    """The weight vector of the fitted MLP, by index."""
    w = mo.weights_frame(spark, trained_model(spark, sf_dir)[0])
    finite = ~F.isnan("weight") & (F.abs("weight") < float("inf"))
    return w.select("idx", finite.alias("finite"))


@register("predict_batch")
def q_predict_batch(spark, sf_dir):
    """M8: score the held-out rows with the saved model (no refit, Q1)."""
    model, test = trained_model(spark, sf_dir)
    return mo.predict(model, test).select("id", "dtUpdate", "label", valid_class().alias("valid"))


@register("model_roundtrip")
def q_model_roundtrip(spark, sf_dir):
    """A model scores alike before saving and after loading, its weights survive the text
    form, and an untrained classifier keeps its settings."""
    train, test = training_rows(spark, sf_dir)
    res = mo.train(train, mo.topology(TRAIN_HIDDEN), TRAIN_ITERS)
    again = mo.load(spark, mo.save(res.model, mo.model_path(spark, res.layers)))
    text = mo.write_weights_text(spark, again, scratch_path(spark, "models/text"))
    same_weights = mo.read_weights_text(spark, text) == mo.mlp_stage(res.model).weights.toArray().tolist()
    mlp = mo.load_classifier(mo.save_classifier(mo.perceptron(res.layers, 7), scratch_path(spark, "models/untrained")))
    same_settings = (list(mlp.getLayers()), mlp.getMaxIter(), mlp.getBlockSize()) == (res.layers, 7, mo.BLOCK_SIZE)
    plain = lambda df, name: mo.prediction_columns(df).drop("id_index").withColumnRenamed("prediction", name)
    scored = plain(mo.predict(again, plain(mo.predict(res.model, test), "before")), "after")
    return scored.select("id", "dtUpdate", (F.col("before") == F.col("after")).alias("same_prediction"),
                         F.lit(same_weights).alias("same_weights"), F.lit(same_settings).alias("same_settings"))


@register("warm_start")
def q_warm_start(spark, sf_dir):
    """The saved model's weights start a fit of the same net: it begins at the loss they have and does not end above it."""
    train, _ = training_rows(spark, sf_dir)
    first, _ = trained_model(spark, sf_dir)
    second = mo.train(train, mo.topology(TRAIN_HIDDEN), TRAIN_ITERS, warm=first)
    third = mo.train(train, mo.topology(TRAIN_HIDDEN), 1, warm=second.model)
    starts = abs(third.objective[0] - second.objective[-1]) <= 1e-6 * max(1.0, abs(second.objective[-1]))
    ends = third.objective[-1] <= second.objective[-1] + 1e-9
    return fit_summary(spark, second, train.count()).withColumns({"starts_there": F.lit(starts), "not_worse": F.lit(ends)})


@register("train_stepwise")
def q_train_stepwise(spark, sf_dir):
    """The default iterations in five chunks, each from the weights before it."""
    train, _ = training_rows(spark, sf_dir)
    chunks = mo.chunk_sizes(TRAIN_ITERS, above=TRAIN_ITERS - 1)
    results = mo.train_in_chunks(train, mo.topology(TRAIN_HIDDEN), chunks)
    rows = [(k, n, mo.n_weights(r.layers), r.iterations <= n, k == 0 or r.objective[-1] <= results[k - 1].objective[-1] + 1e-9)
            for k, (n, r) in enumerate(zip(chunks, results))]
    return spark.createDataFrame(rows, "chunk INT, iterations INT, n_weights INT, within BOOLEAN, not_worse BOOLEAN")


@register("retrain")
def q_retrain(spark, sf_dir):
    """Retrain on the current table from the saved model."""
    train, _ = training_rows(spark, sf_dir)
    res, test = mo.retrain(spark, stored_readings(spark, sf_dir), TRAIN_HIDDEN, TRAIN_ITERS, warm=trained_model(spark, sf_dir)[0])
    return fit_summary(spark, res, train.count()).withColumn("test_rows", F.lit(test.count()).cast("bigint"))


@register("persist_training")
def q_persist_training(spark, sf_dir):
    """K6: the training set as a stored table, persisted in memory with spill to disk while it is used."""
    train, _ = training_rows(spark, sf_dir)
    kept = sk.persist_training(train)
    try:
        level = kept.storageLevel
        spills = level.useMemory and level.useDisk
        return write_table(kept.select("id", "dtUpdate", "label", F.lit(spills).alias("spills")), spark, "tables/persisted")
    finally:
        kept.unpersist()


@register("evaluate_model")
def q_evaluate_model(spark, sf_dir):
    """M9: the whole report on the saved model's held-out predictions (Q2), reduced to what must hold:
    the classes' sizes, and that every section agrees with the confusion counts."""
    model, test = trained_model(spark, sf_dir)
    report = write_table(me.model_report(mo.predict(model, test)), spark, "tables/report")
    return me.report_checks(report)


@register("forecast")
def q_forecast(spark, sf_dir):
    """Every request's stations at now + delay, scored with the saved model."""
    model, _ = trained_model(spark, sf_dir)
    return _forecast(mo.predict(model, _scenarios(spark, sf_dir, True, model)))


@register("forecast_explicit")
def q_forecast_explicit(spark, sf_dir):
    """M8b (explicit form): every request's stations at the requested day/hour/minute, scored."""
    model, _ = trained_model(spark, sf_dir)
    return _forecast(mo.predict(model, _scenarios(spark, sf_dir, False, model)))


def _forecast(scored: DataFrame) -> DataFrame:
    """What SQL can state of a forecast: its rows, and that each has a class with its description. A station's time is scored once
    for each bundle of requests that ask for it; then each request gets a row."""
    rows = mo.forecast_rows(scored)
    return sc.unbundled(rows.select("req_id", "id", "name", "day", "hour", "minute", "soleil", valid_class().alias("valid"),
                                    F.col("description").isNotNull().alias("described")))


_TRIALS: dict[tuple, str] = {}        # (input mark, scratch root) -> folder of the search's trials
FOLDS = 3


def _searched(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(trials of the search over all topologies, training rows with folds, test rows); the trials are fitted once for each
    state of the data: a later call finds their rows."""
    train, test = training_rows(spark, sf_dir)
    folded = sp.fold_column(train)
    key = (source_mark(spark, sf_dir), scratch_root(spark))
    folder = _TRIALS.setdefault(key, scratch_path(spark, "trials"))
    tr.run_trials(spark, folded, mo.SEARCH_HIDDEN, TRAIN_ITERS, folder, "fold", FOLDS)
    return tr.trials(spark, folder, mo.SEARCH_HIDDEN, FOLDS), folded, test


@register("search_trials")
def q_search_trials(spark, sf_dir):
    """M7: the table of trials, a row for each topology and fold: its rows inside and outside the fold."""
    done, _, _ = _searched(spark, sf_dir)
    return done.select("hidden", "fold", "iterations", "train_rows", "held_rows", F.col("f1").between(0, 1).alias("f1_valid"))


@register("search_topology")
def q_search_topology(spark, sf_dir):
    """M7: mean F1 over the folds for each topology with the default iterations; the best one is refitted on all training rows, saved
    and evaluated on the held-out part. One row per topology."""
    done, folded, test = _searched(spark, sf_dir)
    report = tr.search_report(done, mo.SEARCH_HIDDEN).collect()          # one row for each topology
    layers = {h: mo.topology(h) for h in mo.SEARCH_HIDDEN}
    best = next(r.hidden for r in report if r.best)
    res = tr.refit(folded, layers[best], TRAIN_ITERS)
    again = mo.load(spark, mo.save(res.model, mo.model_path(spark, res.layers)))
    held = me.accuracy(me.confusion_counts(mo.predict(again, test))).first()
    kept = sum(r.best for r in report) == 1 and list(mo.mlp_stage(again).getLayers()) == layers[best]
    sizes = {r.fold: r.n for r in folded.groupBy("fold").agg(F.count(F.lit(1)).alias("n")).collect()}   # three rows
    rows = [(r.hidden, "-".join(map(str, layers[r.hidden])), mo.n_weights(layers[r.hidden]), *[sizes.get(k, 0) for k in range(FOLDS)],
             0.0 <= r.avg_f1 <= 1.0, kept, held.n_rows) for r in report]
    return spark.createDataFrame(rows, "hidden STRING, layers STRING, n_weights INT, fold0 BIGINT, fold1 BIGINT, fold2 BIGINT, "
                                       "f1_valid BOOLEAN, best_kept BOOLEAN, held_out_rows BIGINT")


RESUME_CHUNKS = 5


@register("train_resumable")
def q_train_resumable(spark, sf_dir):
    """100 iterations of the 20-20 net in five chunks, stopped after two and started again; beside it an unbroken run. A row for
    each chunk of the log: that both runs have it, and end it with the same loss."""
    train, test = training_rows(spark, sf_dir)
    layers, chunks = mo.topology(TRAIN_HIDDEN), mo.chunk_sizes(TRAIN_ITERS, above=TRAIN_ITERS - 1)
    broken, whole = scratch_path(spark, "training"), scratch_path(spark, "training")
    tr.train_resumable(spark, train, test, layers, chunks, broken, stop_after=2)
    tr.train_resumable(spark, train, test, layers, chunks, broken)
    tr.train_resumable(spark, train, test, layers, chunks, whole)
    a, b = (tr.training_log(spark, f, len(chunks)) for f in (broken, whole))
    other = b.select("chunk", F.col("last_loss").alias("other"))
    alike = F.abs(F.col("last_loss") - F.col("other")) <= 1e-3 * F.abs(F.col("other"))
    return a.join(other, "chunk", "left").select(
        "chunk", "iterations", "test_rows", (F.col("steps") <= F.col("iterations")).alias("within"),
        (F.col("last_loss") <= F.col("first_loss") + 1e-9).alias("not_worse"), F.coalesce(alike, F.lit(False)).alias("as_unbroken"),
        F.col("correct").between(0, F.col("test_rows")).alias("evaluated"))


EARLY_DAYS = 3               # days of readings before the later stations land


@register("retrain_grown")
def q_retrain_grown(spark, sf_dir):
    """M1 + T3: a model of the first days' stations is retrained when all have landed: the index of the warm model, with the old
    stations where they were and the new ones after them."""
    everything = stored_readings(spark, sf_dir, keep_day=True)
    days = sorted(r[0] for r in everything.select("obs_day").distinct().collect())[:EARLY_DAYS]          # one for each calendar day
    early, _ = sp.split_parts(fe.usable(everything.where(F.col("obs_day").isin(days)).drop("obs_day")))
    first = mo.train(mo.materialize(spark, early, "train"), mo.topology(TRAIN_HIDDEN), TRAIN_ITERS)
    res, _ = mo.retrain(spark, everything.drop("obs_day"), TRAIN_HIDDEN, TRAIN_ITERS, warm=first.model)
    known = first.model.index.select("id", F.col("id_index").alias("was"))
    return res.model.index.join(known, "id", "left").select("id", "id_index", F.col("was").isNotNull().alias("known"),
                                                            (F.col("was").isNull() | (F.col("was") == F.col("id_index"))).alias("kept"))


@register("export_predictions")
def q_export_predictions(spark, sf_dir):
    """K3: held-out rows as scored, vectors included, exported as ordered CSV and read back: the prediction is the class of the
    greatest probability, and the vectors are whole."""
    model, test = trained_model(spark, sf_dir)
    # stored: the range bounds of the export's order come from a pass of their own, which would score every row once more
    scored = write_table(sk.csv_ready(mo.predict(model, test)), spark, "tables/scored")
    path = sk.export_ordered(scored, scratch_path(spark, "exports/predictions"))
    back = sk.read_export(spark, path, scored.schema)
    numbers = lambda c: F.transform(F.split(c, ","), lambda x: x.cast("double"))
    p = numbers("probability")
    likeliest = F.get(p, F.col("prediction").cast("int")) == F.array_max(p)
    return back.select("id", "dtUpdate", "name", "label", "id_index", valid_class().alias("valid"), likeliest.alias("likeliest"),
                       F.size(p).alias("n_probabilities"), F.size(numbers("rawPrediction")).alias("n_raw"), F.size(numbers("features")).alias("n_features"))


@register("parse_topology")
def q_parse_topology(spark, sf_dir):
    """C18 on one text for each event: ``5-<k + 1>-<station % 7 + 1>-9``."""
    k = F.get_json_object("props", "$.k").cast("int")
    text = F.concat_ws("-", F.lit("5"), (k + 1).cast("string"), (F.col("user_id") % 7 + 1).cast("string"), F.lit("9"))
    layers = TX.parse_topology(text)
    total = F.aggregate(layers, F.lit(0), lambda a, x: a + x)
    return read_table(spark, sf_dir, "events").select("event_id", F.size(layers).alias("n_layers"), F.get(layers, F.lit(1)).alias("first_hidden"),
                                                      total.alias("n_units"))


@register("parse_weights")
def q_parse_weights(spark, sf_dir):
    """C19 on one text for each event: ``value;k;event_id;``."""
    text = F.concat(F.col("value").cast("string"), F.lit(";"), F.get_json_object("props", "$.k"), F.lit("; "), F.col("event_id").cast("string"), F.lit(";"))
    w = TX.parse_weights(text)
    return read_table(spark, sf_dir, "events").select("event_id", F.size(w).alias("n_weights"), F.get(w, F.lit(0)).alias("w0"),
                                                      F.get(w, F.lit(1)).alias("w1"), F.get(w, F.lit(2)).alias("w2"))


# --- streaming (T1, T2, T4) -------------------------------------------------------------------

LANDED_FILES = 3          # files of a landing: with one file for each micro-batch, a backlog of batches


def _landing(spark, sf_dir, copies: int = 1) -> str:
    """Land the elements ``copies`` times (overlapping snapshots), each time in files by station."""
    root = scratch_path(spark, "landing")
    el = snapshot_elements(spark, sf_dir, nested=True)
    for i in range(copies):
        write_landing(el.repartition(LANDED_FILES, "fields.number"), f"{root}/copy={i}")
    return root


def _streamed(spark, sf_dir, copies: int = 1) -> DataFrame:
    from dockcast.streaming import ingest as st
    w, n = weather_table(spark, sf_dir)
    return st.stream_readings(st.stream_elements(spark, _landing(spark, sf_dir, copies), max_files=1), w, weather_rows=n)


@register("stream_ingest")
def q_stream_ingest(spark, sf_dir):
    """Landing folder -> curated readings -> day-partitioned table, rebalanced per micro-batch,
    one folder per batch (availableNow, several batches)."""
    from dockcast.streaming import ingest as st
    sink = scratch_path(spark, "tables/readings_stream")
    st.ingest_into_table(_streamed(spark, sf_dir), sink, scratch_path(spark, "streams/ingest"))
    return spark.read.parquet(sink).select(*cur.READING_COLUMNS)


COMPACT_TARGET = 64 << 10   # bytes; small, so that the days of small tables need several files too
COMPACT_FILES = 4          # landed files, each a micro-batch, between two compactions


def _compacted(spark, sf_dir) -> tuple[str, StructType]:
    """The stream's table after landings of every second station each, with a compaction after each and a batch after the last."""
    from dockcast.streaming import compaction as cp
    from dockcast.streaming import ingest as st
    w, n = weather_table(spark, sf_dir)
    landing, sink, log = scratch_path(spark, "landing"), scratch_path(spark, "tables/readings_compacted"), scratch_path(spark, "streams/compact")
    elements = snapshot_elements(spark, sf_dir, nested=True).withColumn("_third", F.pmod(F.col("fields.number").cast("long"), F.lit(3)))
    for third in range(3):
        part = elements.where(F.col("_third") == third).drop("_third")
        write_landing(part.repartition(COMPACT_FILES if third < 2 else 1, "fields.number", "fields.last_update"), f"{landing}/part={third}")
        stream = st.stream_readings(st.stream_elements(spark, landing, max_files=1), w, weather_rows=n)
        st.ingest_into_table(stream, sink, log)
        schema = StructType([f for f in stream.schema if f.name != "event_time"])
        if third < 2:
            cp.compact(spark, sink, schema, COMPACT_TARGET)
    return sink, schema


@register("stream_compact")
def q_stream_compact(spark, sf_dir):
    """The table by its newest manifest and the batches after it: the rows of the stream, each once."""
    from dockcast.streaming import compaction as cp
    return cp.read_current(spark, *_compacted(spark, sf_dir)).select(*cur.READING_COLUMNS)


@register("stream_compact_files")
def q_stream_compact_files(spark, sf_dir):
    """The compacted days have at most as many files as their bytes need."""
    from dockcast.streaming import compaction as cp
    report = cp.file_report(spark, _compacted(spark, sf_dir)[0], COMPACT_TARGET)
    return report.select("day", (F.col("n_files") <= F.col("most")).alias("within"))


@register("stream_dedup")
def q_stream_dedup(spark, sf_dir):
    """Every snapshot landed twice, the copies in different micro-batches; the stream keeps one row
    per (id, dtUpdate) (copies combined map-side, the sink table is the dedup state)."""
    from dockcast.streaming import ingest as st
    sink = scratch_path(spark, "tables/readings_dedup")
    st.dedup_into_table(_streamed(spark, sf_dir, copies=2), sink, scratch_path(spark, "streams/dedup"))
    return spark.read.parquet(sink).select(*cur.READING_COLUMNS)


# Landings out of order, by day of the month: the middle of the month comes when its end has been seen, and the last days twice.
OUT_OF_ORDER = [(1, 10), (21, 31), (11, 20), (28, 31)]
READING_DELAY = "2 days"


def _state_dedup(spark, sf_dir) -> tuple[str, str, StructType]:
    """(sink, late table, schema) after landings out of order, each a micro-batch of the first step."""
    from dockcast.streaming import ingest as st
    w, n = weather_table(spark, sf_dir)
    root = scratch_path(spark, "tables/state_dedup")
    landing, sink, late = (f"{root}/{name}" for name in ("landing", "sink", "late"))
    elements = snapshot_elements(spark, sf_dir, nested=True)
    day = F.substring("fields.last_update", 9, 2).cast("int")
    for k, (first, last) in enumerate(OUT_OF_ORDER):
        write_landing(elements.where(day.between(first, last)), f"{landing}/part={k}")
        stream = st.stream_readings(st.stream_elements(spark, landing), w, weather_rows=n)
        st.split_late(stream, f"{root}/on_time", late, f"{root}/marks", f"{root}/log_split", READING_DELAY)
        st.dedup_with_state(spark, f"{root}/on_time", stream.schema, sink, f"{root}/log_state", READING_DELAY)
    return sink, late, stream.schema


@register("stream_dedup_state")
def q_stream_dedup_state(spark, sf_dir):
    """T2 with a state store: files landed out of order; one row per (id, dtUpdate) of those within the watermark."""
    sink, _, _ = _state_dedup(spark, sf_dir)
    return spark.read.parquet(sink).select(*cur.READING_COLUMNS)


@register("stream_late_rows")
def q_stream_late_rows(spark, sf_dir):
    """Rows older than the watermark when they came, counted by the day and the micro-batch they came in."""
    _, late, schema = _state_dedup(spark, sf_dir)
    rows = spark.read.schema(StructType([*schema.fields, *StructType.fromDDL("batch INT").fields])).parquet(late)
    return rows.groupBy("batch", TM.day_text(F.col("obs_day")).alias("day")).agg(F.count(F.lit(1)).alias("n_late"))


# Faults of whole array files, by the last digit of the poll's day.
CUT_SHORT, OTHER_JSON = 3, 6


def _quarantined(spark, sf_dir) -> tuple[str, str]:
    """(readings, dead letters) of a stream over array files of which some are cut short and some hold something else."""
    from dockcast.streaming import ingest as st
    w, n = weather_table(spark, sf_dir)
    root = scratch_path(spark, "tables/quarantine")
    digit = F.substring("poll", 8, 1).cast("int")
    value = (F.when(digit == CUT_SHORT, F.expr("substring(value, 1, length(value) - 9)"))
             .when(digit == OTHER_JSON, F.lit('[{"note": "closed"}]')).otherwise(F.col("value")))
    landing = sn.write_poll_files(poll_files(spark, sf_dir).withColumn("value", value), f"{root}/landing", ["poll", "chunk"])

    def curate(elements: DataFrame) -> DataFrame:
        return cur.readings_from_elements(elements, w, weather_rows=n).select(*cur.READING_COLUMNS, "obs_day")

    files = st.stream_files(spark, landing, sn.TEXT_GLOB, quarantine_files(*input_mark(spark, landing)[0][1:3]))
    st.quarantine_into_tables(files, curate, f"{root}/sink", f"{root}/dead", f"{root}/log")
    return f"{root}/sink", f"{root}/dead"


QUARANTINE_FILES = 12        # files of a micro-batch, at least
QUARANTINE_BATCHES = 5       # micro-batches of a landing, at least (of more than a batch's least files)
QUARANTINE_BYTES = 128 << 20 # bytes of a micro-batch, about, where the least files have fewer


def quarantine_files(total_bytes: int, n_files: int) -> int:
    """Files of a micro-batch over a landing: as many as ``QUARANTINE_BYTES`` hold, so the number of batches, each of which costs its
    own writes and commits, follows the bytes that landed and not the number of small files."""
    by_bytes = n_files * QUARANTINE_BYTES // max(total_bytes, 1)
    return max(QUARANTINE_FILES, min(by_bytes, n_files // QUARANTINE_BATCHES))


@register("stream_quarantine")
def q_stream_quarantine(spark, sf_dir):
    """F5 on S4's array form: the readings of the good files."""
    return spark.read.parquet(_quarantined(spark, sf_dir)[0]).select(*cur.READING_COLUMNS)


@register("stream_dead_letters")
def q_stream_dead_letters(spark, sf_dir):
    """F5 on S4's array form: the bad files, each once, by poll and reason."""
    dead = spark.read.schema("file_path STRING, length BIGINT, reason STRING").parquet(_quarantined(spark, sf_dir)[1])
    poll = F.regexp_extract("file_path", "poll=([0-9]+)", 1)
    return dead.groupBy(poll.alias("poll"), "reason").agg(F.count(F.lit(1)).alias("n_files"), F.countDistinct("file_path").alias("n_names"))


@register("stream_predict")
def q_stream_predict(spark, sf_dir):
    """T4: the saved model scores the landing stream, written as T1 writes (sized files per batch)."""
    from dockcast.streaming import ingest as st
    model, _ = trained_model(spark, sf_dir)
    s = st.score_stream(_streamed(spark, sf_dir), model)
    sink = scratch_path(spark, "tables/predictions_stream")
    st.ingest_into_table(s.select("id", "dtUpdate", "label", "prediction", "obs_day"), sink, scratch_path(spark, "streams/predict"))
    return spark.read.parquet(sink).select("id", "dtUpdate", "label", valid_class().alias("valid"))
