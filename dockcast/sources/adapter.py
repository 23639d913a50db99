"""Stand-in inputs built from the driver's tables (the service's own inputs are not shipped).

* ``snapshot_elements``: events + nation -> one snapshot element per event, in the JSON shape the
  service reads (``fields`` struct, numbers as text, ``last_update`` as text with an offset);
  ``poll_files`` and ``faulty_lines`` are the same as text of snapshot files, whole and with faults.
* ``weather_observations``: events -> synop-like observations (station, time, kelvin).
* ``forecast_requests``: customer -> requests by station text.

All but ``poll_files`` (one group for each file) are projections of a scan and a join with the
25-row nation table, so they stream at scan speed and partition like the events table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from dockcast.functions.time import day_text, iso_text, stamp_text
from dockcast.sources.tables import read_table

# Fixed values of the stand-in (the weather station id is the one the service reads).
N_NATIONS = 25
COUNT_MOD = 20            # bikes and places are taken modulo 20
WEATHER_STATION = "07190"
WEATHER_BASE_K = 268.15   # kelvin = 268.15 + value % 30  ->  -5 .. 25 C
WEATHER_SPAN = 30
NO_WEATHER_DAY_MOD = 10   # days of month ending in 7 carry no observation of the station
NO_WEATHER_DAY_REM = 7


def snapshot_elements(spark: SparkSession, sf_dir: str, nested: bool = False) -> DataFrame:
    """events + nation -> one snapshot element per event.

    Flat element columns by default, so Catalyst prunes the scan to what a query uses (a struct
    built in a projection keeps every member alive); ``nested=True`` wraps them in ``fields`` as in
    the JSON files (used when writing landing files)."""
    joined = _events_with_nation(spark, sf_dir)
    cols = _element_columns()
    return joined.select(F.struct(*cols).alias("fields")) if nested else joined.select(*cols)


def _events_with_nation(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = read_table(spark, sf_dir, "events").select("event_id", "user_id", "ts", "event_type", "value", "props")
    nation = read_table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    return ev.join(nation, F.col("n_nationkey") == (F.col("user_id") % N_NATIONS))   # AQE broadcasts by measured size


def _element_columns() -> list[Column]:
    bikes = F.floor("value").cast("int") % COUNT_MOD
    places = F.get_json_object("props", "$.k").cast("int") % COUNT_MOD
    lt = (F.lit(48800) + F.col("user_id") % 100).cast("double") / F.lit(1000.0)
    lg = (F.lit(2300) + F.col("n_nationkey")).cast("double") / F.lit(1000.0)
    return [
        F.col("user_id").cast("string").alias("number"),
        F.concat(F.col("user_id").cast("string"), F.lit(" - "), F.col("n_name")).alias("name"),
        F.concat(iso_text("ts"), F.lit("+00:00")).alias("last_update"),
        places.cast("string").alias("available_bike_stands"),
        bikes.cast("string").alias("available_bikes"),
        F.array(lt, lg).alias("position"),
        F.when(F.col("event_type") == "error", F.lit("CLOSED")).otherwise(F.lit("OPEN")).alias("status"),
    ]


POLL_STATIONS = 1000      # stations of a snapshot file


def poll_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """events + nation -> (poll, chunk, value): the text of snapshot files in the service's own form,
    one JSON array for each day and each thousand stations. A station has a few elements a day, so a
    file stays small however many events there are."""
    rows = _events_with_nation(spark, sf_dir).select(
        day_text("ts").alias("poll"), F.floor(F.col("user_id") / POLL_STATIONS).alias("chunk"),
        F.to_json(F.struct(F.struct(*_element_columns()).alias("fields"))).alias("element"))
    files = rows.groupBy("poll", "chunk").agg(F.array_join(F.collect_list("element"), ",").alias("elements"))
    return files.select("poll", "chunk", F.concat(F.lit("["), F.col("elements"), F.lit("]")).alias("value"))


# Faults of the stand-in: of 50 events in a row, which has what.
FAULT_CYCLE = 50
FAULTS = {"truncated": 1, "text_position": 2, "no_position": 3, "junk_position": 4, "junk_id": 5, "junk_time": 6}


def faulty_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """events + nation -> (poll, value): line-delimited elements, some with faults (``FAULTS``)."""
    has = lambda fault: F.col("event_id") % FAULT_CYCLE == FAULTS[fault]
    number, name, last_update, stands, bikes, position, status = _element_columns()
    text = lambda i: F.concat(F.lit('"'), F.get(position, i).cast("string"), F.lit('"'))
    plain = F.to_json(position)
    places = (F.when(has("text_position"), F.concat(F.lit("["), text(0), F.lit(","), text(1), F.lit("]")))
              .when(has("no_position"), F.lit("null")).when(has("junk_position"), F.lit('{"at":"here"}')).otherwise(plain))
    fields = F.concat(
        F.lit('{"fields":{"number":"'), F.when(has("junk_id"), F.lit("none")).otherwise(number), F.lit('","name":"'), name,
        F.lit('","last_update":"'), F.when(has("junk_time"), F.lit("yesterday")).otherwise(last_update),
        F.lit('","available_bike_stands":'), stands, F.lit(',"available_bikes":'), bikes, F.lit(',"position":'), places,
        F.lit(',"status":"'), status, F.lit('"}}'))
    value = F.when(has("truncated"), F.substring(fields, 1, 30)).otherwise(fields)
    return _events_with_nation(spark, sf_dir).select(day_text("ts").alias("poll"), value.alias("value"))


# Drift of the stand-in, by day of the month: a field that comes, one whose values become text for a while, one that goes.
NEW_FIELD_FROM, TEXT_BIKES, NAME_UNTIL = 11, (16, 20), 24


def drifting_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """events + nation -> (poll, chunk, value): array files as ``poll_files``, whose fields change from day to day."""
    number, name, last_update, stands, bikes, position, status = _element_columns()
    day = F.dayofmonth("ts")
    quoted = lambda c: F.concat(F.lit('"'), c, F.lit('"'))
    element = F.concat(
        F.lit('{"fields":{"number":'), quoted(number), F.when(day <= NAME_UNTIL, F.concat(F.lit(',"name":'), quoted(name))).otherwise(""),
        F.lit(',"available_bikes":'), F.when(day.between(*TEXT_BIKES), quoted(bikes)).otherwise(bikes),
        F.lit(',"position":'), F.to_json(position), F.when(day >= NEW_FIELD_FROM, F.lit(',"banking":true')).otherwise(""), F.lit("}}"))
    rows = _events_with_nation(spark, sf_dir).select(day_text("ts").alias("poll"), F.floor(F.col("user_id") / POLL_STATIONS).alias("chunk"), element.alias("element"))
    files = rows.groupBy("poll", "chunk").agg(F.array_join(F.collect_list("element"), ",").alias("elements"))
    return files.select("poll", "chunk", F.concat(F.lit("["), F.col("elements"), F.lit("]")).alias("value"))


def weather_observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """events -> (numer_sta, date 'yyyyMMddHHmmss', t kelvin), like rows of a synop file."""
    ev = read_table(spark, sf_dir, "events").select("user_id", "ts", "value")
    ours = ((F.col("user_id") % 3) == 0) & ((F.dayofmonth("ts") % NO_WEATHER_DAY_MOD) != NO_WEATHER_DAY_REM)
    sta = F.when(ours, F.lit(WEATHER_STATION)).otherwise(
        F.lpad((F.col("user_id") % 1000).cast("string"), 5, "0"))
    return ev.select(sta.alias("numer_sta"),
                     stamp_text("ts").alias("date"),
                     (F.lit(WEATHER_BASE_K) + F.col("value") % WEATHER_SPAN).alias("t"))


# Forecast requests: one for each customer; the station text is a part of a station's name and may
# match several ("17 - NATION_" hits "17 - NATION_17" and "117 - NATION_17").
REQUEST_STATIONS = 200
REQUEST_NOW = "2024-01-31 08:00:00"


def forecast_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """customer -> requests (req_id, station, req_day, req_hour, req_minute, req_soleil, delay, now_ts)."""
    k = F.col("c_custkey")
    return read_table(spark, sf_dir, "customer").select(
        k.cast("bigint").alias("req_id"),
        F.concat((k % REQUEST_STATIONS).cast("string"), F.lit(" - NATION_")).alias("station"),
        (k % 7).cast("int").alias("req_day"),
        ((k * 5) % 24).cast("int").alias("req_hour"),
        ((k * 7) % 60).cast("int").alias("req_minute"),
        (k % 2).cast("double").alias("req_soleil"),
        (k * 37 % 20160).cast("bigint").alias("delay"),      # up to two weeks
        F.lit(REQUEST_NOW).cast("timestamp_ntz").alias("now_ts"),
    )
