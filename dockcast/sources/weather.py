"""Weather: synop CSV scan (S3), station pick (F4) and the per-day table used by J1."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dockcast.functions.bins import KELVIN_OFFSET, kelvin_to_celsius, warm_flag
from dockcast.functions.text import lenient_number
from dockcast.sources.adapter import WEATHER_STATION

# Positions in a synop file (fixed by the format the service reads): 0 station, 1 date, 7 t (K), 9 u.
SYNOP_POSITIONS = {"numer_sta": 0, "date": 1, "t": 7, "u": 9}


def scan_weather(spark: SparkSession, path: str) -> DataFrame:
    """S3: ``;``-separated files with a header; columns picked by position, all kept as text."""
    raw = (spark.read.option("sep", ";").option("header", True).option("inferSchema", False)
           .option("pathGlobFilter", "*.csv").csv(path))
    cols = raw.columns
    return raw.select(*[F.col(f"`{cols[i]}`").alias(name) for name, i in SYNOP_POSITIONS.items() if i < len(cols)])


# Column names of a synop file up to position 9; 'mq' is the file's missing-value mark.
SYNOP_COLUMNS = ["numer_sta", "date", "pmer", "tend", "cod_tend", "dd", "ff", "t", "td", "u"]
MISSING = "mq"


def write_synop(obs: DataFrame, path: str) -> str:
    """Write observations (numer_sta, date, t[, u]) as synop-like ``;`` files with a header; columns
    the observations do not carry are written as 'mq'. Distributed write, one file per task."""
    have = set(obs.columns)
    cols = [F.col(c).cast("string").alias(c) if c in have else F.lit(MISSING).alias(c) for c in SYNOP_COLUMNS]
    obs.select(*cols).write.mode("errorifexists").option("sep", ";").option("header", True).csv(path)
    return path


def pick_station(obs: DataFrame, station: str = WEATHER_STATION) -> DataFrame:
    """observations of one weather station."""
    return obs.where(F.col("numer_sta") == station)


def daily_weather(obs: DataFrame, station: str = WEATHER_STATION,
                  kelvin_offset: float = KELVIN_OFFSET) -> DataFrame:
    """One row per day: the day's first observation with a temperature (ties: lower t).

    Output ``obs_day`` (DATE), ``temperature`` (C), ``soleil`` (C10). One row per calendar day,
    so the result is bounded by the number of days covered, whatever the input size. The
    aggregation is partial (map-side), so a station with most of the rows does not skew it.
    """
    t = F.col("t") if dict(obs.dtypes).get("t") == "double" else lenient_number("t", "double")
    picked = (pick_station(obs, station)
              .select(F.substring("date", 1, 8).alias("obs_day"), F.col("date").alias("obs_time"), t.alias("t"))
              .where(F.col("t").isNotNull() & (F.length("obs_day") == 8)))
    first = picked.groupBy("obs_day").agg(F.min(F.struct("obs_time", "t")).alias("first"))
    celsius = kelvin_to_celsius(F.col("first.t"), kelvin_offset)
    day = F.concat_ws("-", F.substring("obs_day", 1, 4), F.substring("obs_day", 5, 2), F.substring("obs_day", 7, 2)).try_cast("date")
    return (first.select(day.alias("obs_day"), celsius.alias("temperature"), warm_flag(celsius).alias("soleil"))
            .where(F.col("obs_day").isNotNull()))
