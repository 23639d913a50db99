"""Readings: extraction (P1), filters (F1, F2), derived columns (C1-C13), weather (J1), dedup (A1, A2).

Every step is a narrow projection/filter except the final full-row distinct (one shuffle, with a
map-side partial aggregate) and the weather join (broadcast of a per-day table, size checked).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dockcast.functions.bins import class_label, count_bin
from dockcast.functions.text import lenient_count, lenient_number, name_contains, position_part
from dockcast.functions.time import epoch_millis, from_epoch_millis, parse_update_time, time_features
from dockcast.operators.joins import DIMENSION_MAX_ROWS, bounded_broadcast

# Reading columns, by name (the source pinned them by position; alphabetical bean order).
READING_COLUMNS = ["bikes", "day", "dtUpdate", "hour", "id", "label", "lg", "lt", "minute",
                   "nBike", "nPlace", "name", "places", "soleil", "x", "minute_of_week"]
# A2, fixed values: fields of the source's equality (equals/hashCode).
IDENTITY_COLUMNS = ["nBike", "id", "soleil", "minute", "day", "hour", "nPlace"]
# Survivor order among readings of one station: latest time first, then the raw values. Within a
# station, (dtUpdate, bikes, places, name) determine every other column, so this is a total order.
LATEST_ORDER = ["dtUpdate", "bikes", "places", "name"]
OPEN_STATUS = "OPEN"


def typed_fields(fields: DataFrame, *others: str) -> DataFrame:
    """Typed station columns (and ``others`` as they are); ``id`` or ``ts`` is NULL where it
    does not parse, counts that do not parse become 0."""
    as_text = dict(fields.dtypes)["position"] == "string"
    return fields.select(
        *others,
        lenient_number("number", "bigint").alias("id"),
        F.col("name"),
        parse_update_time("last_update").alias("ts"),
        lenient_count("available_bike_stands").alias("places"),
        lenient_count("available_bikes").alias("bikes"),
        position_part("position", 0, as_text).alias("lt"),
        position_part("position", 1, as_text).alias("lg"),
    )


def open_elements(elements: DataFrame) -> DataFrame:
    """P1 + F1: ``fields.*`` of elements whose status is exactly OPEN (no fields / no status drop).
    Elements already flattened (no ``fields`` column) are taken as they are."""
    flat = elements.select("fields.*") if "fields" in elements.columns else elements
    return flat.where(F.col("status") == OPEN_STATUS)


def filter_name(df: DataFrame, part: str | None) -> DataFrame:
    """case-insensitive name-contains; ``None`` keeps every row."""
    return df if part is None else df.where(name_contains("name", part, ignore_case=True))


def parse_fields(fields: DataFrame) -> DataFrame:
    """Typed open elements; those whose id or update time does not parse are rejected (the source
    aborted the whole load on them). ``dropped_counts`` counts them."""
    return typed_fields(fields).where(F.col("id").isNotNull() & F.col("ts").isNotNull())


def dropped_counts(elements: DataFrame, weather_daily: DataFrame) -> DataFrame:
    """What a load leaves out, and why (Q13): (rule, n) for elements that are not open, open ones
    without a valid id, with an id but no valid time, those kept without weather (left out of the
    features), and those kept with it. One pass, combined map-side."""
    flat = elements.select("fields.*") if "fields" in elements.columns else elements
    status = flat.select("*", F.coalesce(F.col("status") == OPEN_STATUS, F.lit(False)).alias("is_open"))
    typed = typed_fields(status, "is_open")
    days = weather_daily.select(F.col("obs_day").alias("weather_day"), "soleil")
    judged = typed.join(days, F.to_date("ts") == F.col("weather_day"), "left")
    rule = (F.when(~F.col("is_open"), "not_open").when(F.col("id").isNull(), "bad_id").when(F.col("ts").isNull(), "bad_time")
            .when(F.col("soleil").isNull(), "no_weather").otherwise("complete"))
    return judged.groupBy(rule.alias("rule")).agg(F.count(F.lit(1)).alias("n"))


def derive(typed: DataFrame) -> DataFrame:
    """Epoch ms, calendar features, bins and label, plus the weather join key ``obs_day``."""
    n_place, n_bike = count_bin("places"), count_bin("bikes")
    return typed.select(
        "id", "name", "places", "bikes", "lt", "lg",
        epoch_millis("ts").alias("dtUpdate"),
        *time_features("ts"),
        n_place.alias("nPlace"), n_bike.alias("nBike"), class_label(n_bike, n_place).alias("label"),
        F.to_date("ts").alias("obs_day"),
    )


def attach_weather(readings: DataFrame, weather_daily: DataFrame | None, weather_rows: int | None = None) -> DataFrame:
    """J1 + C10: left join on the day; ``soleil`` is NULL for a day without observation.

    The per-day table is broadcast only after its size is checked; otherwise it is a shuffle join.
    """
    if weather_daily is None:
        return readings.withColumn("soleil", F.lit(None).cast("double"))
    w = bounded_broadcast(weather_daily.select("obs_day", "soleil"), DIMENSION_MAX_ROWS, weather_rows)
    return readings.join(w, "obs_day", "left")


def readings_from_elements(elements: DataFrame, weather_daily: DataFrame | None,
                           name_filter: str | None = None, weather_rows: int | None = None) -> DataFrame:
    """P1 -> F1 -> C12/C13/C1 -> F2 -> C2..C9 -> J1, before dedup (keeps ``obs_day``)."""
    typed = filter_name(parse_fields(open_elements(elements)), name_filter)
    return attach_weather(derive(typed), weather_daily, weather_rows)


def curate(elements: DataFrame, weather_daily: DataFrame | None, name_filter: str | None = None,
           keep_day: bool = False, weather_rows: int | None = None) -> DataFrame:
    """Readings table: the pipeline above, then A1 (full-row distinct, Q10: always deduplicated)."""
    cols = READING_COLUMNS + (["obs_day"] if keep_day else [])
    return readings_from_elements(elements, weather_daily, name_filter, weather_rows).select(*cols).distinct()


def curate_by_day(elements: DataFrame, weather_daily: DataFrame | None, name_filter: str | None = None,
                  weather_rows: int | None = None) -> DataFrame:
    """The readings table with its day column, laid out for a day-partitioned write.

    Two exchanges, each skew-proof: the distinct (its partial aggregate collapses copies inside
    every map task, so a group of copies holding a third of the rows never reaches one task whole)
    and the REBALANCE on the day (AQE splits a hot day, merges small ones)."""
    from dockcast.operators.sinks import rebalance_by_day
    return rebalance_by_day(curate(elements, weather_daily, name_filter, keep_day=True, weather_rows=weather_rows))


def distinct_readings(readings: DataFrame) -> DataFrame:
    """A1: full-row distinct. Partial aggregation removes copies before the shuffle, and a hot
    station is spread over many hash partitions because the key is the whole row."""
    return readings.distinct()


def dedup_identity(readings: DataFrame) -> DataFrame:
    """A2: one reading per identity key (nBike, id, soleil, minute, day, hour, nPlace).

    Survivor: the latest ``dtUpdate``; ties broken by the rest of the row (total order, so the
    result is deterministic). Done as a ``max`` over a struct, which aggregates map-side: a key
    holding a third of all rows is reduced in every task before the shuffle instead of being sorted
    in one task as a window would be.
    """
    rest = [c for c in readings.columns if c not in IDENTITY_COLUMNS]
    order_first = LATEST_ORDER + [c for c in rest if c not in LATEST_ORDER]
    best = readings.groupBy(*IDENTITY_COLUMNS).agg(F.max(F.struct(*order_first)).alias("r"))
    return best.select(*IDENTITY_COLUMNS, *[F.col(f"r.{c}").alias(c) for c in order_first]) \
               .select(*readings.columns)


def reading_count(readings: DataFrame) -> DataFrame:
    """A3: dataset size as a one-row DataFrame."""
    return readings.agg(F.count(F.lit(1)).alias("n_readings"))


def drop_columns(readings: DataFrame, cols: list[str]) -> DataFrame:
    """Drop by name; Catalyst prunes the dropped columns from the scan."""
    return readings.drop(*cols)


def append_readings(base: DataFrame, more: DataFrame, days: list | None = None, day_col: str = "obs_day") -> DataFrame:
    """S5 + U1: union by name, nothing lost (Q5), then A1 as every load does (Q10).

    ``base`` is distinct already. With ``days``, the days that ``more`` may hold (a poll's folder names
    say so), only those days of ``base`` meet it in the distinct; on a day-partitioned table the others
    pass through without a shuffle, and each side scans its own folders."""
    more = more.select(*base.columns)
    if days is None:
        return base.unionByName(more).distinct()
    touched = F.col(day_col).isin([F.lit(d).cast("date") for d in days])
    return base.where(~touched).unionByName(base.where(touched).unionByName(more.where(touched)).distinct())


def backfill_weather(readings: DataFrame, weather_daily: DataFrame, weather_rows: int | None = None) -> DataFrame:
    """Readings taken before their day's weather landed get it now; those that have it keep it. Run it
    over the days whose weather is new (a partition filter), then write those days anew."""
    days = bounded_broadcast(weather_daily.select(F.col("obs_day").alias("weather_day"), F.col("soleil").alias("landed")),
                             DIMENSION_MAX_ROWS, weather_rows)
    filled = readings.join(days, F.to_date(from_epoch_millis("dtUpdate")) == F.col("weather_day"), "left")
    return filled.withColumn("soleil", F.coalesce("soleil", "landed")).select(*readings.columns)
