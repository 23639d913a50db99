"""Calendar and time column functions (built-in expressions only, time-zone independent).

Times are wall-clock values: the snapshot string's offset is dropped, as in the source service.
They are held as TIMESTAMP_NTZ so results do not depend on the session time zone.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values that must match the source service.
UPDATE_TIME_SHAPE = r"^\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}$"   # snapshot `last_update`, offset ignored
DAY_FORMAT = "yyyyMMdd"                        # weather file date
SHORT_FORMAT = "dd/MM HH:mm"                   # listing text
BUCKET_MINUTES = 5                             # poll period and minute bucket


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def parse_update_time(s) -> Column:
    """Text -> TIMESTAMP_NTZ of the first 19 characters; NULL when unparsable. The shape is checked
    first (a cast takes more shapes than the service's format), then the text is parsed once."""
    head = F.substring(_c(s), 1, 19)
    return F.when(F.rlike(head, F.lit(UPDATE_TIME_SHAPE)), head.try_cast("timestamp_ntz"))


def epoch_millis(ts) -> Column:
    """Epoch milliseconds of a wall-clock time read as UTC.

    Built from the value's own date and clock fields: ``timestamp_diff`` and ``date_format`` cast
    TIMESTAMP_NTZ to the session zone first, which shifts results across daylight-saving changes.
    """
    t = _c(ts)
    return (F.unix_date(F.to_date(t)).cast("bigint") * 86_400_000 + F.hour(t) * 3_600_000 + F.minute(t) * 60_000
            + F.floor(F.extract(F.lit("SECOND"), t) * 1000).cast("bigint"))


def day_of_week(ts) -> Column:
    """0 = Sunday ... 6 = Saturday."""
    return (F.dayofweek(_c(ts)) - 1).cast("int")


def hour_of_day(ts) -> Column:
    """C4."""
    return F.hour(_c(ts)).cast("int")


def minute_bucket(minute) -> Column:
    """Minute floored to the 5-minute poll bucket (integer division in the source)."""
    m = _c(minute)
    return (m - m % BUCKET_MINUTES).cast("int")


def ordering_key(day, hour, minute) -> Column:
    """The source's ordering key ``day*24 + hour*60 + minute`` (kept for parity; not unique)."""
    return (_c(day) * 24 + _c(hour) * 60 + _c(minute)).cast("int")


def minute_of_week(day, hour, minute) -> Column:
    """Monotone replacement for C6: ``day*1440 + hour*60 + minute``."""
    return (_c(day) * 1440 + _c(hour) * 60 + _c(minute)).cast("int")


def shift_minutes(ts, minutes) -> Column:
    """C20: ts + n minutes."""
    return _c(ts) + F.make_dt_interval(mins=_c(minutes).cast("bigint"))


def on_poll_minute(ts) -> Column:
    """The poll runs when the clock's minute ends in 0 or 5."""
    return (F.minute(_c(ts)) % BUCKET_MINUTES) == 0


def day_text(ts) -> Column:
    """C17: ``yyyyMMdd`` (formatted from the wall-clock fields, zone-free)."""
    t = _c(ts)
    return F.format_string("%04d%02d%02d", F.year(t), F.month(t), F.dayofmonth(t))


def short_text(ts) -> Column:
    """C17: ``dd/MM HH:mm``."""
    t = _c(ts)
    return F.format_string("%02d/%02d %02d:%02d", F.dayofmonth(t), F.month(t), F.hour(t), F.minute(t))


def iso_text(ts) -> Column:
    """``yyyy-MM-dd'T'HH:mm:ss`` (the snapshot's time text without offset)."""
    t = _c(ts)
    return F.format_string("%04d-%02d-%02dT%02d:%02d:%02d", F.year(t), F.month(t), F.dayofmonth(t),
                           F.hour(t), F.minute(t), F.second(t))


def stamp_text(ts) -> Column:
    """``yyyyMMddHHmmss`` (synop observation time)."""
    t = _c(ts)
    return F.format_string("%04d%02d%02d%02d%02d%02d", F.year(t), F.month(t), F.dayofmonth(t),
                           F.hour(t), F.minute(t), F.second(t))


def time_features(ts) -> list[Column]:
    """C3-C6 plus minute_of_week, as named columns."""
    day, hour, minute = day_of_week(ts), hour_of_day(ts), minute_bucket(F.minute(_c(ts)))
    return [day.alias("day"), hour.alias("hour"), minute.alias("minute"),
            ordering_key(day, hour, minute).alias("x"),
            minute_of_week(day, hour, minute).alias("minute_of_week")]


def from_epoch_millis(ms) -> Column:
    """Inverse of C2: epoch milliseconds -> wall-clock TIMESTAMP_NTZ (no session time zone)."""
    return F.timestamp_add("MILLISECOND", _c(ms), F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"))
