"""Join helpers: broadcast only behind a size check, with the shuffle join beyond it."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Row bounds under which a side is shipped whole to every task.
DIMENSION_MAX_ROWS = 100_000   # nation, daily weather, requests, fitted lookups
STATION_MAX_ROWS = 1_000_000   # one row per station


def bounded_broadcast(df: DataFrame, max_rows: int = DIMENSION_MAX_ROWS, known_rows: int | None = None) -> DataFrame:
    """Return ``broadcast(df)`` when it has at most ``max_rows`` rows, else ``df`` unchanged.

    The check runs ``limit(max_rows + 1).count()``, which stops once the bound is passed. Call it on
    a stored table (a source file or a written dimension): there the count reads parquet metadata
    or a few rows. On a derived plan it would run that plan once more. ``known_rows`` (a count
    recorded when the table was written) skips the check job. Beyond the bound the
    planner keeps its shuffle (sort-merge) join and AQE handles skew.
    """
    n = known_rows if known_rows is not None else df.limit(max_rows + 1).count()
    return F.broadcast(df) if n <= max_rows else df
