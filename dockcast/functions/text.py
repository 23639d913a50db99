"""Lenient number parsing, array access, name matching and list parsing."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def lenient_number(s, to: str = "int") -> Column:
    """Numeric text -> number, truncating a fraction; NULL when it is not a number."""
    t = F.trim(_c(s).cast("string"))
    return F.coalesce(t.try_cast(to), t.try_cast("double").try_cast(to))


def lenient_count(s) -> Column:
    """C12 for counts: junk, NULL or missing -> 0, as the source's JSON accessors do."""
    return F.coalesce(lenient_number(s, "int"), F.lit(0))


def position_part(position, i: int, as_text: bool = False) -> Column:
    """Element i (0-based) of the position; NULL when absent or no number. ``as_text``: the position
    is JSON text of an array of numbers or numeric texts, as snapshot scans give it
    (``get_json_object`` gives NULL for text that is no JSON)."""
    part = F.get_json_object(_c(position), f"$[{i}]") if as_text else F.get(_c(position), i)
    return lenient_number(part, "double")


def name_contains(name, part: str, ignore_case: bool = True) -> Column:
    """Substring test on the station name."""
    n = _c(name)
    if ignore_case:
        return F.contains(F.lower(n), F.lower(F.lit(part)))
    return F.contains(n, F.lit(part))


def parse_topology(s) -> Column:
    """``5-20-20-9`` -> array<int>."""
    return F.transform(F.split(_c(s), "-"), lambda x: x.cast("int"))


def parse_weights(s) -> Column:
    """``w0;w1;...;`` -> array<double> (the trailing separator gives no element)."""
    parts = F.filter(F.split(_c(s), ";"), lambda x: F.length(F.trim(x)) > 0)
    return F.transform(parts, lambda x: F.trim(x).cast("double"))


def topology_list(text: str) -> list[int]:
    """C18 for a parameter on the driver (a model setting, not data)."""
    return [int(p) for p in text.strip().split("-") if p.strip()]
