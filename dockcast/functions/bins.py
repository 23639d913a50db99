"""Availability bins, label, weather flag, clamp and label text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values that must match the source service.
LOW_MAX = 3            # 0..3   -> bin 0
MID_MAX = 9            # 4..9   -> bin 1, 10 and more -> bin 2
N_BINS = 3             # label = nBike * 3 + nPlace, classes 0..8
N_CLASSES = 9
WARM_CELSIUS = 15.0    # temperature < 15 -> soleil 0, else 1
CLAMP_ABOVE = 9.0      # setter clamp: value > 9 -> 10
CLAMP_TO = 10.0
KELVIN_OFFSET = 273.15  # the source used 270; 273.15 is the physical offset (parameter)

# Words for the label text, per bin (all nine classes are described).
BIN_TEXT = ["0-3", "4-9", "10+"]


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def count_bin(v) -> Column:
    """<=3 -> 0.0, 4..9 -> 1.0, >=10 -> 2.0 (NULL stays NULL)."""
    v = _c(v)
    return (F.when(v > MID_MAX, F.lit(2.0))
             .when(v > LOW_MAX, F.lit(1.0))
             .when(v.isNotNull(), F.lit(0.0)))


def class_label(n_bike, n_place) -> Column:
    """label = nBike * 3 + nPlace (0..8)."""
    return (_c(n_bike) * N_BINS + _c(n_place)).cast("double")


def warm_flag(celsius) -> Column:
    """0.0 when colder than 15 C, 1.0 otherwise, NULL without a temperature."""
    t = _c(celsius)
    return F.when(t < WARM_CELSIUS, F.lit(0.0)).when(t >= WARM_CELSIUS, F.lit(1.0))


def kelvin_to_celsius(kelvin, offset: float = KELVIN_OFFSET) -> Column:
    """C11."""
    return _c(kelvin) - F.lit(float(offset))


def clamp(v) -> Column:
    """Values above 9 become 10."""
    v = _c(v).cast("double")
    return F.when(v > CLAMP_ABOVE, F.lit(CLAMP_TO)).otherwise(v)


def label_text(label) -> Column:
    """C14: describe a class 0..8 by its two bins, e.g. ``bikes 4-9, places 10+``."""
    lab = _c(label).cast("int")
    words = F.array(*[F.lit(w) for w in BIN_TEXT])
    bike = F.element_at(words, (F.floor(lab / N_BINS) + 1).cast("int"))
    place = F.element_at(words, (lab % N_BINS + 1).cast("int"))
    ok = lab.between(0, N_CLASSES - 1)
    return F.when(ok, F.concat(F.lit("bikes "), bike, F.lit(", places "), place))
