"""Column functions: built-in Spark expressions only (no UDFs)."""

from dockcast.functions.bins import (class_label, clamp, count_bin, kelvin_to_celsius, label_text,  # noqa: F401
                                     warm_flag)
from dockcast.functions.text import (lenient_count, lenient_number, name_contains, parse_topology,  # noqa: F401
                                     parse_weights, position_part, topology_list)
from dockcast.functions.time import (day_of_week, day_text, epoch_millis, hour_of_day, minute_bucket,  # noqa: F401
                                     minute_of_week, on_poll_minute, ordering_key, parse_update_time,
                                     shift_minutes, short_text, time_features, from_epoch_millis,
                                     iso_text, stamp_text)
