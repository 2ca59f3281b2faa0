from clickpulse.functions.timefn import (
    to_micros, interval_str, epoch_micros, micros_to_ts, seconds_to_ts, millis_to_ts,
    as_event_time, local_day, is_ntz,
)
from clickpulse.functions.hashing import salt, bitmap_offset

__all__ = [
    "to_micros", "interval_str", "epoch_micros", "micros_to_ts", "seconds_to_ts",
    "millis_to_ts", "as_event_time", "local_day", "is_ntz", "salt", "bitmap_offset",
]
