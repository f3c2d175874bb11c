"""Column-level functions: built-in Spark expressions only, no Python UDFs."""

from .congestion import (class_label, congestion_class, congestion_trend, holiday_flag,
                         round_value, speed_ratio, speed_ratio_trend)
from .text import (clean_quotes, confidence, json_decode_snapshot, json_encode_snapshot,
                   name_fallback, parse_first_point, struct_field)
from .timefn import (calendar_features, day_of_week, epoch_micros, epoch_seconds, is_weekend,
                     local_date_str, local_hour_str, local_to_utc, minutes_between,
                     parse_iso_instant, parse_local_ts, parse_utc_ts, plus_minutes, utc_to_local)

__all__ = [n for n in dir() if not n.startswith("_")]
