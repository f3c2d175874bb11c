"""Time parsing, zone conversion and calendar features.

Convention: every timestamp this library produces is ``TIMESTAMP_NTZ``.
Instants are stored as UTC wall time; local (New York) wall time is only
derived for calendar features and display.  Nothing depends on the session
time zone, so results are identical on every cluster and in DuckDB.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import settings as S

EPOCH_NTZ = "1970-01-01 00:00:00"

_BRONZE_RE = r"^\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}\.\d{3}$"
_FEED_RE = r"^(\d{2})/(\d{2})/(\d{4}) (\d{2}):(\d{2}):(\d{2})$"
_ISO_RE = r"^(\d{4}-\d{2}-\d{2}[T ]\d{2}:\d{2}:\d{2}(?:\.\d{1,6})?)(Z|[+-]\d{2}:\d{2})?$"


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def epoch_ntz() -> Column:
    return F.lit(EPOCH_NTZ).cast("timestamp_ntz")


def parse_utc_ts(col) -> Column:
    """``yyyy-MM-dd'T'HH:mm:ss.SSS`` text -> NTZ; malformed -> null."""
    c = _c(col)
    return F.when(c.rlike(_BRONZE_RE), c.try_cast("timestamp_ntz"))


def utc_to_local(col, zone: str = S.LOCAL_ZONE) -> Column:
    """UTC wall time -> local wall time (both NTZ)."""
    return F.convert_timezone(F.lit("UTC"), F.lit(zone), _c(col))


def local_to_utc(col, zone: str = S.LOCAL_ZONE) -> Column:
    return F.convert_timezone(F.lit(zone), F.lit("UTC"), _c(col))


def parse_local_ts(col, zone: str = S.LOCAL_ZONE) -> Column:
    """``MM/dd/yyyy HH:mm:ss`` local text -> UTC instant (NTZ); bad -> null."""
    c = _c(col)
    iso = F.regexp_replace(c, _FEED_RE, "$3-$1-$2 $4:$5:$6")
    local = F.when(c.rlike(_FEED_RE), iso.try_cast("timestamp_ntz"))
    return local_to_utc(local, zone)


def parse_iso_instant(col, zone: str = S.LOCAL_ZONE) -> Column:
    """ISO-8601 text with optional offset -> UTC instant (NTZ).

    A missing offset means local time in ``zone``; ``Z`` means UTC.
    """
    c = _c(col)
    parts = F.struct(F.regexp_extract(c, _ISO_RE, 1).alias("wall"), F.regexp_extract(c, _ISO_RE, 2).alias("offset"))
    # the parts are found once; named as columns, each branch would search the text again
    return F.transform(F.array(parts), lambda p: _instant_of(p["wall"], p["offset"], zone))[0]


def _instant_of(wall: Column, off: Column, zone: str) -> Column:
    local = F.when(wall != "", F.translate(wall, "T", " ").try_cast("timestamp_ntz"))
    sign = F.when(F.substring(off, 1, 1) == "-", F.lit(-1)).otherwise(F.lit(1))
    off_min = sign * (F.substring(off, 2, 2).try_cast("int") * 60 + F.substring(off, 5, 2).try_cast("int"))
    return (
        F.when(off == "", local_to_utc(local, zone))
        .when(off == "Z", local)
        .otherwise(F.timestamp_add("MINUTE", -off_min, local))
    )


def iso_local_text(col, zone: str = S.LOCAL_ZONE) -> Column:
    """UTC instant -> ISO-8601 local text with numeric offset, e.g. ``...-05:00``."""
    c = _c(col)
    local = utc_to_local(c, zone)
    off_min = F.timestamp_diff("MINUTE", c, local)
    sign = F.when(off_min < 0, F.lit("-")).otherwise(F.lit("+"))
    a = F.abs(off_min)
    hh = F.lpad((a / 60).cast("int").cast("string"), 2, "0")
    mm = F.lpad((a % 60).cast("string"), 2, "0")
    frac = F.when(F.pmod(epoch_micros(c), F.lit(1_000_000)) != 0,
                  F.date_format(local, ".SSSSSS")).otherwise(F.lit(""))
    return F.concat(F.date_format(local, "yyyy-MM-dd'T'HH:mm:ss"), frac, sign, hh, F.lit(":"), mm)


def epoch_micros(col) -> Column:
    """NTZ -> microseconds since 1970-01-01 (exact, zone free)."""
    return F.timestamp_diff("MICROSECOND", epoch_ntz(), _c(col))


def epoch_seconds(col) -> Column:
    """NTZ -> whole seconds (floored, like a timestamp-to-long cast)."""
    return F.floor(epoch_micros(col) / F.lit(1_000_000)).cast("long")


def minutes_between(later, earlier) -> Column:
    """Minutes between two times after flooring both to whole seconds."""
    return (epoch_seconds(later) - epoch_seconds(earlier)) / F.lit(60.0)


def day_of_week(col) -> Column:
    """1 = Sunday ... 7 = Saturday."""
    return F.dayofweek(_c(col))


def is_weekend(dow_col) -> Column:
    """F5."""
    return F.when(_c(dow_col).isin(1, 7), F.lit(1)).otherwise(F.lit(0)).cast("int")


def calendar_features(local_col) -> list[Column]:
    """hour, day_of_week, month, is_weekend from local wall time."""
    c = _c(local_col)
    return [
        F.hour(c).cast("int").alias("hour"),
        day_of_week(c).cast("int").alias("day_of_week"),
        F.month(c).cast("int").alias("month"),
        is_weekend(day_of_week(c)).alias("is_weekend"),
    ]


def local_date_str(col) -> Column:
    """``yyyy-MM-dd`` of a (local) NTZ time."""
    return F.date_format(_c(col), S.DATE_FORMAT)


def local_hour_str(col) -> Column:
    """``HH`` of a (local) NTZ time."""
    return F.date_format(_c(col), S.HOUR_FORMAT)


def plus_minutes(col, minutes: float) -> Column:
    """F17 (target_time) and friends: NTZ + minutes."""
    return F.timestamp_add("SECOND", F.lit(int(round(minutes * 60))), _c(col))
