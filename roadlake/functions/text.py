"""Text, JSON and array helpers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import settings as S
from .timefn import iso_local_text, parse_iso_instant

_NUM_RE = r"(?i)^[+-]?((\d+(\.\d*)?|\.\d+)(e[+-]?\d+)?|nan|inf|infinity)$"


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def clean_quotes(col) -> Column:
    """trim blanks, then surrounding double quotes."""
    return F.btrim(F.btrim(_c(col)), F.lit('"'))


def _strict_double(text: Column) -> Column:
    # decimal, exponent, nan or inf only: Java-only forms such as "1d" or hex stay null
    t = F.trim(text)
    return F.when(t.rlike(_NUM_RE), t.try_cast("double"))


def parse_first_point(col) -> Column:
    """first ``lat,lon`` of a blank-separated point list -> struct(lat, lon).

    Both fields are null unless the first token has exactly two numeric parts.
    """
    first = F.split(F.trim(_c(col)), " ").getItem(0)
    parts = F.split(first, ",")
    lat = _strict_double(parts.getItem(0))
    lon = _strict_double(parts.getItem(1))
    ok = (F.size(parts) == 2) & lat.isNotNull() & lon.isNotNull()
    return F.struct(
        F.when(ok, lat).cast("double").alias("lat"),
        F.when(ok, lon).cast("double").alias("lon"),
    )


def name_fallback(primary, fallback) -> Column:
    """the message's name unless null or empty, else the lookup's."""
    return F.coalesce(F.nullif(_c(primary), F.lit("")), _c(fallback))


#: Names a published row: the same when its batch is published again.
MESSAGE_ID = "message_id"

SNAPSHOT_VALUE_SCHEMA = T.StructType([
    T.StructField("data_as_of", T.StringType()),
    T.StructField("current_congestion", T.IntegerType()),
    T.StructField("speed_ratio", T.DoubleType()),
    T.StructField("link_name", T.StringType()),
])


def json_encode_snapshot(data_as_of="data_as_of", current="current_congestion",
                         ratio="speed_ratio", name="link_name",
                         zone: str = S.LOCAL_ZONE, message_id=None) -> Column:
    """snapshot fields -> JSON text; time as ISO-8601 local with offset; ``message_id``, if given, as one more field."""
    return F.to_json(F.struct(
        iso_local_text(_c(data_as_of), zone).alias("data_as_of"),
        _c(current).cast("int").alias("current_congestion"),
        _c(ratio).cast("double").alias("speed_ratio"),
        _c(name).alias("link_name"),
        *([] if message_id is None else [_c(message_id).cast("string").alias(MESSAGE_ID)]),
    ))


def json_decode_snapshot(col, zone: str = S.LOCAL_ZONE) -> Column:
    """F16: JSON text -> struct with ``data_as_of`` as a UTC instant (NTZ).

    Invalid JSON gives null fields (the row is dropped by the message decoder);
    a time without offset is local time.
    """
    parsed = snapshot_value(col)
    return F.when(parsed.isNotNull(), snapshot_struct(parsed, zone))


def snapshot_value(col) -> Column:
    """JSON text of a snapshot -> its fields as they stand there."""
    return F.from_json(_c(col), SNAPSHOT_VALUE_SCHEMA, {"mode": "PERMISSIVE"})


def snapshot_struct(value: Column, zone: str = S.LOCAL_ZONE) -> Column:
    """Fields of a parsed snapshot, the time as a UTC instant (NTZ)."""
    return F.struct(
        parse_iso_instant(value["data_as_of"], zone).alias("data_as_of"),
        value["current_congestion"].alias("current_congestion"),
        value["speed_ratio"].alias("speed_ratio"),
        value["link_name"].alias("link_name"),
    )


def confidence(prob_array) -> Column:
    """largest class probability of an array column."""
    return F.array_max(_c(prob_array)).cast("double")


def struct_field(col, name: str) -> Column:
    """F21."""
    return _c(col).getField(name)
