"""Sources (S1-S9): parquet / table scans, the text feed, JSON id lists, landed
history, the snapshot topic, prediction folders and partition checks.

Scans are lazy and declarative: filters and projections applied afterwards are
pushed into the parquet reader (``PushedFilters``, pruned ``ReadSchema``) and
``year``/``month``/``date``/``hour`` predicates prune partition directories.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import settings as S
from ..functions.text import MESSAGE_ID, clean_quotes, snapshot_struct, snapshot_value
from ..functions.timefn import epoch_ntz, local_date_str, local_hour_str, parse_local_ts, plus_minutes, utc_to_local
from ..operators.filters import _lit_ts, all_of, month_range_filter
from .versions import read_table

#: Columns taken from the feed by name (the last may be missing), and what they are called here.
FEED_COLUMNS = {"linkId": "raw_link", "Speed": "raw_speed", "DataAsOf": "raw_time", "linkName": "raw_name"}


def scan_parquet(spark: SparkSession, path: str, schema: T.StructType | str | None = None) -> DataFrame:
    """One parquet file, a folder of them, or a table of replaced versions (e.g. a dimension of K5)."""
    return read_table(spark, path, schema)


def scan_table(spark: SparkSession, path: str, fmt: str = "parquet", equals: dict | None = None) -> DataFrame:
    """A (partitioned) lakehouse table; ``fmt`` is ``parquet`` or ``delta``; ``equals`` spares listing other partitions (see ``read_table``)."""
    return read_table(spark, path, equals=equals) if fmt == "parquet" else spark.read.format(fmt).load(path)


def scan_feed_tsv(spark: SparkSession, path: str, streaming: bool = False, max_files: int | None = None) -> DataFrame:
    """S3: tab-separated feed files with a header line whose names and values carry quotes.

    Each file's own header says where its columns are: ``linkId``, ``Speed``, ``DataAsOf``
    and ``linkName`` are picked by name as text, whatever their order and whatever else
    there is; a column that a file lacks is null.  ``feed_ts`` (the file's time, UTC),
    ``feed_file`` and ``feed_row`` (the line in the file) say in which order rows arrived.  A file is one
    fetch of all links, read whole; ``max_files`` bounds a micro-batch.
    """
    reader = (spark.readStream if streaming else spark.read).format("text").option("wholetext", "true")
    if streaming and max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    mtime = F.unix_micros(F.col("_metadata.file_modification_time"))
    files = reader.load(path).select(F.split("value", "\\r?\\n").alias("lines"),
                                     F.timestamp_add("MICROSECOND", mtime, epoch_ntz()).alias("feed_ts"),
                                     F.col("_metadata.file_path").alias("feed_file"))
    return feed_lines(files)


def feed_lines(files: DataFrame) -> DataFrame:
    """Rows of feed files given as ``lines`` (the first is the header), ``feed_ts`` and ``feed_file``."""
    names = F.transform(F.split(F.element_at("lines", 1), "\t"), clean_quotes)
    rows = (files.withColumn("names", names)
            .select("names", "feed_ts", "feed_file", F.posexplode(F.slice("lines", 2, F.greatest(F.size("lines") - 1, F.lit(0)))).alias("feed_row", "line"))
            .where(F.trim("line") != ""))
    values = F.split("line", "\t")
    pick = lambda n: F.try_element_at(values, F.nullif(F.array_position("names", n).cast("int"), F.lit(0)))
    return rows.select(*(pick(n).alias(c) for n, c in FEED_COLUMNS.items()), "feed_ts", "feed_file",
                       F.col("feed_row").cast("long").alias("feed_row"))


def parse_feed(feed: DataFrame, zone: str = S.LOCAL_ZONE) -> DataFrame:
    """S3 + F3 + F11: quoted feed columns -> link_id, speed, data_as_of (UTC), link_name ('' if missing)."""
    speed_txt = clean_quotes("raw_speed")
    return feed.select(
        "*",
        clean_quotes("raw_link").alias("link_id"),
        F.when(speed_txt != "", speed_txt.try_cast("double")).alias("speed"),
        parse_local_ts(clean_quotes("raw_time"), zone).alias("data_as_of"),
        F.coalesce(clean_quotes("raw_name"), F.lit("")).alias("link_name"),
    ).drop(*FEED_COLUMNS.values())


def explode_json_ids(df: DataFrame, col: str, out: str = "link_id") -> DataFrame:
    """A JSON array of ids -> one row per id (invalid JSON -> no rows)."""
    arr = F.from_json(F.col(col), T.ArrayType(T.StringType()))
    return df.select("*", F.explode(arr).alias(out)).drop(col)


def scan_json_list(spark: SparkSession, path: str, out: str = "link_id") -> DataFrame:
    """Read a file holding one JSON array of ids (e.g. the active list)."""
    text = spark.read.option("wholetext", "true").text(path)
    return explode_json_ids(text, "value", out=out)


def land_history_month(raw: DataFrame, year: int, month: int, ts: str = "data_as_of") -> DataFrame:
    """One month ``[start, next month start)`` of landed raw rows, time-ordered
    within each output file (no global sort, no single task)."""
    return month_range_filter(raw, year, month, ts=ts).sortWithinPartitions(ts)


def read_landed_json(spark: SparkSession, path: str) -> DataFrame:
    """S5 input: landed raw JSON rows, every field kept as text (like the landing step)."""
    return spark.read.option("primitivesAsString", "true").json(path)


def lookback_window(snapshots: DataFrame, now, minutes: float = S.LOOKBACK_MINUTES,
                    ts: str = "data_as_of") -> DataFrame:
    """T7 / S6 filter: snapshots at or after ``now - minutes``."""
    return snapshots.filter(F.col(ts) >= plus_minutes(_lit_ts(now), -minutes))


def decode_snapshot_messages(msgs: DataFrame, zone: str = S.LOCAL_ZONE) -> DataFrame:
    """S6 decode: (key, value[, timestamp]) messages -> snapshot rows; null keys,
    invalid JSON and messages missing a required field are dropped.  ``message_id`` is null in
    messages that carry none.

    Each message is parsed once: the parsed value is named inside one expression, not as a column, because Spark
    writes a column's expression out again for every predicate on it and every field taken from it.
    """
    value = F.col("value").cast("string")
    cols = [F.col("key").cast("string").alias("link_id"), F.get_json_object(value, f"$.{MESSAGE_ID}").alias(MESSAGE_ID)]
    if "timestamp" in msgs.columns:
        cols.append(F.col("timestamp").alias("msg_ts"))
    parsed = F.transform(F.array(snapshot_value(value)), lambda v: snapshot_struct(v, zone))
    whole = F.filter(parsed, lambda v: all_of(v[c].isNotNull() for c in ("data_as_of", "current_congestion", "speed_ratio")))
    return msgs.filter(F.col("key").isNotNull()).select(*cols, F.inline(whole))


def published_once(snapshots: DataFrame) -> DataFrame:
    """Each message id once, in a batch or (within its watermark) in a stream; messages without an id all stay."""
    named = snapshots.withColumn(MESSAGE_ID, F.coalesce(MESSAGE_ID, F.uuid()))
    once = named.dropDuplicatesWithinWatermark([MESSAGE_ID]) if snapshots.isStreaming else named.dropDuplicates([MESSAGE_ID])
    return once.drop(MESSAGE_ID)


def snapshot_stream(msgs: DataFrame, late_minutes: float = S.LOOKBACK_MINUTES, zone: str = S.LOCAL_ZONE) -> DataFrame:
    """S6 as a stream: decoded messages with ``event_ts`` and its watermark, each published row once.

    Ids are remembered until the watermark has passed the row's time by ``late_minutes``.
    """
    from ..streaming.state import with_event_time
    return published_once(with_event_time(decode_snapshot_messages(msgs, zone), late_minutes))


def scan_snapshots_bounded(spark: SparkSession, now_ms: int, lookback_minutes: float = S.LOOKBACK_MINUTES,
                           fmt: str = "kafka", options: dict | None = None,
                           path: str | None = None, zone: str = S.LOCAL_ZONE) -> DataFrame:
    """Every message since ``now - lookback`` on all partitions, decoded, a row published twice once.

    ``fmt="kafka"``: starting offsets by timestamp, falling back to the latest offset
    where no message is that new.  Any other ``fmt`` reads a message folder (tests)
    and filters by message time.
    """
    start = now_ms - int(lookback_minutes * 60_000)
    if fmt == "kafka":
        opts = dict(options or {})
        opts.setdefault("startingTimestamp", str(start))
        opts.setdefault("startingOffsetsByTimestampStrategy", "latest")
        msgs = spark.read.format("kafka").options(**opts).load()
    else:
        msgs = spark.read.format(fmt).load(path)
        start_ts = F.timestamp_add("MILLISECOND", F.lit(start), F.lit("1970-01-01").cast("timestamp_ntz"))
        msgs = msgs.filter(F.col("timestamp") >= start_ts)
    return published_once(decode_snapshot_messages(msgs, zone))


def scan_predictions(spark: SparkSession, root: str) -> DataFrame:
    """Every prediction file under ``root`` (date=/hour= discovered); non-parquet files ignored."""
    return spark.read.option("pathGlobFilter", "*.parquet").option("basePath", root).parquet(root)


def recent_hours(df: DataFrame, now, minutes: float = S.LOOKBACK_MINUTES, zone_is_local: bool = False,
                 ts: str = "data_as_of", zone: str = S.LOCAL_ZONE) -> DataFrame:
    """Rows of every ``date``/``hour`` partition overlapping ``[now - minutes, now]``
    (local partition keys), then the exact time predicate.

    The first predicate reads the partition columns only, so Spark prunes directories.
    """
    now_c = _lit_ts(now)
    start = plus_minutes(now_c, -minutes)
    lo_local, hi_local = utc_to_local(start, zone), utc_to_local(now_c, zone)
    # a written table gives the keys back as DATE and INT, a frame in memory as text
    key = F.concat(F.col("date").cast("string"), F.lit(" "), F.lpad(F.col("hour").cast("string"), 2, "0"))
    lo_key = F.concat(local_date_str(lo_local), F.lit(" "), local_hour_str(lo_local))
    hi_key = F.concat(local_date_str(hi_local), F.lit(" "), local_hour_str(hi_local))
    return df.filter((key >= lo_key) & (key <= hi_key)).filter(F.col(ts) >= start)


def partition_exists(spark: SparkSession, path: str, fmt: str = "parquet", **equals) -> bool:
    """Does the table (or the partition given by ``equals``) hold any row?

    A missing path or table counts as empty.  Only one row is read.
    """
    try:
        df = scan_table(spark, path, fmt, equals)
    except AnalysisException:
        return False
    for k, v in equals.items():
        df = df.filter(F.col(k) == v)
    return not df.limit(1).isEmpty()
