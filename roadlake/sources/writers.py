"""Sinks (K1-K9).  A step that is run again leaves the table as one run would: months are
replaced as a whole, micro-batches are appended once per run and batch.

Parquet tables that are replaced (K1, K3 to K6) go through ``versions``: a write that fails or
is killed leaves the old rows readable.  Other formats (``delta``) bring transactions of their own.
"""

from __future__ import annotations

import re

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import settings as S
from ..functions.text import json_encode_snapshot
from ..functions.timefn import local_date_str, local_hour_str, utc_to_local
from .versions import read_table, replace_partitions, replace_unit


def write_bronze_month(df: DataFrame, root: str, year: int, month: int) -> str | None:
    """K1: replace one raw month, the unit ``year=/month=`` (other months untouched); its folder, or None if it is empty now."""
    return replace_unit(df.sparkSession, root, f"year={year}/month={month}", lambda path: df.write.parquet(path))


def processing_partition(df: DataFrame, processing_utc, zone: str = S.LOCAL_ZONE) -> DataFrame:
    """``date``/``hour`` partition keys from a processing time (UTC NTZ column or literal)."""
    t = processing_utc if not isinstance(processing_utc, str) else F.lit(processing_utc).cast("timestamp_ntz")
    local = utc_to_local(t, zone)
    return df.withColumn("date", local_date_str(local)).withColumn("hour", local_hour_str(local))


RUN, BATCH = "run_id", "batch_id"


def append_once(df: DataFrame, root: str, keys: list[str], partition_by: list[str], run_id: str, batch_id: int) -> int:
    """Append one micro-batch so that a retry adds only what is not stored yet.

    Every row carries the run and batch that wrote it, as plain columns.  If the
    partitions of the batch already hold rows of this run and batch (an attempt that was
    cut off, or one that had ended), the rows whose ``keys`` are there are left out.
    Only those partitions are read, and only on a retry is there anything to find.
    Returns 1 if rows were written, else 0.
    """
    spark = df.sparkSession
    out = df.withColumn(RUN, F.lit(str(run_id))).withColumn(BATCH, F.lit(int(batch_id)).cast("long"))
    out = out.persist()  # the checks and the write share one pass
    try:
        places = [tuple(r) for r in out.select(*partition_by).distinct().collect()]  # hours of one batch
        if not places:
            return 0
        try:
            schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in out.schema)
            there = spark.read.schema(schema).option("pathGlobFilter", "*.parquet").parquet(root)
        except AnalysisException:
            there = None  # nothing has been written yet
        if there is not None:
            *outer, inner = partition_by
            inside: dict[tuple, list] = {}
            for *place, v in places:
                inside.setdefault(tuple(place), []).append(v)
            here = F.lit(False)
            for place, values in inside.items():  # one term per outer partition, whatever it holds
                same = F.col(inner).isin(values)
                for c, v in zip(outer, place):
                    same &= F.col(c) == F.lit(v)
                here |= same
            there = there.where(here & (F.col(RUN) == F.lit(str(run_id))) & (F.col(BATCH) == F.lit(int(batch_id))))
            if not there.limit(1).isEmpty():
                match = [out[k].eqNullSafe(there[k]) for k in keys]
                out_new = out.join(there.select(*keys), match, "left_anti")
                if out_new.limit(1).isEmpty():
                    return 0
                out_new.write.mode("append").partitionBy(*partition_by).parquet(root)
                return 1
        out.write.mode("append").partitionBy(*partition_by).parquet(root)
        return 1
    finally:
        out.unpersist()


def write_bronze_realtime(df: DataFrame, root: str, run_id: str, batch_id: int, arrival: str = "ingest_ts",
                          keys: tuple = ("link_id", "data_as_of", "ingest_ts"), zone: str = S.LOCAL_ZONE) -> int:
    """K2: realtime bronze rows under ``date=/hour=`` of their arrival time in the batch.

    The arrival time belongs to the row, so a retry after the hour has changed goes to the
    same place.  ``run_id`` is new with every new stream checkpoint (whose batch numbers
    start again at 0); a batch is written once per run and batch, see ``append_once``.
    """
    out = processing_partition(df, F.col(arrival), zone)
    return append_once(out, root, list(keys), ["date", "hour"], run_id, batch_id)


def write_silver(df: DataFrame, root: str, source_month: str, fmt: str = "parquet") -> str | None:
    """K3: replace everything that one *source* month (``yyyy-MM`` of the UTC input) gave; its folder, or None if it is empty now.

    Below ``source_month=`` rows lie by year and month of local time, so the hours of a
    source month that belong to the local month before do not touch that month's own rows.
    """
    if not re.fullmatch(r"\d{4}-\d{2}", source_month):
        raise ValueError("source_month is yyyy-MM")
    out = df.withColumn("year", F.year("data_as_of").cast("int")).withColumn("month", F.month("data_as_of").cast("int"))
    if fmt != "parquet":
        path = f"{root}/source_month={source_month}"
        out.write.format(fmt).mode("overwrite").partitionBy("year", "month").save(path)
        return path
    return replace_unit(df.sparkSession, root, f"source_month={source_month}", lambda path: out.write.partitionBy("year", "month").parquet(path))


def _gold_layout(df: DataFrame, partitions: int, files_per_month: int) -> DataFrame:
    slot = F.pmod(F.xxhash64("link_id", "data_as_of"), F.lit(files_per_month))
    return df.repartition(partitions, "year", "month", slot)


def write_gold(df: DataFrame, root: str, fmt: str = "parquet", partitions: int = S.GOLD_WRITE_PARTITIONS,
               files_per_month: int = 8, max_records: int = S.GOLD_MAX_RECORDS_PER_FILE) -> None:
    """K4: replace the whole ``year``/``month`` partitioned gold table, at most ``max_records`` rows per file.

    Rows are spread over ``files_per_month`` hash slots per month before the write,
    so one large month is written by several tasks instead of one.
    """
    _write_gold(df, root, fmt, partitions, files_per_month, max_records, whole=True)


def _write_gold(df: DataFrame, root: str, fmt: str, partitions: int, files_per_month: int, max_records: int, whole: bool) -> None:
    def writer():
        return (_gold_layout(df, partitions, files_per_month).write.format(fmt).option("maxRecordsPerFile", max_records)
                .partitionBy("year", "month"))

    if fmt == "parquet":
        replace_partitions(df.sparkSession, root, ["year", "month"], lambda path: writer().save(path), whole)
    else:
        writer().mode("overwrite").option("partitionOverwriteMode", "static" if whole else "dynamic").save(root)


def replace_gold_months(df: DataFrame, root: str, fmt: str = "parquet", partitions: int = S.GOLD_WRITE_PARTITIONS,
                        files_per_month: int = 8, max_records: int = S.GOLD_MAX_RECORDS_PER_FILE) -> None:
    """K4, partial form: replace only the months that ``df`` holds; all others stay."""
    _write_gold(df, root, fmt, partitions, files_per_month, max_records, whole=False)


def write_lookup(df: DataFrame, path: str) -> None:
    """K5: overwrite a small dimension as one file (one row per link)."""
    # repartition, not coalesce: what computes the rows keeps its own parallelism
    replace_unit(df.sparkSession, path, "", lambda place: df.repartition(1).write.parquet(place))


def compact_artifact(spark: SparkSession, src: str, dst: str) -> bool:
    """K6: rewrite a multi-file dimension as one file (``dst`` may be ``src``: the old files stay until they are vacuumed).

    Refuses (returns False, writes nothing) when the source reads as empty.
    """
    df = read_table(spark, src)
    if df.isEmpty():
        return False
    replace_unit(spark, dst, "", lambda place: df.repartition(1).write.parquet(place))
    return True


def message_id(df: DataFrame, run_id: str, batch_id: int) -> Column:
    """Run, batch and row: a batch that is published again gives its rows the same ids.

    The row is told by all its columns, so rows that differ have different ids; rows that are
    equal in every column are one message.
    """
    row = F.sha2(F.to_json(F.struct(*(F.col(f"`{c}`") for c in df.columns))), 256)
    return F.concat_ws(":", F.lit(str(run_id)), F.lit(int(batch_id)).cast("string"), row)


def snapshot_messages(df: DataFrame, zone: str = S.LOCAL_ZONE, timestamp_col: str | None = None, id_col: Column | None = None) -> DataFrame:
    """K7 payload: key = link_id, value = JSON snapshot (+ message time for file topics)."""
    cols = [F.col("link_id").cast("string").alias("key"), json_encode_snapshot(zone=zone, message_id=id_col).alias("value")]
    if timestamp_col:
        cols.append(F.col(timestamp_col).alias("timestamp"))
    return df.select(*cols)


def write_snapshots(df: DataFrame, fmt: str = "kafka", options: dict | None = None,
                    path: str | None = None, timestamp_col: str | None = None,
                    run_id: str | None = None, batch_id: int | None = None) -> None:
    """K7: publish snapshots to the topic (``kafka``) or, in tests, append to a folder
    (``timestamp_col`` then plays the broker's message time).

    With ``run_id`` and ``batch_id`` every message carries an id, by which readers (``scan_snapshots_bounded``,
    ``snapshot_stream``) take a batch that was published twice once.
    """
    named = None if run_id is None else message_id(df, run_id, batch_id)
    if fmt == "kafka":
        snapshot_messages(df, id_col=named).write.format("kafka").options(**(options or {})).save()
    else:
        snapshot_messages(df, timestamp_col=timestamp_col, id_col=named).write.mode("append").format(fmt).save(path)


def write_predictions(df: DataFrame, root: str, processing_utc, run_id: str, batch_id: int,
                      zone: str = S.LOCAL_ZONE) -> bool:
    """K8: predictions under ``date=/hour=`` of processing time, once per run and batch.

    ``processing_utc`` is the batch's own time, so a retried tick meets its first attempt;
    an empty run writes nothing (returns False).
    """
    out = processing_partition(df, processing_utc, zone)
    return bool(append_once(out, root, ["link_id", "timestamp"], ["date", "hour"], run_id, batch_id))


def write_json_list(ids: DataFrame, path: str, col: str = "link_id") -> None:
    """The active-link artifact: one JSON array of sorted ids in one text file.

    The list holds one entry per road link (P7 output), so gathering it into a single
    row is bounded by the road network, not by the reading volume.
    """
    arr = ids.agg(F.to_json(F.sort_array(F.collect_set(F.col(col).cast("string")))).alias("value"))
    arr.coalesce(1).write.mode("overwrite").text(path)
