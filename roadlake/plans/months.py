"""Month by month: landed history -> bronze months -> silver, with a ledger of finished source months.

A month that a stopped run left unfinished is done again and replaced as a whole; a
finished one is skipped unless it is named in ``redo``.  The ledger is one small file that names
the finished months; it is switched at once (``sources/versions``), after the month's data.  A month named
in ``redo`` leaves it before it is done, so a redo that fails is due again in the next run.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession

from ..operators.filters import filter_partition, month_range_filter
from ..sources.versions import pointer, read_table, switch
from ..sources.writers import write_bronze_month, write_silver
from .silver import silver_clean


def month_name(year: int, month: int) -> str:
    return f"{year:04d}-{month:02d}"


def finished(spark: SparkSession, ledger: str) -> set[str]:
    """The source months in the ledger."""
    return set(pointer(spark, ledger)[1])


def _each(spark: SparkSession, months: Iterable[tuple[int, int]], ledger: str, redo: Iterable[tuple[int, int]], step) -> dict[str, int]:
    months, again = list(months), {month_name(*m) for m in redo}
    if again:
        # out of the ledger first: a redo that fails is due again, though its old rows can still be read
        switch(spark, ledger, lambda done: {m: v for m, v in done.items() if m not in again})
    done = finished(spark, ledger)
    out = {}
    for year, month in months:
        name = month_name(year, month)
        if name in done:
            continue
        rows = step(year, month, name)
        if rows:
            switch(spark, ledger, lambda done: done | {name: {"rows": rows}})
            out[name] = rows
    return out


def land_months(raw: DataFrame, months: Iterable[tuple[int, int]], root: str, ledger: str,
                ts: str = "data_as_of", redo: Iterable[tuple[int, int]] = ()) -> dict[str, int]:
    """S5 + K1 per month; months without rows are not written.  Returns the rows of each month written now."""
    spark = raw.sparkSession

    def land(year: int, month: int, name: str) -> int:
        rows = month_range_filter(raw, year, month, ts=ts)
        if rows.limit(1).isEmpty():
            return 0
        return spark.read.parquet(write_bronze_month(rows, root, year, month)).count()  # from the file footers

    return _each(spark, months, ledger, redo, land)


def clean_months(spark: SparkSession, bronze_root: str, months: Iterable[tuple[int, int]], active: DataFrame, holidays: DataFrame,
                 silver_root: str, ledger: str, redo: Iterable[tuple[int, int]] = ()) -> dict[str, int]:
    """Q4 + K3 per source month: cleaned, then replaced as a whole below ``source_month=``.

    All months together equal ``silver_clean`` over all of bronze.  Returns the rows of each
    month written now; a month of which no row is valid is left out.
    """

    def clean(year: int, month: int, name: str) -> int:
        bronze = filter_partition(read_table(spark, bronze_root), year, month)
        if bronze.limit(1).isEmpty():
            return 0
        written = write_silver(silver_clean(bronze, active, holidays), silver_root, name)
        return spark.read.parquet(written).count() if written else 0  # none: nothing valid

    return _each(spark, months, ledger, redo, clean)
