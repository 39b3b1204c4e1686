"""The analysis table (``final_orders``) as a Parquet table on shared storage.

Sources may be Parquet paths or JDBC tables; the analysis table is Parquet,
partitioned by the month of ``created_at`` and by whether an order still waits
for a time (``is_open``): windowed analysis prunes months, the recurring search
for missing times skips the closed rows. Rows are range-clustered on
``created_at``, so that row-group statistics prune inside the months.

Updates replace the months that they touch (Spark's dynamic partition overwrite)
from a staging folder, since a path is never overwritten while it is read.
Only partitions that get a row are replaced; a month whose last open row was
closed gets an empty row (no ``create_order_id``) there, which readers drop.
"""

from __future__ import annotations

import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.utils import AnalysisException

from ..config import COMPRESSION
from ..functions.columns import missing_time_gate, utc_date
from .schemas import FINAL_ORDER_COLUMNS, FINAL_ORDERS

PARTITION_COLUMN = "created_month"
OPEN_COLUMN = "is_open"
_LAYOUT = (PARTITION_COLUMN, OPEN_COLUMN)


def read_source(spark: SparkSession, location: str, fmt: str = "parquet", options: dict | None = None) -> DataFrame:
    """Read one source table: ``parquet`` path, or ``jdbc`` with options (url, dbtable, ...)."""
    reader = spark.read.format(fmt)
    for k, v in (options or {}).items():
        reader = reader.option(k, v)
    return reader.load(location) if fmt != "jdbc" else reader.load()


def ensure_table(spark: SparkSession, path: str) -> DataFrame:
    """Create the table (empty, declared schema) when it does not exist; return it."""
    try:
        return read_orders_table(spark, path)
    except AnalysisException:
        empty = _laid_out(spark.createDataFrame([], FINAL_ORDERS))
        empty.write.mode("ignore").partitionBy(*_LAYOUT).parquet(path)
        return read_orders_table(spark, path)


def month_of(c: str) -> Column:
    """First day of the UTC month."""
    return F.trunc(utc_date(F.unix_micros(c)), "month")


def months_of(rows: DataFrame) -> list[datetime.date]:
    """The UTC months that rows lie in: a few hundred for decades of data."""
    return sorted(r[0] for r in rows.select(month_of("created_at")).distinct().collect() if r[0] is not None)


def stored_months(spark: SparkSession, path: str, months: list[datetime.date]) -> list[datetime.date]:
    """Those of ``months`` in which the table has a row."""
    found = _stored(spark, path).where(F.col(PARTITION_COLUMN).isin(months)).select(PARTITION_COLUMN).distinct()
    return sorted(r[0] for r in found.collect())


def _laid_out(df: DataFrame) -> DataFrame:
    return df.select(*FINAL_ORDER_COLUMNS, month_of("created_at").alias(PARTITION_COLUMN), missing_time_gate().alias(OPEN_COLUMN))


def _stored(spark: SparkSession, path: str) -> DataFrame:
    layout = [T.StructField(PARTITION_COLUMN, T.DateType(), True), T.StructField(OPEN_COLUMN, T.BooleanType(), True)]
    return spark.read.schema(T.StructType(FINAL_ORDERS.fields + layout)).parquet(path).where("create_order_id IS NOT NULL")


def read_orders_table(spark: SparkSession, path: str, start=None, end=None, only_open: bool = False) -> DataFrame:
    """The table; with window bounds (UTC datetimes) only the months they touch are listed, and open rows only if asked."""
    df = _stored(spark, path)
    if start is not None:
        df = df.where(F.col(PARTITION_COLUMN) >= F.lit(start.date().replace(day=1)))
    if end is not None:
        df = df.where(F.col(PARTITION_COLUMN) <= F.lit(end.date().replace(day=1)))
    if only_open:
        df = df.where(F.col(OPEN_COLUMN))
    return df.select(*FINAL_ORDER_COLUMNS)


def read_months(spark: SparkSession, path: str, months: list[datetime.date]) -> DataFrame:
    """The rows of some months; the others are not listed."""
    return _stored(spark, path).where(F.col(PARTITION_COLUMN).isin(months)).select(*FINAL_ORDER_COLUMNS)


def write_orders(df: DataFrame, path: str, mode: str = "append") -> None:
    """Append (sync) or write a new snapshot (enrichment), partitioned by month and open rows.

    Range partitioning on ``created_at`` (sampled bounds) gives each task a
    contiguous time slice: a busy month is split over many tasks, and each task
    writes files for one or two months only.
    """
    clustered = df.select(*FINAL_ORDER_COLUMNS).repartitionByRange("created_at", "create_order_id")
    _laid_out(clustered).write.mode(mode).option("compression", COMPRESSION).partitionBy(*_LAYOUT).parquet(path)


def write_snapshot(untouched: DataFrame, changed: DataFrame, path: str) -> None:
    """A new snapshot from rows read unchanged from a stored snapshot plus changed rows.

    Unchanged rows keep their month clustering and are written without a
    shuffle; only the changed rows are range-clustered on ``created_at``.
    """
    clustered = changed.select(*FINAL_ORDER_COLUMNS).repartitionByRange("created_at", "create_order_id")
    both = untouched.select(*FINAL_ORDER_COLUMNS).unionByName(clustered)
    _laid_out(both).write.mode("errorifexists").option("compression", COMPRESSION).partitionBy(*_LAYOUT).parquet(path)


def replace_months(spark: SparkSession, rows: DataFrame, months: list[datetime.date], path: str, staging: str) -> None:
    """Replace ``months`` of the table by ``rows``, which may be read from it and lie in these months.

    They are written to ``staging``, a fresh folder, first. All partitions are
    replaced by one job: a run that fails before its commit changes nothing.
    """
    write_orders(rows, staging, "errorifexists")
    staged = _stored(spark, staging)
    still_open = {r[0] for r in staged.where(OPEN_COLUMN).select(PARTITION_COLUMN).distinct().collect()}  # at most ``months``
    closed = [(m, True) for m in months if m not in still_open]
    if closed:
        staged = staged.unionByName(spark.createDataFrame(closed, f"{PARTITION_COLUMN} date, {OPEN_COLUMN} boolean"), allowMissingColumns=True)
    writer = staged.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").option("compression", COMPRESSION)
    writer.partitionBy(*_LAYOUT).parquet(path)
