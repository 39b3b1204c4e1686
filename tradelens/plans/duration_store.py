"""Durations kept by month, with histograms that add up to any window's quartiles.

    <root>/durations/created_month=...    the orders' durations (``order_durations_us``)
    <root>/values/created_month=...       (created_at, route, metric, v), sorted by metric and v
    <root>/histograms/created_month=...   per route, metric and bucket: count, smallest, largest value

A window's quartiles come from the histograms of the months that lie in it whole
and from the orders of the one or two months at its edges. Where the bucket that
holds a rank has several values, these are read from ``values``: only months of
the window are listed, and in them only row groups of the buckets' ranges are
read. ``refresh`` replaces months as the analysis table's enrichment does.
"""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from ..config import COMPRESSION, SUPPORTED_CHAINS
from ..functions.columns import instant
from ..operators.durations import order_durations_us, parse_window
from ..operators.quantiles import merged_histograms, metric_values, quartiles_of, route_histograms
from ..sources.store import PARTITION_COLUMN, month_of

_ALWAYS = ("0001-01-01", "9999-12-31")


def refresh(final_orders: DataFrame, root: str, chains: tuple[str, ...] = SUPPORTED_CHAINS) -> None:
    """Write the months of ``final_orders``, whole months of the analysis table, anew; other months keep their files."""
    spark = final_orders.sparkSession

    def replace(rows: DataFrame, name: str) -> None:
        writer = rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").option("compression", COMPRESSION)
        writer.partitionBy(PARTITION_COLUMN).parquet(f"{root}/{name}")

    months = final_orders.select(month_of("created_at").alias(PARTITION_COLUMN)).distinct()
    found = order_durations_us(final_orders, *_ALWAYS, chains).withColumn(PARTITION_COLUMN, month_of("created_at"))
    # A month without an eligible order is replaced too: by a row without a route, which readers drop.
    replace(found.unionByName(months, allowMissingColumns=True), "durations")
    kept = spark.read.parquet(f"{root}/durations").join(F.broadcast(months), PARTITION_COLUMN, "left_semi")
    values = metric_values(kept, also=(PARTITION_COLUMN, "created_at"))
    order = (PARTITION_COLUMN, "metric", "v")
    replace(values.repartitionByRange(*order).sortWithinPartitions(*order), "values")
    replace(route_histograms(kept, (PARTITION_COLUMN,)), "histograms")


def _read(spark: SparkSession, root: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{root}/{name}").where("source_chain IS NOT NULL")


def _month(t: dt.datetime) -> dt.date:
    return t.date().replace(day=1)


def window_quartiles_us(spark: SparkSession, root: str, start_time: str | None = None, end_time: str | None = None) -> DataFrame:
    """``route_quartiles_us`` of the orders of a window, both ends inclusive, without reading its durations."""
    start, end = parse_window(start_time, end_time)
    month, inside = F.col(PARTITION_COLUMN), F.col("created_at").between(instant(start), instant(end))
    within = (month > F.lit(_month(start))) & (month < F.lit(_month(end)))
    edges = _read(spark, root, "durations").where(month.isin(_month(start), _month(end)) & inside)
    whole = _read(spark, root, "histograms").where(within)
    hist = merged_histograms(whole.drop(PARTITION_COLUMN).unionByName(route_histograms(edges)))
    listed = (month >= F.lit(_month(start))) & (month <= F.lit(_month(end)))

    def values_in(ranges: list[Row]) -> DataFrame:
        """The window's values of the ranges' metrics, from the smallest to the largest that a range holds."""
        values = _read(spark, root, "values").where(listed & inside)
        spans = {m: [r for r in ranges if r["metric"] == m] for m in {r["metric"] for r in ranges}}
        held = [
            (F.col("metric") == m) & F.col("v").between(min(r["lo"] for r in rs), max(r["hi"] for r in rs))
            for m, rs in sorted(spans.items())
        ]
        return values.where(reduce(lambda a, b: a | b, held, F.lit(False))).select("source_chain", "destination_chain", "metric", "v")

    return quartiles_of(hist, values_in)
