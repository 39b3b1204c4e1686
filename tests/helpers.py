"""Small hand-made rows for edge cases the projected fixtures do not reach."""

import datetime as dt

from pyspark.sql import Window
from pyspark.sql import functions as F

from tradelens.config import FENCED_METRICS
from tradelens.operators.quantiles import ROUTE, route_metric_counts
from tradelens.sources.schemas import BLOCKS, CREATE_ORDERS, FINAL_ORDERS, MATCHED_ORDERS, SWAPS, TRANSACTIONS

UTC = dt.timezone.utc


def ts(s):
    return dt.datetime.fromisoformat(s).replace(tzinfo=UTC)


def final_rows(spark, rows):
    """rows: dicts with any subset of the analysis-table columns."""
    names = [f.name for f in FINAL_ORDERS.fields]
    data = []
    for r in rows:
        base = {
            "source_swap_id": "ss_" + r["create_order_id"],
            "destination_swap_id": "ds_" + r["create_order_id"],
            "created_at": ts("1997-01-01T00:00:00"),
            "source_chain": "base",
            "destination_chain": "base",
        }
        base.update(r)
        data.append(tuple(base.get(n) for n in names))
    return spark.createDataFrame(data, FINAL_ORDERS)


def swaps_df(spark, rows):
    names = [f.name for f in SWAPS.fields]
    return spark.createDataFrame([tuple(r.get(n) for n in names) for r in rows], SWAPS)


def create_orders_df(spark, rows):
    names = [f.name for f in CREATE_ORDERS.fields]
    return spark.createDataFrame([tuple(r.get(n) for n in names) for r in rows], CREATE_ORDERS)


def matched_df(spark, rows):
    names = [f.name for f in MATCHED_ORDERS.fields]
    return spark.createDataFrame([tuple(r.get(n) for n in names) for r in rows], MATCHED_ORDERS)


def blocks_df(spark, rows):
    return spark.createDataFrame(rows, BLOCKS)


def tx_df(spark, rows):
    return spark.createDataFrame(rows, TRANSACTIONS)


def tsn(s):
    """Naive form, as collected rows carry it (the test process runs on UTC)."""
    return dt.datetime.fromisoformat(s)


def route_quartiles_by_row_number(durations_us, metrics=FENCED_METRICS):
    """The original's shape (ROW_NUMBER per route, value at the target rank).

    Sorts each route in one task: a test oracle for small inputs, not for scale.
    """
    counts = route_metric_counts(durations_us, metrics)
    out = counts.select(*ROUTE)
    for m in metrics:
        w = Window.partitionBy(*ROUTE).orderBy(F.col(f"{m}_us").asc_nulls_last())
        ranked = durations_us.where(F.col(f"{m}_us").isNotNull()).select(
            *ROUTE, F.col(f"{m}_us").alias("v"), F.row_number().over(w).alias("rn")
        )
        c = counts.select(*ROUTE, F.col(f"{m}_count").alias("n"))
        j = ranked.join(c, ROUTE)
        n1 = F.col("n") + 1
        r1 = F.greatest(F.lit(1), F.floor(n1 / 4))
        r3 = F.greatest(F.lit(1), F.floor(3 * n1 / 4))
        per = j.groupBy(*ROUTE).agg(
            F.max(F.when(F.col("rn") == r1, F.col("v"))).alias(f"q1_{m}_us"),
            F.max(F.when(F.col("rn") == r3, F.col("v"))).alias(f"q3_{m}_us"),
        )
        out = out.join(per, ROUTE, "left")
    return out
