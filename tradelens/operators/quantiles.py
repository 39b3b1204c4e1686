"""Exact per-route quartiles of the stage durations.

Rule (kept from the original): with n non-NULL values of a metric in a route,
q_p is the value at ascending rank ``max(1, floor(p * (n + 1)))``; the
original's interpolation fallback only ever fires when that rank is 0, and
then weighs the rank-1 value twice, so no value is ever interpolated.

A ROW_NUMBER per route sorts a whole route in one task; one route can hold a
large share of all orders. Instead the value at a rank is found by counting:

    first pass: histogram of floor(2 ** 16 * log(1 + v)) per (route, metric)
    later passes: histogram of the chosen bucket's range in 2 ** 21 equal parts

Each pass is one scan with a partial (map-side) aggregation and a running count
over at most 2^22 buckets per (route, metric), whatever rows a route has. The
logarithm never decreases, so buckets are ranges. A bucket's smallest and
largest value come with its count: where they agree the value is found, and
below 51 days two passes always suffice. Between passes the driver holds one
row per (route, metric, quartile): at most len(chains)^2 * 4 * 2.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Row, Window
from pyspark.sql import functions as F

from ..config import FENCED_METRICS

ROUTE = ["source_chain", "destination_chain"]
FIRST_SCALE = 1 << 16
SPLIT_BITS = 21


def metric_values(durations_us: DataFrame, metrics: tuple[str, ...] = FENCED_METRICS, also: tuple[str, ...] = ()) -> DataFrame:
    """Long form: (``also``, route, metric, v), unpivoted in one pass; v is NULL where the metric is."""
    arr = F.array(*[F.struct(F.lit(m).alias("metric"), F.col(f"{m}_us").alias("v")) for m in metrics])
    return durations_us.select(*also, *ROUTE, F.inline(arr))


def route_metric_counts(durations_us: DataFrame, metrics: tuple[str, ...] = FENCED_METRICS) -> DataFrame:
    """Per route: the number of non-NULL values of each metric (``<metric>_count``)."""
    return durations_us.groupBy(*ROUTE).agg(*[F.count(f"{m}_us").alias(f"{m}_count") for m in metrics])


def _first_bucket() -> Column:
    return F.floor(F.log1p(F.col("v").cast("double")) * FIRST_SCALE)


def _histogram(values: DataFrame, keys: list[str], bucket: Column, weight: str | None = None) -> DataFrame:
    count = F.sum(weight) if weight else F.count(F.lit(1))
    return values.groupBy(*keys, bucket.alias("bucket")).agg(count.alias("cnt"), F.min("v").alias("lo"), F.max("v").alias("hi"))


def _running(hist: DataFrame, keys: list[str]) -> DataFrame:
    w = Window.partitionBy(*keys).orderBy("bucket").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return hist.withColumn("upto", F.sum("cnt").over(w))


def _holding(running: DataFrame, keys: list[str]) -> DataFrame:
    """Buckets that hold the wanted rank, with the rank left inside, the bucket's range and its count."""
    return running.where((F.col("upto") - F.col("cnt") < F.col("r")) & (F.col("r") <= F.col("upto"))).select(
        *keys, "q", (F.col("r") - (F.col("upto") - F.col("cnt"))).alias("r"), "lo", "hi", F.col("cnt").alias("n")
    )


def _narrow(values: DataFrame, keys: list[str], found: list[Row], weight: str | None = None) -> list[Row]:
    """Pass after pass over the values of ranges that still hold several, until every rank has its value."""
    kinds = {f.name: f.dataType.simpleString() for f in values.schema.fields}
    schema = ", ".join([f"{k} {kinds[k]}" for k in keys] + ["q long", "r long", "lo long", "hi long", "shift int"])
    while open_ranges := [r for r in found if r["lo"] < r["hi"]]:
        rows = [
            (*[r[k] for k in keys], r["q"], r["r"], r["lo"], r["hi"], max(0, (r["hi"] - r["lo"]).bit_length() - SPLIT_BITS))
            for r in open_ranges
        ]
        ranges = F.broadcast(values.sparkSession.createDataFrame(rows, schema).withColumnsRenamed({"lo": "from", "hi": "to"}))
        inside = values.join(ranges, keys).where(F.col("v").between(F.col("from"), F.col("to")))
        part = F.call_function("shiftright", F.col("v") - F.col("from"), F.col("shift"))
        hist = _histogram(inside, [*keys, "q", "r"], part, weight)
        done = [r for r in found if r["lo"] == r["hi"]]
        found = done + _holding(_running(hist, [*keys, "q", "r"]), keys).collect()
    return found


def select_ranks(values: DataFrame, targets: list[tuple], keys: list[str], weight: str | None = None) -> list[Row]:
    """The value at an ascending rank (1-based) for every target: keys, q, r, lo, hi, n.

    ``values``: keys + ``v`` (non-negative long, NULLs left out); ``targets``:
    tuples of keys, ``q`` and rank, where (keys, ``q``) names one target. They
    and the result are on the driver: the caller's few ranks. ``lo`` and ``hi``
    are the value, ``r`` the rank among the ``n`` rows that equal it. With
    ``weight``, a long column, a row counts so many times.
    """
    values = values.where(F.col("v").isNotNull())
    kinds = {f.name: f.dataType.simpleString() for f in values.schema.fields}
    schema = ", ".join([f"{k} {kinds[k]}" for k in keys] + ["q long", "r long"])
    wanted = F.broadcast(values.sparkSession.createDataFrame(targets, schema))
    running = _running(_histogram(values, keys, _first_bucket(), weight), keys)
    return _narrow(values, keys, _holding(running.join(wanted, keys), keys).collect(), weight)


def route_histograms(durations_us: DataFrame, by: tuple[str, ...] = (), metrics: tuple[str, ...] = FENCED_METRICS) -> DataFrame:
    """Per (``by``, route, metric) the first pass's buckets with count, smallest and largest value.

    Histograms of parts of the orders add up to that of all (``merged_histograms``).
    Rows without a value have the bucket NULL, so every route is listed.
    """
    return _histogram(metric_values(durations_us, metrics, by), [*by, *ROUTE, "metric"], _first_bucket())


def merged_histograms(histograms: DataFrame) -> DataFrame:
    """The sum of histograms, per (route, metric)."""
    return histograms.groupBy(*ROUTE, "metric", "bucket").agg(F.sum("cnt").alias("cnt"), F.min("lo").alias("lo"), F.max("hi").alias("hi"))


def route_quartiles_us(durations_us: DataFrame, metrics: tuple[str, ...] = FENCED_METRICS) -> DataFrame:
    """Per route with eligible orders: ``q1_<m>_us``, ``q3_<m>_us`` (NULL when the metric has no value).

    Runs the passes now; the result is a local table of at most one row per route.
    """
    return quartiles_of(route_histograms(durations_us, metrics=metrics), lambda _: metric_values(durations_us, metrics), metrics)


def quartiles_of(hist: DataFrame, values_in: Callable[[list[Row]], DataFrame], metrics: tuple[str, ...] = FENCED_METRICS) -> DataFrame:
    """``route_quartiles_us`` from its first histogram; ``values_in(ranges)`` gives the values to look for in ranges that hold several."""
    keys = [*ROUTE, "metric"]
    some = hist.where(F.col("bucket").isNotNull())
    n1 = F.sum("cnt").over(Window.partitionBy(*keys)) + 1
    # rank floor(q * (n + 1) / 4) for q = 1, 3; division by 4 is exact in binary floating point
    ranks = F.array(
        *[
            F.struct(F.lit(q).cast("long").alias("q"), F.greatest(F.lit(1).cast("long"), F.floor(q * F.col("n1") / 4).cast("long")).alias("r"))
            for q in (1, 3)
        ]
    )
    running = _running(some, keys).withColumn("n1", n1).select("*", F.inline(ranks))
    # The routes come with the same histogram, also those without any value.
    none = [F.lit(None).cast("long").alias(c) for c in ("q", "r", "lo", "hi", "n")]
    listed = hist.groupBy(*ROUTE).agg(F.min("metric").alias("metric")).select(*keys, *none)
    found = _holding(running, keys).unionByName(listed).collect()
    routes = sorted({tuple(r[k] for k in ROUTE) for r in found}, key=repr)
    found = [r for r in found if r["q"] is not None]
    narrowed = _narrow(values_in([r for r in found if r["lo"] < r["hi"]]), keys, found)
    picked = {(*[r[k] for k in keys], r["q"]): r["lo"] for r in narrowed}
    rows = [(*route, *[picked.get((*route, m, q)) for m in metrics for q in (1, 3)]) for route in routes]
    schema = ", ".join([f"{c} string" for c in ROUTE] + [f"q{q}_{m}_us long" for m in metrics for q in (1, 3)])
    return hist.sparkSession.createDataFrame(rows, schema)
