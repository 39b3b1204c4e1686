"""Per-route fences, the normal / anomalous split, averages and the route grid.

Fences use q1, q3 of a route's metric: upper = q3 + 1.5 (q3 - q1) filters,
lower = q1 - 1.5 (q3 - q1) is only reported. On integer microseconds the test
``d > upper`` is ``2 d > 5 q3 - 3 q1``, exact with no rounding.

The quartile table has one row per route (at most len(chains)^2 rows), so it is
broadcast to the per-order durations: the split is a map-side filter with no
shuffle of the orders.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..config import ALL_METRICS, FENCED_METRICS, SUPPORTED_CHAINS
from ..functions.columns import MICROS_PER_SECOND, iso_utc, us_to_seconds
from .durations import REDEEMED_FLAG, to_seconds
from .quantiles import ROUTE

_SEC = float(MICROS_PER_SECOND)


def _twice_upper(m: str) -> Column:
    return 5 * F.col(f"q3_{m}_us") - 3 * F.col(f"q1_{m}_us")


def route_quartiles(quartiles_us: DataFrame) -> DataFrame:
    """Seconds form of the quartile table: ``q1_<m>_duration``, ``q3_<m>_duration``."""
    return quartiles_us.select(
        *ROUTE,
        *[us_to_seconds(f"q{q}_{m}_us").alias(f"q{q}_{m}_duration") for m in FENCED_METRICS for q in (1, 3)],
    )


def route_fences(quartiles_us: DataFrame) -> DataFrame:
    """Long form: (route, metric, q1, q3, lower_fence, upper_fence) in seconds."""
    arr = F.array(
        *[
            F.struct(
                F.lit(f"{m}_duration").alias("metric"),
                F.col(f"q1_{m}_us").alias("q1_us"),
                F.col(f"q3_{m}_us").alias("q3_us"),
            )
            for m in FENCED_METRICS
        ]
    )
    long = quartiles_us.select(*ROUTE, F.inline(arr))
    q1, q3 = F.col("q1_us"), F.col("q3_us")
    return long.select(
        *ROUTE,
        "metric",
        us_to_seconds(q1).alias("q1"),
        us_to_seconds(q3).alias("q3"),
        ((5 * q1 - 3 * q3).cast("double") / F.lit(2 * _SEC)).alias("lower_fence"),
        ((5 * q3 - 3 * q1).cast("double") / F.lit(2 * _SEC)).alias("upper_fence"),
    )


def _beyond(m: str) -> Column:
    d = F.col(f"{m}_us")
    return d.isNotNull() & (2 * d > _twice_upper(m))


def _with_quartiles(durations_us: DataFrame, quartiles_us: DataFrame) -> DataFrame:
    return durations_us.join(F.broadcast(quartiles_us), ROUTE)


def normal_orders_us(durations_us: DataFrame, quartiles_us: DataFrame) -> DataFrame:
    """Orders whose every present fenced duration is within its route's upper fence."""
    anomalous = reduce(lambda a, b: a | b, [_beyond(m) for m in FENCED_METRICS])
    return _with_quartiles(durations_us, quartiles_us).where(~anomalous).select(*durations_us.columns)


def anomalous_orders_us(durations_us: DataFrame, quartiles_us: DataFrame) -> DataFrame:
    """Orders with some present fenced duration beyond its route's upper fence; quartiles attached."""
    anomalous = reduce(lambda a, b: a | b, [_beyond(m) for m in FENCED_METRICS])
    return _with_quartiles(durations_us, quartiles_us).where(anomalous)


def normal_orders(durations_us: DataFrame, quartiles_us: DataFrame) -> DataFrame:
    """Seconds form, sorted by route then ``created_at`` (ties by id)."""
    return to_seconds(normal_orders_us(durations_us, quartiles_us)).orderBy(
        *ROUTE, "created_at", "create_order_id"
    )


def anomalous_orders(durations_us: DataFrame, quartiles_us: DataFrame) -> DataFrame:
    """Seconds form with q1/q3 and lower/upper fences of the four fenced metrics."""
    a = anomalous_orders_us(durations_us, quartiles_us)
    fences = []
    for m in FENCED_METRICS:
        q1, q3 = F.col(f"q1_{m}_us"), F.col(f"q3_{m}_us")
        fences += [
            us_to_seconds(q1).alias(f"q1_{m}_duration"),
            us_to_seconds(q3).alias(f"q3_{m}_duration"),
            ((5 * q1 - 3 * q3).cast("double") / F.lit(2 * _SEC)).alias(f"{m}_lower_fence"),
            ((5 * q3 - 3 * q1).cast("double") / F.lit(2 * _SEC)).alias(f"{m}_upper_fence"),
        ]
    base = a.select(*ROUTE, "create_order_id", "created_at", *[f"{m}_us" for m in ALL_METRICS], *fences)
    return to_seconds(base).orderBy(*ROUTE, "created_at", "create_order_id")


def _exact_sum_parts(name: str) -> list[Column]:
    """A sum of non-negative microseconds as two long sums (whole seconds, remainder).

    Neither part can overflow a long at any realistic row count, unlike one sum
    of microseconds; the parts are joined exactly per route afterwards.
    """
    return [
        F.sum(F.expr(f"`_v_{name}` div {MICROS_PER_SECOND}")).alias(f"{name}_s"),
        F.sum(F.expr(f"`_v_{name}` % {MICROS_PER_SECOND}")).alias(f"{name}_r"),
        F.count(f"_v_{name}").alias(f"{name}_n"),
    ]


def _avg_seconds(name: str) -> Column:
    total = F.col(f"{name}_s").cast("decimal(38,0)") * MICROS_PER_SECOND + F.col(f"{name}_r").cast("decimal(38,0)")
    return F.when(F.col(f"{name}_n") > 0, total.cast("double") / F.col(f"{name}_n") / F.lit(_SEC))


def route_averages(normal_us: DataFrame) -> DataFrame:
    """Per route with normal orders: order count and the six average durations (seconds).

    The cobi_init average counts only orders that redeemed and never refunded,
    and is 0 (not NULL) when there is none.
    """
    picks = {m: F.col(f"{m}_us") for m in ALL_METRICS}
    return _route_averages_raw(normal_us, picks, F.col(REDEEMED_FLAG))


def _route_averages_raw(df: DataFrame, picks: dict[str, Column], completed: Column) -> DataFrame:
    vals = []
    for m in ALL_METRICS:
        v = F.when(completed, picks[m]) if m == "cobi_init" else picks[m]
        vals.append(v.alias(f"_v_{m}"))
    aggs = [F.count(F.lit(1)).alias("total_orders")]
    for m in ALL_METRICS:
        aggs += _exact_sum_parts(m)
    g = df.select(*ROUTE, *vals).groupBy(*ROUTE).agg(*aggs)
    cols = [*ROUTE, "total_orders"]
    for m in ALL_METRICS:
        a = _avg_seconds(m)
        if m == "cobi_init":
            a = F.coalesce(a, F.lit(0.0))
        cols.append(a.alias(f"avg_{m}_duration"))
    return g.select(*cols)


def route_matrix(averages: DataFrame, chains: tuple[str, ...] = SUPPORTED_CHAINS) -> DataFrame:
    """Every (source, destination) pair of the chain list, self-pairs included.

    Routes without normal orders get 0 orders and NULL averages. The grid is a
    literal of len(chains)^2 rows joined to the per-route averages.
    """
    spark = averages.sparkSession
    grid = spark.createDataFrame([(s, d) for s in chains for d in chains], "source_chain string, destination_chain string")
    j = grid.join(F.broadcast(averages), ROUTE, "left")
    return j.select(
        F.concat_ws("-", *ROUTE).alias("route"),
        *ROUTE,
        F.coalesce(F.col("total_orders"), F.lit(0).cast("long")).alias("total_orders"),
        *[F.col(f"avg_{m}_duration") for m in ALL_METRICS],
    )


def last_updated(final_orders: DataFrame) -> DataFrame:
    """Latest ``created_at`` among orders with some (block number, time) pair; ISO text.

    Ignores the window and the chain list; epoch start when nothing qualifies.
    """
    from ..config import EVENTS

    pair = reduce(lambda a, b: a | b, [F.col(f"{e}_block_number").isNotNull() & F.col(e).isNotNull() for e in EVENTS])
    return final_orders.where(pair).agg(F.max("created_at").alias("t")).select(
        F.coalesce(iso_utc("t"), F.lit("1970-01-01T00:00:00.000Z")).alias("last_updated")
    )


def orders_by_route(orders_seconds: DataFrame, with_thresholds: bool = False) -> DataFrame:
    """One JSON document row per order, keyed by route (``source-destination``).

    The service returned one object per route holding an array of its orders.
    A route can hold most orders, so the array is never built in one row: each
    order is its own row, and ``write_orders_by_route`` writes them route by
    route in ``created_at`` order.
    """
    d = F.struct(*[F.col(f"{m}_duration") for m in ALL_METRICS], F.col("overall_duration"))
    fields = [F.col("create_order_id"), iso_utc("created_at").alias("created_at"), d.alias("durations")]
    if with_thresholds:
        th = F.struct(
            *[
                F.struct(F.col(f"{m}_lower_fence").alias("lower"), F.col(f"{m}_upper_fence").alias("upper")).alias(
                    f"{m}_duration"
                )
                for m in FENCED_METRICS
            ]
        )
        fields.append(th.alias("thresholds"))
    return orders_seconds.select(
        F.concat_ws("-", *ROUTE).alias("route"),
        "create_order_id",
        iso_utc("created_at").alias("created_at"),
        F.to_json(F.struct(*fields), {"ignoreNullFields": "false"}).alias("order_json"),
    )


def write_orders_by_route(docs: DataFrame, path: str) -> None:
    """JSON lines, one folder per route, each file in ``created_at`` order.

    Range partitioning on (route, created_at) splits a busy route over many
    tasks instead of one.
    """
    (
        docs.repartitionByRange("route", "created_at", "create_order_id")
        .sortWithinPartitions("route", "created_at", "create_order_id")
        .select("route", "order_json")
        .write.mode("overwrite")
        .partitionBy("route")
        .text(path)
    )


def route_chunks(docs: DataFrame, chunk_rows: int, path: str) -> DataFrame:
    """The arrays of ``orders_by_route`` in numbered chunks: route, chunk (from 0), first_row, rows, orders_json.

    ``orders_json`` is a JSON array of at most ``chunk_rows`` orders; a route's
    chunks, one after the other, are the array that the service answered with.
    Rows are range-sorted once and written to ``path``, a fresh folder. A row's
    place in its route is its place in its partition and the number of the route's
    rows in the partitions before; these counts have a row for each route and
    partition that meet, at most as many as there are of both. No task gets a route.
    """
    order = ["route", "created_at", "create_order_id"]
    ranged = docs.select(*order, "order_json").repartitionByRange(*order).sortWithinPartitions(*order)
    number = F.monotonically_increasing_id()  # the partition, and the place in it
    ranged.withColumn("part", F.spark_partition_id()).withColumn("place", number).write.parquet(path)
    rows = docs.sparkSession.read.parquet(path)
    counts = rows.groupBy("route", "part").agg(F.count(F.lit(1)).alias("n"), F.min("place").alias("begin"))
    earlier = Window.partitionBy("route").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = counts.select("route", "part", "begin", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("base"))
    placed = rows.join(F.broadcast(bases), ["route", "part"]).withColumn("row", F.col("base") + F.col("place") - F.col("begin"))
    chunk = F.floor(F.col("row") / chunk_rows)
    gathered = placed.groupBy("route", chunk.alias("chunk")).agg(
        F.min("row").alias("first_row"), F.count(F.lit(1)).alias("rows"), F.array_sort(F.collect_list(F.struct("row", "order_json"))).alias("o")
    )
    texts = F.array_join(F.transform("o", lambda x: x["order_json"]), ",")
    return gathered.select("route", "chunk", "first_row", "rows", F.concat(F.lit("["), texts, F.lit("]")).alias("orders_json"))


def averages_document(last_updated_df: DataFrame, matrix: DataFrame, averages: DataFrame, fences: DataFrame) -> DataFrame:
    """The averages answer as one JSON text row: last_updated, averages and thresholds keyed by route.

    Thresholds are given for routes that have normal orders (rows of
    ``averages``) only, as the service did. Every input is bounded by the chain
    list (1 row, chains^2 routes, chains^2 x 4 fences), so gathering them into
    one row is bounded too. One aggregate over a tagged union builds it; entries
    are sorted by route.
    """
    opts = {"ignoreNullFields": "false"}
    avg_fields = ["total_orders", *[f"avg_{m}_duration" for m in ALL_METRICS]]
    avg_rows = matrix.select(
        F.lit("a").alias("kind"),
        F.col("route").alias("k"),
        F.to_json(F.struct(*avg_fields), opts).alias("v"),
    )
    entry = F.struct(
        F.col("metric"),
        F.to_json(F.struct(F.col("lower_fence").alias("lower"), F.col("upper_fence").alias("upper")), opts).alias("v"),
    )
    kept = fences.join(F.broadcast(averages.select(*ROUTE)), ROUTE, "left_semi")
    th_rows = kept.groupBy(*ROUTE).agg(F.array_sort(F.collect_list(entry)).alias("e")).select(
        F.lit("t").alias("kind"), F.concat_ws("-", *ROUTE).alias("k"), _object("e", "metric").alias("v")
    )
    lu_rows = last_updated_df.select(F.lit("l").alias("kind"), F.lit("").alias("k"), F.col("last_updated").alias("v"))
    tagged = avg_rows.unionByName(th_rows).unionByName(lu_rows)

    def entries(kind: str) -> Column:
        return F.array_sort(F.collect_list(F.when(F.col("kind") == kind, F.struct("k", "v")))).alias(kind)

    doc = tagged.agg(F.max(F.when(F.col("kind") == "l", F.col("v"))).alias("l"), entries("a"), entries("t"))
    parts = [F.lit('{"last_updated":"'), F.col("l"), F.lit('","averages":'), _object("a", "k")]
    parts += [F.lit(',"thresholds":'), _object("t", "k"), F.lit("}")]
    return doc.select(F.concat(*parts).alias("document"))


def _object(entries: str, key: str) -> Column:
    """A JSON object from (key, JSON text) entries."""
    texts = F.transform(entries, lambda e: F.concat(F.lit('"'), e[key], F.lit('":'), e["v"]))
    return F.concat(F.lit("{"), F.array_join(texts, ","), F.lit("}"))


def averages_by_route(matrix: DataFrame) -> DataFrame:
    """One row: ``map<route, struct<total_orders, six averages>>`` over the route grid.

    The grid has exactly len(chains)^2 rows, so the map is bounded by the chain
    list, not by the data. Entries are in route order.
    """
    entry = F.struct(
        F.col("route").alias("key"),
        F.struct("total_orders", *[f"avg_{m}_duration" for m in ALL_METRICS]).alias("value"),
    )
    return matrix.agg(F.map_from_entries(F.array_sort(F.collect_list(entry))).alias("averages"))
