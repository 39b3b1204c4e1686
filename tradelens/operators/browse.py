"""Paginated, nested matched orders, newest first.

First pages (``FIRST_ROWS`` rows of the listing and less) are found progressively:
the newest matches, about twice as many as are needed, are looked up by
broadcasting their ids to one narrow scan of the orders and the swaps; only if
too few of them can be listed are the next, older ones looked up too. Nothing
is shuffled but these few, and the listing is never built.

For deeper pages the listable matches are written once as narrow rows, each
with the number of its copies. Either way the page's rows are found by counting
(``ranking``), also inside one tied time, so no task gathers the rows before the
page. They are then unpivoted to their swap ids and broadcast to one scan of the
wide swaps and one of the wide orders, which are never shuffled.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import DEFAULT_PAGE, DEFAULT_PER_PAGE
from ..functions.columns import instant, iso_utc, present
from ..session import checkpoint_dir
from .durations import parse_window
from .ranking import find_place, numbered, rows_at, text_key, time_key

#: Listed rows up to which pages are found progressively, and the matches that are looked up for that at most.
FIRST_ROWS = 1_000
_MOST_CANDIDATES = 128 * FIRST_ROWS
_WIDER = 8
MATCH = ["create_order_id", "source_swap_id", "destination_swap_id", "created_at", "updated_at", "deleted_at"]


#: Newest first (NULL times first, as the original database sorted), ties by ids, and equal ones by the other times.
_ORDER = ["_age", "_order_id", "_source_id", "_destination_id", "_updated", "_deleted"]


def _ordered(keys: DataFrame, newest: int | None) -> DataFrame:
    """``keys`` with the columns of ``_ORDER``; ``newest``: the largest ``created_at`` in microseconds."""
    age = F.coalesce(F.lit(newest).cast("long") - F.unix_micros("created_at") + 1, F.lit(0).cast("long"))
    ids = [text_key(c) for c in ("create_order_id", "source_swap_id", "destination_swap_id")]
    columns = [age, *ids, time_key("updated_at"), time_key("deleted_at")]
    return keys.select("*", *[c.alias(k) for c, k in zip(columns, _ORDER)])


def page_args(page: int | None = None, per_page: int | None = None) -> tuple[int, int]:
    """0 or missing -> defaults (1, 10); negative -> ``ValueError`` (the service answered 400)."""
    page = int(page) if page else DEFAULT_PAGE
    per_page = int(per_page) if per_page else DEFAULT_PER_PAGE
    if page < 1 or per_page < 1:
        raise ValueError(f"pages are counted from 1 and hold at least one row: page={page}, per_page={per_page}")
    return page, per_page


def listable_matches(
    matched_orders: DataFrame,
    create_orders: DataFrame,
    swaps: DataFrame,
    successful: bool = False,
    created_before=None,
) -> DataFrame:
    """Matches that have their order and both swaps (and, if asked, both legs initiated and redeemed).

    Both legs of a match meet ``swaps`` in one join and are folded back; a match
    that is stored several times is listed as often.
    """
    counted = _listable(_matches(matched_orders, created_before), create_orders, swaps, successful)
    return counted.select(*MATCH, F.explode(F.sequence(F.lit(1), F.col("copies").cast("int")))).select(*MATCH)


def _matches(matched_orders: DataFrame, created_before=None) -> DataFrame:
    keys = matched_orders.select(*MATCH)
    if created_before is not None:
        keys = keys.where(F.col("created_at") < instant(parse_window(str(created_before))[0]))
    return keys


def _finished(swaps: DataFrame, successful: bool) -> DataFrame:
    if successful:
        swaps = swaps.where(present("initiate_tx_hash") & present("redeem_tx_hash"))
    return swaps.select("swap_id")


def _legs(source: Column, destination: Column) -> Column:
    """One row per leg of a match: which it is, and its swap."""
    return F.inline(
        F.array(
            F.struct(source.alias("s"), (1 - source).alias("d"), F.col("source_swap_id").alias("swap_id")),
            F.struct((1 - destination).alias("s"), destination.alias("d"), F.col("destination_swap_id").alias("swap_id")),
        )
    )


def _listable(keys: DataFrame, create_orders: DataFrame, swaps: DataFrame, successful: bool) -> DataFrame:
    """The distinct matches that can be listed, with their ``copies``."""
    one = F.lit(1)
    met = keys.select(*MATCH, _legs(one, one)).join(_finished(swaps, successful), "swap_id", "left_semi")
    whole = met.groupBy(*MATCH).agg(F.sum("s").alias("s"), F.sum("d").alias("d")).where("s > 0 AND d > 0")
    whole = whole.join(
        create_orders.select(F.col("create_id").alias("create_order_id")), "create_order_id", "left_semi"
    )
    return whole.select(*MATCH, F.least("s", "d").alias("copies"))


def _looked_up(keys: DataFrame, create_orders: DataFrame, swaps: DataFrame, successful: bool) -> DataFrame:
    """As ``_listable`` for a few matches with ``copies``: their ids are broadcast, the large tables only scanned."""
    ids = F.explode(F.array("source_swap_id", "destination_swap_id")).alias("swap_id")
    swap_ids = _finished(swaps, successful).join(F.broadcast(keys.select(ids).distinct()), "swap_id", "left_semi").distinct()
    orders = create_orders.select(F.col("create_id").alias("create_order_id"))
    order_ids = orders.join(F.broadcast(keys.select("create_order_id").distinct()), "create_order_id", "left_semi").distinct()
    for side in ("source_swap_id", "destination_swap_id"):
        keys = keys.join(F.broadcast(swap_ids.withColumnRenamed("swap_id", side)), side, "left_semi")
    return keys.join(F.broadcast(order_ids), "create_order_id", "left_semi").select(*MATCH, "copies")


def _first_listed(
    matches: DataFrame, create_orders: DataFrame, swaps: DataFrame, successful: bool, wanted: int, folder: str
) -> tuple[DataFrame, int | None] | None:
    """At least the ``wanted`` first rows of the listing (all, if there are fewer), and the newest time; None if too many would be looked up."""
    spark = matches.sparkSession
    every = matches.agg(F.count(F.lit(1)).alias("n"), F.max(F.unix_micros("created_at")).alias("newest")).first()
    rows = _ordered(matches.withColumn("copies", F.lit(1).cast("long")), every["newest"])
    reach, last, listed, paths = 2 * wanted, None, 0, []
    while reach <= _MOST_CANDIDATES:
        part = rows if last is None else rows.where(~last.upto(_ORDER))
        if reach < every["n"]:
            last = find_place(rows, _ORDER, reach, wanted, "copies")
            part = part.where(last.upto(_ORDER))
        paths.append(f"{folder}/first-{len(paths)}")
        few = part.groupBy(*MATCH).agg(F.sum("copies").alias("copies"))
        few.write.parquet(f"{paths[-1]}-candidates")
        few = spark.read.schema(few.schema).parquet(f"{paths[-1]}-candidates")
        found = _looked_up(few, create_orders, swaps, successful)
        found.write.parquet(paths[-1])
        listed += spark.read.schema(found.schema).parquet(paths[-1]).agg(F.coalesce(F.sum("copies"), F.lit(0))).first()[0]
        if listed >= wanted or reach >= every["n"]:
            return spark.read.schema(found.schema).parquet(*paths), every["newest"]
        reach *= _WIDER
    return None


def _page_rows(matches: DataFrame, create_orders: DataFrame, swaps: DataFrame, successful: bool, offset: int, per_page: int) -> DataFrame:
    """The rows of ranks offset + 1 to offset + per_page, with ``row_no``."""
    spark = matches.sparkSession
    folder = f"{checkpoint_dir(spark).rstrip('/')}/tradelens-{uuid.uuid4().hex}"
    first = None
    if offset + per_page <= FIRST_ROWS:
        first = _first_listed(matches, create_orders, swaps, successful, offset + per_page, folder)
    last = offset + per_page
    if first is not None:
        keys, newest = first  # as many rows as were looked up, at most
        return numbered(_ordered(keys, newest), _ORDER, offset + 1, last, "copies", "row_no").drop(*_ORDER)
    whole = _listable(matches, create_orders, swaps, successful)
    whole.write.parquet(f"{folder}/listable")
    keys = spark.read.schema(whole.schema).parquet(f"{folder}/listable")
    every = keys.agg(F.coalesce(F.sum("copies"), F.lit(0)).alias("n"), F.max(F.unix_micros("created_at")).alias("newest")).first()
    if every["n"] <= offset:
        return keys.limit(0).withColumn("row_no", F.lit(0).cast("long"))
    return rows_at(_ordered(keys, every["newest"]), _ORDER, offset + 1, min(every["n"], last), "copies", "row_no").drop(*_ORDER)


def matched_orders_page(
    matched_orders: DataFrame,
    create_orders: DataFrame,
    swaps: DataFrame,
    page: int | None = None,
    per_page: int | None = None,
    successful: bool = False,
    created_before=None,
) -> DataFrame:
    """One page: ``row_no``, the match's times, and the nested create order and both swaps."""
    page, per_page = page_args(page, per_page)
    matches = _matches(matched_orders, created_before)
    top = _page_rows(matches, create_orders, swaps, successful, (page - 1) * per_page, per_page)

    # The broadcasts hold the page's rows and their swap ids: per_page and twice per_page rows.
    legs = F.array(
        F.struct(F.lit(True).alias("is_source"), F.col("source_swap_id").alias("swap_id")),
        F.struct(F.lit(False).alias("is_source"), F.col("destination_swap_id").alias("swap_id")),
    )
    ids = top.select("row_no", F.inline(legs))
    found = swaps.select("swap_id", F.struct("*").alias("swap")).join(F.broadcast(ids), "swap_id")
    both = found.groupBy("row_no").agg(
        F.max(F.when(F.col("is_source"), F.col("swap"))).alias("source_swap"),
        F.max(F.when(~F.col("is_source"), F.col("swap"))).alias("destination_swap"),
    )
    orders = create_orders.select(F.col("create_id").alias("create_order_id"), F.struct("*").alias("create_order"))
    out = orders.join(F.broadcast(top), "create_order_id").join(F.broadcast(both), "row_no")
    return out.select(
        "row_no", "created_at", "updated_at", "deleted_at", "source_swap", "destination_swap", "create_order"
    ).orderBy("row_no")


def successful_matched_orders_page(
    matched_orders: DataFrame,
    create_orders: DataFrame,
    swaps: DataFrame,
    page: int | None = None,
    per_page: int | None = None,
) -> DataFrame:
    """As ``matched_orders_page``, only matches whose both legs were initiated and redeemed."""
    return matched_orders_page(matched_orders, create_orders, swaps, page, per_page, successful=True)


def page_info(matched_orders: DataFrame, page: int | None = None, per_page: int | None = None) -> DataFrame:
    """One row: page, per_page, total_items and total_pages.

    ``total_items`` counts every match, as the service did, whatever the joins
    and filters keep (``listable_items`` counts what the pages list).
    """
    page, per_page = page_args(page, per_page)
    return matched_orders.agg(F.count(F.lit(1)).alias("total_items")).select(
        F.lit(page).alias("page"),
        F.lit(per_page).alias("per_page"),
        "total_items",
        F.ceil(F.col("total_items") / F.lit(per_page)).cast("long").alias("total_pages"),
    )


def listable_items(
    matched_orders: DataFrame, create_orders: DataFrame, swaps: DataFrame, successful: bool = False
) -> DataFrame:
    """One row: how many matches the pages list."""
    counted = _listable(_matches(matched_orders), create_orders, swaps, successful)
    return counted.agg(F.coalesce(F.sum("copies"), F.lit(0)).alias("listable_items"))


def _iso_struct(name: str, schema) -> Column:
    """A nested row with its times as ISO text."""
    fields = [
        (iso_utc(F.col(name)[f.name]) if f.dataType.typeName() == "timestamp" else F.col(name)[f.name]).alias(f.name)
        for f in schema[name].dataType.fields
    ]
    return F.struct(*fields).alias(name)


def page_document(page_df: DataFrame, info: DataFrame) -> DataFrame:
    """The page answer as one JSON text: data (nested rows in page order), page, per_page, total_items, total_pages.

    Bounded by the page size. NULL fields are kept.
    """
    nested = [_iso_struct(n, page_df.schema) for n in ("source_swap", "destination_swap", "create_order")]
    times = [iso_utc(c).alias(c) for c in ("created_at", "updated_at", "deleted_at")]
    rows = page_df.select("row_no", F.struct(*times, *nested).alias("row"))
    # One aggregate over the page's rows and the info row.
    counts = ["page", "total_pages", "total_items", "per_page"]
    both = rows.unionByName(info.select(*counts), allowMissingColumns=True)
    listed = F.array_sort(F.collect_list(F.when(F.col("row_no").isNotNull(), F.struct("row_no", "row"))))
    whole = both.agg(F.transform(listed, lambda r: r["row"]).alias("data"), *[F.max(c).alias(c) for c in counts])
    return whole.select(F.to_json(F.struct("data", *counts), {"ignoreNullFields": "false"}).alias("document"))
