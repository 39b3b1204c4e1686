"""The recurring sync-and-enrich job (the service ran it every 12 hours).

One run appends the settled orders that the table does not hold yet, then fills
missing event times from the lookup tables and replaces the months in which it
found one. The anti join of the append reads only months that hold a new
candidate; the search for missing times reads open rows only. With ``since``, the
time of the last run, only orders with something changed since then are settled.

A failed run leaves the table as it was before the step that failed, and can be
repeated: it stores no order twice. Two runs must not overlap, as in the
original service, whose scheduler skipped a run while another was at work.

This is a batch job on purpose: swaps change after they are first seen (redeems
and refunds arrive later). An append-only stream joined to static swaps would
never revisit a match that was not settled when it arrived.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import COMPRESSION
from ..functions.columns import missing_time_gate
from ..operators import enrich, settle
from ..sources import store
from ..sources.fixtures import Sources
from ..sources.lookups import Lookups
from .pipelines import work_folder


def _written(df: DataFrame, path: str) -> DataFrame:
    df.write.option("compression", COMPRESSION).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def candidates(spark: SparkSession, sources: Sources, work: str, since=None) -> DataFrame:
    """The storable settled orders, one row each, written to ``work``; with ``since`` of orders changed since then."""
    tables = (sources.create_orders, sources.matched_orders, sources.swaps)
    if since is None:
        settled = settle.settled_orders(*tables)
    else:
        settled = settle.settled_changes(*tables, _written(settle.changed_orders(*tables, since), f"{work}/changed"))
    return _written(settle.append_new_orders(settled, None), f"{work}/settled")


def not_stored(spark: SparkSession, found: DataFrame, root: str) -> DataFrame:
    """The candidates whose order the table does not hold.

    An order's ``created_at`` is its own and never changes, so only the months
    that hold a candidate are read. Candidates of months without a stored row are
    all new and meet no join.
    """
    held = store.stored_months(spark, root, store.months_of(found))
    if not held:
        return found
    month = store.month_of("created_at")
    among = F.coalesce(month.isin(held), F.lit(True))
    stored = store.read_months(spark, root, held).select("create_order_id")
    return found.where(among).join(stored, "create_order_id", "left_anti").unionByName(found.where(~among))


def sync(spark: SparkSession, sources: Sources, root: str, since=None) -> DataFrame:
    """Append the settled orders that are not stored yet; returns the table."""
    store.ensure_table(spark, root)
    found = candidates(spark, sources, work_folder(spark), since)
    store.write_orders(not_stored(spark, found, root), root)
    return store.read_orders_table(spark, root)


def enrich_months(spark: SparkSession, lookups: Sources | Lookups, root: str) -> DataFrame:
    """Fill missing event times; replaces only months that hold an order with a time found for it."""
    work = work_folder(spark)
    store.ensure_table(spark, root)
    waiting = store.read_orders_table(spark, root, only_open=True).where(missing_time_gate())
    resolved = enrich.resolve_all(enrich.lookup_requests(waiting), lookups.blocks, lookups.transactions, f"{work}/requests")
    found = _written(resolved.where(F.col("block_time").isNotNull()), f"{work}/found")
    touched = store.months_of(waiting.join(found, "create_order_id", "left_semi"))
    if touched:
        rows = enrich.enriched_orders(store.read_months(spark, root, touched), found)
        store.replace_months(spark, rows, touched, root, f"{work}/staging")
    return store.read_orders_table(spark, root)


def run_once(spark: SparkSession, sources: Sources, root: str, since=None, lookups: Lookups | None = None) -> DataFrame:
    """Sync, then enrich the stored rows; returns the table. ``lookups``: bucketed ones, instead of those of ``sources``."""
    sync(spark, sources, root, since)
    return enrich_months(spark, lookups or sources, root)
