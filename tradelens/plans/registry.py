"""Registered queries: one per user-level operator, each ``(spark, sf_dir) -> DataFrame``.

Inputs are the given ``orders`` table projected into the service's source
tables (``sources.fixtures``); the analysis table is built from them by the
same settle + enrich plan the sync job runs, so every query's work grows with
the data. Timestamps are rendered as ISO-8601 text (``...T..:..:..sssZ``), the
form the service answered with, and nested rows are flattened.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import replace
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..config import COMPRESSION, SUPPORTED_CHAINS
from ..functions.columns import instant, iso_utc
from ..operators import browse, enrich, routes, settle
from ..operators import durations as dur
from ..sources.fixtures import Sources, derive_sources
from ..session import checkpoint_dir
from ..sources import store
from ..sources.lookups import Lookups, write_lookups
from ..operators.durations import parse_window
from . import duration_store, scheduled_sync
from .pipelines import Analysis, EnrichmentRun, analysis, enrichment, new_orders, work_folder

# Fixed query parameters: the analysis window, an earlier sync's cut-off, and two pages.
WINDOW_START = "1996-01-01"
WINDOW_END = "1999-12-31"
EARLIER_SYNC_BEFORE = "1998-01-01"
WINDOW_INSIDE = ("1994-03-15T10:00:00", "1997-10-20T12:30:00")
CHUNK_ROWS = 50
#: A cut inside a month between two runs of the sync job, and the time at which a report without a window is asked for.
JOB_BEFORE = "1997-06-15T08:00:00"
ASKED_AT = "1998-06-30T12:00:00"
PAGE_ALL = (1, 10)
PAGE_SUCCESSFUL = (2, 20)
PAGE_DEEP = (500, 20)
PAGE_TIED = (40, 15)
#: Days that share one time in the page inside a tied time.
TIED_DAYS = 1000


def api_view(df: DataFrame) -> DataFrame:
    """Timestamps as ISO text; everything else unchanged."""
    return df.select(
        *[
            iso_utc(f.name).alias(f.name) if isinstance(f.dataType, T.TimestampType) else F.col(f.name)
            for f in df.schema.fields
        ]
    )


def flat_page(page: DataFrame) -> DataFrame:
    """Nested page rows flattened to prefixed columns."""
    cols = [F.col("row_no"), F.col("created_at"), F.col("updated_at"), F.col("deleted_at")]
    for struct_name, prefix in (("create_order", "co"), ("source_swap", "ss"), ("destination_swap", "ds")):
        fields = page.schema[struct_name].dataType.fields
        cols += [F.col(f"{struct_name}.{f.name}").alias(f"{prefix}_{f.name}") for f in fields]
    return api_view(page.select(*cols))


class _State:
    """The service's tables for one (application, data folder, content of the input).

    The source tables, the analysis table after the sync (``stored``) and after
    enrichment (``enriched``) are written to a fresh folder of the shared
    checkpoint directory when a query first needs them, as the service's
    databases hold them. Nothing is found there by name: another application,
    or the same one after the input's files have changed, writes its own.
    """

    def __init__(self, spark: SparkSession, sf_dir: str, base: str | None = None):
        self.spark = spark
        self.sf_dir = sf_dir
        self.base = base or f"{checkpoint_dir(spark).rstrip('/')}/tradelens-{uuid.uuid4().hex}"
        self.window = parse_window(WINDOW_START, WINDOW_END)

    @cached_property
    def derived(self) -> Sources:
        return derive_sources(self.spark, self.sf_dir)

    def _written(self, *names: str) -> dict[str, DataFrame]:
        tables = {}
        for name in names:
            path = f"{self.base}/{name}"
            getattr(self.derived, name).write.option("compression", COMPRESSION).parquet(path)
            tables[name] = self.spark.read.parquet(path)
        return tables

    @cached_property
    def book(self) -> Sources:
        """The order book's tables as written; blocks and transactions, which ``lookups`` hold, are left as they are derived."""
        return replace(self.derived, **self._written("create_orders", "matched_orders", "swaps"))

    @cached_property
    def src(self) -> Sources:
        """All source tables as written."""
        return replace(self.book, **self._written("blocks", "transactions"))

    @cached_property
    def lookups(self) -> Lookups:
        """The lookup tables in buckets, as recurring runs read them."""
        name = f"tradelens_{uuid.uuid4().hex}"
        return write_lookups(self.spark, self.derived.blocks, self.derived.transactions, f"{self.base}/lookups", name)

    @cached_property
    def stored(self) -> DataFrame:
        """The analysis table after one sync into an empty table."""
        path = f"{self.base}/final_orders_synced"
        store.write_orders(new_orders(self.book, existing=None), path, "errorifexists")
        return store.read_orders_table(self.spark, path)

    @cached_property
    def run(self) -> EnrichmentRun:
        return enrichment(self.stored, self.lookups, f"{self.base}/enrichment")

    @cached_property
    def enriched_path(self) -> str:
        path = f"{self.base}/final_orders_enriched"
        store.write_snapshot(*enrich.enriched_parts(self.stored, self.run.resolved), path)
        return path

    @property
    def enriched(self) -> DataFrame:
        """The analysis table after one enrichment pass (a new snapshot)."""
        return store.read_orders_table(self.spark, self.enriched_path)

    @cached_property
    def durations_path(self) -> str:
        """Durations, values and histograms by month, as every enrichment refreshes them."""
        path = f"{self.base}/durations_by_month"
        duration_store.refresh(self.enriched, path)
        return path

    @cached_property
    def an(self) -> Analysis:
        pruned = store.read_orders_table(self.spark, self.enriched_path, *self.window)
        return analysis(pruned, WINDOW_START, WINDOW_END, work=f"{self.base}/analysis")


def input_signature(spark: SparkSession, sf_dir: str) -> tuple:
    """Path, length and modification time of every file of the input table."""
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(f"{sf_dir}/orders.parquet")
    files = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).listFiles(path, True)
    out = []
    while files.hasNext():
        f = files.next()
        out.append((f.getPath().toString(), f.getLen(), f.getModificationTime()))
    return tuple(sorted(out))


_STATES: dict[tuple[str, str], tuple[tuple, _State]] = {}


def state(spark: SparkSession, sf_dir: str, base: str | None = None) -> _State:
    """The tables for ``sf_dir`` as its files are now; ``base`` picks (and replaces) the folder they are written to."""
    key, signature = (spark.sparkContext.applicationId, sf_dir), input_signature(spark, sf_dir)
    known = _STATES.get(key)
    if known is None or known[0] != signature or (base is not None and known[1].base != base):
        _STATES[key] = signature, _State(spark, sf_dir, base)
    return _STATES[key][1]


def q_settled_orders(spark, sf_dir):
    s = state(spark, sf_dir).book
    return api_view(settle.settled_orders(s.create_orders, s.matched_orders, s.swaps))


def q_append_new_orders(spark, sf_dir):
    st = state(spark, sf_dir)
    candidates = settle.settled_orders(st.book.create_orders, st.book.matched_orders, st.book.swaps)
    earlier = settle.first_per_order(
        candidates.where(F.col("created_at") < instant(parse_window(EARLIER_SYNC_BEFORE)[0]))
    )
    return api_view(settle.append_new_orders(candidates, earlier))


def q_settled_changes(spark, sf_dir):
    s = state(spark, sf_dir).book
    tables = (s.create_orders, s.matched_orders, s.swaps)
    changed = settle.changed_orders(*tables, parse_window(EARLIER_SYNC_BEFORE)[0])
    return api_view(settle.settled_changes(*tables, changed))


def _two_runs(spark, sf_dir, job: Callable[..., DataFrame]) -> DataFrame:
    """``job(sources, folder, since)`` on a table that does not exist yet, with the orders before a cut; then on all that changed since."""
    src, folder, cut = state(spark, sf_dir).book, f"{work_folder(spark)}/final_orders", parse_window(JOB_BEFORE)[0]
    job(replace(src, create_orders=src.create_orders.where(F.col("created_at") < instant(cut))), folder, None)
    return api_view(job(src, folder, cut))


def q_synced_orders(spark, sf_dir):
    """The analysis table after a sync that creates it and an incremental one."""
    return _two_runs(spark, sf_dir, lambda src, folder, since: scheduled_sync.sync(spark, src, folder, since))


def q_sync_job(spark, sf_dir):
    """The analysis table after two runs of the whole job, which store orders and replace months with their times."""
    lookups = state(spark, sf_dir).lookups
    return _two_runs(spark, sf_dir, lambda src, folder, since: scheduled_sync.run_once(spark, src, folder, since, lookups))


def q_rejected_candidates(spark, sf_dir):
    """What the table refuses, with chains that are not supported taken as missing."""
    s = state(spark, sf_dir).book
    candidates = settle.settled_orders(s.create_orders, s.matched_orders, s.swaps)
    for side in ("source_chain", "destination_chain"):
        candidates = candidates.withColumn(side, F.when(F.col(side).isin(list(SUPPORTED_CHAINS)), F.col(side)))
    return settle.rejected(candidates).withColumn("missing", F.array_join("missing", ","))


def q_orders_table_schema(spark, sf_dir):
    return settle.table_profile(state(spark, sf_dir).enriched)


def q_timestamp_candidates(spark, sf_dir):
    return enrich.timestamp_candidates(store.read_orders_table(spark, state(spark, sf_dir).enriched_path, only_open=True))


def q_lookup_requests(spark, sf_dir):
    return state(spark, sf_dir).run.requests


def q_resolve_by_block(spark, sf_dir):
    st = state(spark, sf_dir)
    return enrich.resolve_by_block(st.run.requests, st.lookups.blocks)


def q_resolve_by_transaction(spark, sf_dir):
    st = state(spark, sf_dir)
    return enrich.resolve_by_transaction(st.run.requests, st.lookups.transactions, st.lookups.blocks)


def q_resolve_bitcoin(spark, sf_dir):
    st = state(spark, sf_dir)
    return enrich.resolve_bitcoin(st.run.requests, st.lookups.transactions, st.lookups.blocks)


def q_enriched_orders(spark, sf_dir):
    # the enrichment plan itself, over the synced table (not the stored snapshot)
    return api_view(state(spark, sf_dir).run.enriched)


def q_enrichment_report(spark, sf_dir):
    return state(spark, sf_dir).run.report


def q_enrichment_summary(spark, sf_dir):
    return enrich.enrichment_summary(state(spark, sf_dir).run.report)


def q_event_time_display(spark, sf_dir):
    return enrich.event_time_display(state(spark, sf_dir).run.resolved)


def q_order_durations(spark, sf_dir):
    return api_view(dur.to_seconds(state(spark, sf_dir).an.durations_us))


def q_default_window_durations(spark, sf_dir):
    """Durations of the window that a report without dates covers, asked for at ``ASKED_AT``."""
    start, end = parse_window(None, "", now=parse_window(ASKED_AT)[0])
    pruned = store.read_orders_table(spark, state(spark, sf_dir).enriched_path, start, end)
    return api_view(dur.order_durations(pruned, start.isoformat(), end.isoformat()))


def q_route_metric_counts(spark, sf_dir):
    return state(spark, sf_dir).an.counts


def q_route_quartiles(spark, sf_dir):
    return routes.route_quartiles(state(spark, sf_dir).an.quartiles_us)


def q_route_fences(spark, sf_dir):
    return routes.route_fences(state(spark, sf_dir).an.quartiles_us)


def q_normal_orders(spark, sf_dir):
    an = state(spark, sf_dir).an
    return api_view(routes.normal_orders(an.durations_us, an.quartiles_us))


def q_anomalous_orders(spark, sf_dir):
    an = state(spark, sf_dir).an
    return api_view(routes.anomalous_orders(an.durations_us, an.quartiles_us))


def q_route_averages(spark, sf_dir):
    return routes.route_averages(state(spark, sf_dir).an.normal_us)


def q_route_matrix(spark, sf_dir):
    return routes.route_matrix(routes.route_averages(state(spark, sf_dir).an.normal_us))


def q_last_updated(spark, sf_dir):
    return routes.last_updated(state(spark, sf_dir).enriched)


def q_orders_by_route(spark, sf_dir):
    an = state(spark, sf_dir).an
    return routes.orders_by_route(routes.normal_orders(an.durations_us, an.quartiles_us))


def q_anomalies_by_route(spark, sf_dir):
    an = state(spark, sf_dir).an
    return routes.orders_by_route(routes.anomalous_orders(an.durations_us, an.quartiles_us), with_thresholds=True)


def q_route_chunks(spark, sf_dir):
    st = state(spark, sf_dir)
    docs = routes.orders_by_route(routes.normal_orders(st.an.durations_us, st.an.quartiles_us))
    return routes.route_chunks(docs, CHUNK_ROWS, f"{work_folder(spark)}/by-route")


def q_window_quartiles(spark, sf_dir):
    return routes.route_quartiles(duration_store.window_quartiles_us(spark, state(spark, sf_dir).durations_path, *WINDOW_INSIDE))


def q_matched_orders_page(spark, sf_dir):
    s = state(spark, sf_dir).book
    return flat_page(browse.matched_orders_page(s.matched_orders, s.create_orders, s.swaps, *PAGE_ALL))


def q_matched_orders_default_page(spark, sf_dir):
    """The page that is answered where none is asked for (0 and a missing size take the defaults)."""
    s = state(spark, sf_dir).book
    return flat_page(browse.matched_orders_page(s.matched_orders, s.create_orders, s.swaps, 0, None))


def q_successful_matched_orders_page(spark, sf_dir):
    s = state(spark, sf_dir).book
    return flat_page(browse.successful_matched_orders_page(s.matched_orders, s.create_orders, s.swaps, *PAGE_SUCCESSFUL))


def q_matched_orders_deep_page(spark, sf_dir):
    s = state(spark, sf_dir).book
    return flat_page(browse.matched_orders_page(s.matched_orders, s.create_orders, s.swaps, *PAGE_DEEP))


def q_tied_matches_page(spark, sf_dir):
    """A page of matches that share their time with many others, as after a bulk import."""
    s = state(spark, sf_dir).book
    us = F.unix_micros("created_at")
    tied = s.matched_orders.withColumn("created_at", F.timestamp_micros(us - F.pmod(us, F.lit(TIED_DAYS * 86_400_000_000))))
    return flat_page(browse.matched_orders_page(tied, s.create_orders, s.swaps, *PAGE_TIED))


def q_page_info(spark, sf_dir):
    return browse.page_info(state(spark, sf_dir).book.matched_orders, *PAGE_ALL)


def q_listable_items(spark, sf_dir):
    s = state(spark, sf_dir).book
    return browse.listable_items(s.matched_orders, s.create_orders, s.swaps)


def q_matched_page_document(spark, sf_dir):
    s = state(spark, sf_dir).book
    page = browse.matched_orders_page(s.matched_orders, s.create_orders, s.swaps, *PAGE_ALL)
    return browse.page_document(page, browse.page_info(s.matched_orders, *PAGE_ALL))


def q_lookup_requests_by_id(spark, sf_dir):
    stored = state(spark, sf_dir).stored
    return enrich.lookup_requests(stored, enrich.timestamp_candidates(stored))


def q_averages_by_route(spark, sf_dir):
    grid = routes.route_matrix(routes.route_averages(state(spark, sf_dir).an.normal_us))
    return routes.averages_by_route(grid).select(F.to_json("averages", {"ignoreNullFields": "false"}).alias("averages"))


def q_averages_document(spark, sf_dir):
    st = state(spark, sf_dir)
    averages = routes.route_averages(st.an.normal_us)
    last = routes.last_updated(st.enriched)
    return routes.averages_document(last, routes.route_matrix(averages), averages, routes.route_fences(st.an.quartiles_us))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "settled_orders": q_settled_orders,
    "append_new_orders": q_append_new_orders,
    "settled_changes": q_settled_changes,
    "synced_orders": q_synced_orders,
    "sync_job": q_sync_job,
    "rejected_candidates": q_rejected_candidates,
    "orders_table_schema": q_orders_table_schema,
    "timestamp_candidates": q_timestamp_candidates,
    "lookup_requests": q_lookup_requests,
    "resolve_by_block": q_resolve_by_block,
    "resolve_by_transaction": q_resolve_by_transaction,
    "resolve_bitcoin": q_resolve_bitcoin,
    "enriched_orders": q_enriched_orders,
    "enrichment_report": q_enrichment_report,
    "enrichment_summary": q_enrichment_summary,
    "event_time_display": q_event_time_display,
    "order_durations": q_order_durations,
    "default_window_durations": q_default_window_durations,
    "route_metric_counts": q_route_metric_counts,
    "route_quartiles": q_route_quartiles,
    "route_fences": q_route_fences,
    "normal_orders": q_normal_orders,
    "anomalous_orders": q_anomalous_orders,
    "route_averages": q_route_averages,
    "route_matrix": q_route_matrix,
    "last_updated": q_last_updated,
    "orders_by_route": q_orders_by_route,
    "anomalies_by_route": q_anomalies_by_route,
    "route_chunks": q_route_chunks,
    "window_quartiles": q_window_quartiles,
    "matched_orders_page": q_matched_orders_page,
    "matched_orders_default_page": q_matched_orders_default_page,
    "successful_matched_orders_page": q_successful_matched_orders_page,
    "tied_matches_page": q_tied_matches_page,
    "page_info": q_page_info,
    "matched_orders_deep_page": q_matched_orders_deep_page,
    "listable_items": q_listable_items,
    "matched_page_document": q_matched_page_document,
    "lookup_requests_by_id": q_lookup_requests_by_id,
    "averages_by_route": q_averages_by_route,
    "averages_document": q_averages_document,
}
