"""End-to-end plans: the sync job (settle + append + enrich) and the analysis report.

What is read more than once is written once to the shared checkpoint directory.
The driver collects quartiles only (at most one row per route, metric and quartile).
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from ..config import COMPRESSION, SUPPORTED_CHAINS
from ..operators import durations as dur
from ..operators import enrich, quantiles, routes, settle
from ..session import checkpoint_dir
from ..sources import store
from ..sources.fixtures import Sources
from ..sources.lookups import Lookups


def work_folder(spark: SparkSession) -> str:
    """A fresh folder in the shared checkpoint directory, for a run's intermediate tables."""
    return f"{checkpoint_dir(spark).rstrip('/')}/tradelens-{uuid.uuid4().hex}"


@dataclass(frozen=True)
class EnrichmentRun:
    requests: DataFrame
    resolved: DataFrame
    enriched: DataFrame
    report: DataFrame


def new_orders(sources: Sources, existing: DataFrame | None) -> DataFrame:
    """Settled orders not stored yet (one per order)."""
    candidates = settle.settled_orders(sources.create_orders, sources.matched_orders, sources.swaps)
    return settle.append_new_orders(candidates, existing)


def enrichment(final_orders: DataFrame, sources: Sources | Lookups, work: str | None = None) -> EnrichmentRun:
    """The enrichment plans. With ``work``, a fresh folder, the requests are written there once.

    ``sources`` holds the lookups as they came or in bucketed form.
    """
    requests = enrich.lookup_requests(final_orders)
    if work is not None:
        requests.write.option("compression", COMPRESSION).parquet(f"{work}/requests")
        requests = requests.sparkSession.read.schema(requests.schema).parquet(f"{work}/requests")
    resolved = enrich.resolve_all(requests, sources.blocks, sources.transactions, work and f"{work}/staged")
    return EnrichmentRun(
        requests=requests,
        resolved=resolved,
        enriched=enrich.enriched_orders(final_orders, resolved),
        report=enrich.enrichment_report(final_orders, resolved),
    )


def enrich_store(spark: SparkSession, sources: Sources, table_path: str, snapshot_path: str) -> DataFrame:
    """Fill timestamps; writes the updated table to a new snapshot path (never the one read)."""
    if snapshot_path.rstrip("/") == table_path.rstrip("/"):
        raise ValueError("enrichment must write a new snapshot, not the table it reads")
    table = store.read_orders_table(spark, table_path)
    run = enrichment(table, sources, work_folder(spark))
    store.write_snapshot(*enrich.enriched_parts(table, run.resolved), snapshot_path)
    return store.read_orders_table(spark, snapshot_path)


def read_window(spark: SparkSession, table_path: str, start_time=None, end_time=None) -> DataFrame:
    """The stored table restricted to the months the window touches (partition pruning)."""
    start, end = dur.parse_window(start_time, end_time)
    return store.read_orders_table(spark, table_path, start, end)


@dataclass(frozen=True)
class Analysis:
    durations_us: DataFrame
    counts: DataFrame
    quartiles_us: DataFrame
    normal_us: DataFrame
    anomalous_us: DataFrame


def analysis(
    final_orders: DataFrame,
    start_time: str | None = None,
    end_time: str | None = None,
    chains: tuple[str, ...] = SUPPORTED_CHAINS,
    work: str | None = None,
) -> Analysis:
    """The analysis of a window; the durations are written once, to ``work`` or a fresh folder."""
    d = dur.order_durations_us(final_orders, start_time, end_time, chains)
    path = f"{work or work_folder(final_orders.sparkSession)}/durations"
    d.write.option("compression", COMPRESSION).parquet(path)
    d = final_orders.sparkSession.read.schema(d.schema).parquet(path)
    q = quantiles.route_quartiles_us(d)
    return Analysis(
        durations_us=d,
        counts=quantiles.route_metric_counts(d),
        quartiles_us=q,
        normal_us=routes.normal_orders_us(d, q),
        anomalous_us=routes.anomalous_orders_us(d, q),
    )


def averages_report(final_orders: DataFrame, start_time=None, end_time=None, chains=SUPPORTED_CHAINS):
    """What the averages endpoint answered: last_updated, the route grid, and fences."""
    a = analysis(final_orders, start_time, end_time, chains)
    last = routes.last_updated(final_orders)
    averages = routes.route_averages(a.normal_us)
    grid = routes.route_matrix(averages, chains)
    fences = routes.route_fences(a.quartiles_us)
    return {
        "last_updated": last,
        "averages": grid,
        "thresholds": fences,
        "document": routes.averages_document(last, grid, averages, fences),
    }
