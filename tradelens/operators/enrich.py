"""Enrich: fill the six event timestamps from block and transaction lookups.

The original service calls remote endpoints per order, five orders at a time.
Here the lookups are tables (``blocks``, ``transactions``) and every step is a
set operation:

    timestamp_candidates -> lookup_requests -> resolve_* (equi joins) -> enriched_orders

Scale notes:
* Every request passes at most one transaction join and one block join; the
  requests are never recomputed per lookup kind.
* A request without a key cannot match: it skips the transaction join, and its
  block key is salted so that keyless rows never pile up in one task.
* Lookup tables have one row per key, so no request is ever multiplied. A
  recurring run reads them bucketed and sorted by key (``sources.lookups``) and
  shuffles its requests only; raw tables are reduced first, hash-partitioned on
  the join key, and the join reuses that shuffle.
* A hot key (many orders in one block or one transaction) is joined by a
  broadcast of its lookup row instead of in one task (``joins.lookup_join``).
* Only orders that pass the candidate gate are shuffled for the merge; all
  other rows pass through untouched.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import COMPRESSION, EVENT_SIDE, EVENTS, SUPPORTED_CHAINS, TX_LOOKUP_CHAINS
from ..functions.columns import epoch_to_timestamp, hex_to_long, ist_display, missing_time_gate, present, tx_hash_head
from ..sources.schemas import FINAL_ORDER_COLUMNS
from .joins import hot_keys, lookup_join


def _chain_of(event: str) -> Column:
    return F.col(f"{EVENT_SIDE[event]}_chain")


def lookup_class_gate() -> Column:
    """Second gate: some event is missing its time and has the key its chain is looked up by."""
    tx_chains = list(TX_LOOKUP_CHAINS)
    parts = []
    for e in EVENTS:
        chain = _chain_of(e)
        parts.append(F.col(f"{e}_tx_hash").isNotNull() & F.col(e).isNull() & chain.isin(tx_chains))
        parts.append(F.col(f"{e}_block_number").isNotNull() & F.col(e).isNull() & ~chain.isin(tx_chains))
    return reduce(lambda a, b: a | b, parts)


def timestamp_candidates(final_orders: DataFrame) -> DataFrame:
    """Ids of orders with a block number but no timestamp for some event."""
    return final_orders.where(missing_time_gate()).select("create_order_id")


def lookup_requests(final_orders: DataFrame, order_ids: DataFrame | None = None) -> DataFrame:
    """One row per (order, event) whose time is to be looked up.

    ``order_ids`` restricts the orders (semi join); by default the candidate gate
    is applied in place, which needs no join. Within an admitted order an event
    is requested when its chain is supported, its time is missing, and it has a
    tx hash (ethereum, arbitrum, bitcoin) or a block number (the other chains).
    """
    if order_ids is None:
        admitted = final_orders.where(missing_time_gate())
    else:
        admitted = final_orders.join(order_ids.select("create_order_id"), "create_order_id", "left_semi")
    events = F.array(
        *[
            F.struct(
                F.lit(e).alias("event"),
                _chain_of(e).alias("chain"),
                F.col(e).alias("current_time"),
                F.col(f"{e}_block_number").alias("block_number"),
                F.col(f"{e}_tx_hash").alias("tx_hash"),
            )
            for e in EVENTS
        ]
    )
    rows = admitted.select("create_order_id", F.inline(events))
    by_tx = F.col("chain").isin(list(TX_LOOKUP_CHAINS))
    wanted = (
        F.col("chain").isin(list(SUPPORTED_CHAINS))
        & F.col("current_time").isNull()
        & ((by_tx & present("tx_hash")) | (~by_tx & F.col("block_number").isNotNull()))
    )
    return rows.where(wanted).select(
        "create_order_id",
        "event",
        "chain",
        F.when(by_tx, F.lit("transaction")).otherwise(F.lit("block")).alias("lookup"),
        "block_number",
        "tx_hash",
    )


def block_times(blocks: DataFrame) -> DataFrame:
    """(chain, block_number) -> epoch seconds, one row per key.

    hyperliquid publishes hex text (``0x...``); the others a number. A table
    that is in this form already (``sources.lookups``) stays as it is.
    """
    if "found_time" in blocks.columns:
        return blocks.select("chain", "block_number", "found_time")
    t = F.when(F.col("chain") == "hyperliquid", hex_to_long("block_time_raw")).otherwise(F.col("block_time"))
    return (
        blocks.select("chain", "block_number", t.alias("t"))
        .groupBy("chain", "block_number")
        .agg(F.min("t").alias("found_time"))
    )


def tx_records(transactions: DataFrame) -> DataFrame:
    """(chain, tx_hash) -> (block number, epoch seconds), one row per key.

    Of a repeated hash one whole row is taken: one with a block first, then the
    smallest block, then one with a time, then the smallest time. A table that
    is in this form already (``sources.lookups``) stays as it is.
    """
    if "tx_block_number" in transactions.columns:
        return transactions.select("chain", "tx_hash", "tx_block_number", "tx_time")
    row = F.struct(
        F.col("block_number").isNull().alias("no_block"),
        F.col("block_number").alias("tx_block_number"),
        F.col("block_time").isNull().alias("no_time"),
        F.col("block_time").alias("tx_time"),
    )
    first = transactions.groupBy("chain", "tx_hash").agg(F.min(row).alias("first"))
    return first.select("chain", "tx_hash", "first.tx_block_number", "first.tx_time")


def _truthy(c: Column) -> Column:
    return c.isNotNull() & (c != 0)


_OUT = ["create_order_id", "event", "chain", "block_time"]


def _resolve(requests: DataFrame, blocks: DataFrame, transactions: DataFrame | None, staged_path: str | None = None) -> DataFrame:
    """One plan for any mix of requests: at most one transaction join and one block join.

    * transaction requests join ``transactions`` on (chain, hash) - bitcoin
      hashes cut at ':';
    * then every request that still needs a block joins ``blocks`` once on
      (chain, block): its own block number (block chains, and bitcoin when the
      tx has no time) or the tx's block (ethereum, arbitrum).
    Requests without a key skip the join they cannot match, so no NULL key is
    ever shuffled. ``staged_path`` names a folder for the requests with their
    blocks, so that finding the hot blocks does not repeat the transaction join.
    """
    by_block = requests.where(F.col("lookup") == "block").select(
        *_OUT[:3], F.col("block_number").alias("blk"), F.lit(None).cast("long").alias("tx_time")
    )
    staged = by_block
    if transactions is not None:
        tx_req = requests.where(F.col("lookup") == "transaction").withColumn(
            "tx_hash", F.when(F.col("chain") == "bitcoin", tx_hash_head("tx_hash")).otherwise(F.col("tx_hash"))
        )
        # a hash that matches nothing, unique per request
        tx_salt = F.concat(F.lit("\u0000"), F.col("create_order_id"), F.lit("\u0000"), F.col("event"))
        tx = lookup_join(
            tx_req, tx_records(transactions), ["chain", "tx_hash"], hot_keys(tx_req, ["chain", "tx_hash"]), tx_salt, [*_OUT[:3], "block_number"]
        )
        is_btc = F.col("chain") == "bitcoin"
        blk = (
            F.when(is_btc & ~_truthy(F.col("tx_time")), F.col("block_number"))
            .when(~is_btc & _truthy(F.col("tx_block_number")), F.col("tx_block_number"))
        )
        tx_time = F.when(is_btc & _truthy(F.col("tx_time")), F.col("tx_time"))
        staged = staged.unionByName(tx.select(*_OUT[:3], blk.alias("blk"), tx_time.alias("tx_time")))
    # Rows with no block to look up keep a salted negative key: they spread evenly
    # over the shuffle (a NULL key would send them all to one task) and match no
    # block (no block number is as low). Of a request's block and its tx's time one
    # is NULL, so the key need not travel beside its copy to tell them apart.
    salt = F.lit(-(1 << 62)) - F.pmod(F.xxhash64("create_order_id", "event"), F.lit(1 << 30))
    if staged_path is not None:
        staged.write.option("compression", COMPRESSION).parquet(staged_path)
        staged = staged.sparkSession.read.schema(staged.schema).parquet(staged_path)
    keyed = staged.withColumn("k", F.coalesce(F.col("blk"), salt))
    bt = block_times(blocks).withColumnRenamed("block_number", "k")
    # counted on the blocks that are really joined
    hot_blocks = hot_keys(keyed.where(F.col("blk").isNotNull()).select("chain", "k"), ["chain", "k"])
    found = F.when(_truthy(F.col("found_time")), F.col("found_time"))
    return lookup_join(keyed, bt, ["chain", "k"], hot_blocks, salt, [*_OUT[:3], "tx_time"]).select(
        *_OUT[:3], F.coalesce(found, F.col("tx_time")).alias("block_time")
    )


def resolve_by_block(requests: DataFrame, blocks: DataFrame) -> DataFrame:
    """Block-number chains (base, bera, unichain, starknet, hyperliquid): block -> time."""
    return _resolve(requests.where(F.col("lookup") == "block"), blocks, None)


def resolve_by_transaction(requests: DataFrame, transactions: DataFrame, blocks: DataFrame) -> DataFrame:
    """ethereum, arbitrum: tx hash -> the tx's block -> time."""
    req = requests.where(F.col("chain").isin("ethereum", "arbitrum") & (F.col("lookup") == "transaction"))
    return _resolve(req, blocks, transactions)


def resolve_bitcoin(requests: DataFrame, transactions: DataFrame, blocks: DataFrame) -> DataFrame:
    """bitcoin: the tx's own time (hash cut at ':'); else the order's block number -> time."""
    req = requests.where((F.col("chain") == "bitcoin") & (F.col("lookup") == "transaction"))
    return _resolve(req, blocks, transactions)


def resolve_all(
    requests: DataFrame, blocks: DataFrame, transactions: DataFrame, staged_path: str | None = None
) -> DataFrame:
    """Every request with its found time (epoch seconds) or NULL."""
    return _resolve(requests, blocks, transactions, staged_path)


def enriched_parts(final_orders: DataFrame, resolved: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(untouched, merged): rows that cannot change, and the candidate rows with found times filled.

    ``resolved`` must come from ``lookup_requests`` over the same table, so only
    rows passing the candidate gate can change: those are merged by key, the
    rest pass through without a shuffle. A set time is never overwritten.
    """
    found = resolved.where(F.col("block_time").isNotNull()).groupBy("create_order_id").agg(
        *[F.max(F.when(F.col("event") == e, F.col("block_time"))).alias(f"_found_{e}") for e in EVENTS]
    )
    gate = missing_time_gate()
    touched = final_orders.where(gate).join(found, "create_order_id", "left")
    merged = touched.select(
        *[
            F.coalesce(F.col(c), epoch_to_timestamp(f"_found_{c}")).alias(c) if c in EVENTS else F.col(c)
            for c in FINAL_ORDER_COLUMNS
        ]
    )
    untouched = final_orders.where(~F.coalesce(gate, F.lit(False))).select(*FINAL_ORDER_COLUMNS)
    return untouched, merged


def enriched_orders(final_orders: DataFrame, resolved: DataFrame) -> DataFrame:
    """The table with found times filled in; a set time is never overwritten."""
    untouched, merged = enriched_parts(final_orders, resolved)
    return untouched.unionByName(merged)


def enrichment_report(final_orders: DataFrame, resolved: DataFrame) -> DataFrame:
    """Per order that passed both gates: ``updated`` if some time was found, else ``failed``.

    One row per order (never a list of ids in one row); ``enrichment_summary``
    counts them.
    """
    population = final_orders.where(missing_time_gate() & lookup_class_gate()).select("create_order_id")
    found = (
        resolved.groupBy("create_order_id")
        .agg(
            F.count(F.lit(1)).alias("requested_events"),
            F.count("block_time").alias("found_events"),
        )
    )
    j = population.join(found, "create_order_id", "left")
    return j.select(
        "create_order_id",
        F.coalesce(F.col("requested_events"), F.lit(0).cast("long")).alias("requested_events"),
        F.coalesce(F.col("found_events"), F.lit(0).cast("long")).alias("found_events"),
        F.when(F.coalesce(F.col("found_events"), F.lit(0)) > 0, F.lit("updated")).otherwise(F.lit("failed")).alias(
            "status"
        ),
    )


def enrichment_summary(report: DataFrame) -> DataFrame:
    """Counts of updated and failed orders."""
    return report.groupBy("status").agg(F.count(F.lit(1)).alias("orders"))


def event_time_display(resolved: DataFrame) -> DataFrame:
    """Found times as the update text the service wrote: ``yyyy-MM-dd HH:mm:ss.SSS+05:30``."""
    return resolved.select(
        "create_order_id",
        "event",
        "chain",
        "block_time",
        ist_display("block_time").alias("display_time"),
    )
