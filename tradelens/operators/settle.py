"""Settle: order + match + both swap legs -> one lifecycle row per settled order.

Plan shape (chosen for large inputs):

* The settle predicate is the same for both legs, so ``swaps`` is filtered once
  and joined once: each match is unpivoted into its two legs, the legs are
  joined to the settled swaps on ``swap_id``, and the legs are folded back per
  match. Joining ``swaps`` twice (source leg, destination leg) would shuffle the
  largest table twice and carry ever wider rows through three join stages.
* The fold-back shuffles by ``create_order_id`` only; the fold, the join with
  ``create_orders``, the first-wins pick and the anti join against the stored
  table all reuse that partitioning and its one sort.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.columns import blank_to_null, instant, positive, present
from ..sources.schemas import FINAL_ORDER_COLUMNS, FINAL_ORDERS

_LEG_FIELDS = (
    "initiate_tx_hash",
    "redeem_tx_hash",
    "refund_tx_hash",
    "initiate_block_number",
    "redeem_block_number",
    "refund_block_number",
)


def settled_swap() -> Column:
    """A swap leg that finished: redeemed or refunded, with blocks on chain.

    AND binds before OR: (redeem hash set OR refund hash set) AND
    (redeem block > 0 OR refund block > 0) AND initiate block > 0.
    """
    return (
        (present("redeem_tx_hash") | present("refund_tx_hash"))
        & (positive("redeem_block_number") | positive("refund_block_number"))
        & positive("initiate_block_number")
    )


def _gated_block(hash_col: Column, block_col: Column) -> Column:
    """Redeem/refund block numbers are kept only when their hash is set."""
    return F.when(present(hash_col), block_col)


def settled_orders(create_orders: DataFrame, matched_orders: DataFrame, swaps: DataFrame) -> DataFrame:
    """Candidate rows for the analysis table, one per distinct (order, source swap, destination swap).

    Returns the analysis-table columns with the six event timestamps NULL; the
    legs are mapped to roles (user = source-side actions plus the destination
    redeem, cobi = destination-side actions plus the source redeem).
    """
    legs_done = swaps.where(settled_swap()).select(
        "swap_id", F.struct(*[F.col(c) for c in _LEG_FIELDS]).alias("leg")
    )
    legs = matched_orders.select(
        "create_order_id",
        "source_swap_id",
        "destination_swap_id",
        F.inline(
            F.array(
                F.struct(F.lit(True).alias("is_source"), F.col("source_swap_id").alias("swap_id")),
                F.struct(F.lit(False).alias("is_source"), F.col("destination_swap_id").alias("swap_id")),
            )
        ),
    )
    match_key = ["create_order_id", "source_swap_id", "destination_swap_id"]
    per_match = (
        legs.join(legs_done, "swap_id")
        .repartition("create_order_id")
        .groupBy(*match_key)
        .agg(
            F.max(F.when(F.col("is_source"), F.col("leg"))).alias("s"),
            F.max(F.when(~F.col("is_source"), F.col("leg"))).alias("d"),
        )
        .where(F.col("s").isNotNull() & F.col("d").isNotNull())
    )
    orders = create_orders.select(
        F.col("create_id").alias("create_order_id"),
        "created_at",
        "source_chain",
        "destination_chain",
        "secret_hash",
    )
    j = per_match.join(orders, "create_order_id")
    s = lambda f: F.col(f"s.{f}")
    d = lambda f: F.col(f"d.{f}")
    null_ts = F.lit(None).cast("timestamp")
    out = j.select(
        "create_order_id",
        "source_swap_id",
        "destination_swap_id",
        "created_at",
        "source_chain",
        "destination_chain",
        null_ts.alias("user_init"),
        null_ts.alias("cobi_init"),
        null_ts.alias("user_redeem"),
        null_ts.alias("cobi_redeem"),
        null_ts.alias("user_refund"),
        null_ts.alias("cobi_refund"),
        "secret_hash",
        s("initiate_block_number").alias("user_init_block_number"),
        _gated_block(d("redeem_tx_hash"), d("redeem_block_number")).alias("user_redeem_block_number"),
        _gated_block(s("refund_tx_hash"), s("refund_block_number")).alias("user_refund_block_number"),
        d("initiate_block_number").alias("cobi_init_block_number"),
        _gated_block(s("redeem_tx_hash"), s("redeem_block_number")).alias("cobi_redeem_block_number"),
        _gated_block(d("refund_tx_hash"), d("refund_block_number")).alias("cobi_refund_block_number"),
        blank_to_null(s("initiate_tx_hash")).alias("user_init_tx_hash"),
        blank_to_null(d("redeem_tx_hash")).alias("user_redeem_tx_hash"),
        blank_to_null(s("refund_tx_hash")).alias("user_refund_tx_hash"),
        blank_to_null(d("initiate_tx_hash")).alias("cobi_init_tx_hash"),
        blank_to_null(s("redeem_tx_hash")).alias("cobi_redeem_tx_hash"),
        blank_to_null(d("refund_tx_hash")).alias("cobi_refund_tx_hash"),
    )
    return conform(out)


def changed_orders(create_orders: DataFrame, matched_orders: DataFrame, swaps: DataFrame, since) -> DataFrame:
    """Ids of the orders that may have settled at or after ``since`` (a UTC datetime).

    Those with a match or a finished swap updated since then, or created since
    then; a row without its time counts as changed.
    """

    def recent(c: str) -> Column:
        return F.col(c).isNull() | (F.col(c) >= instant(since))

    finished = swaps.where(settled_swap() & recent("updated_at")).select("swap_id")
    legs = matched_orders.select("create_order_id", F.explode(F.array("source_swap_id", "destination_swap_id")).alias("swap_id"))
    by_swap = legs.join(finished, "swap_id", "left_semi").select("create_order_id")
    by_match = matched_orders.where(recent("updated_at")).select("create_order_id")
    by_order = create_orders.where(recent("created_at")).select(F.col("create_id").alias("create_order_id"))
    return by_swap.unionByName(by_match).unionByName(by_order).distinct()


def settled_changes(create_orders: DataFrame, matched_orders: DataFrame, swaps: DataFrame, changed: DataFrame) -> DataFrame:
    """``settled_orders`` of the ``changed`` orders only, joined back to all their matches and legs.

    What the full settle has for these orders, so appending it to a table that
    holds the rest gives the same table.
    """
    of_changed = matched_orders.join(changed.select("create_order_id"), "create_order_id", "left_semi")
    return settled_orders(create_orders, of_changed, swaps)


def conform(df: DataFrame) -> DataFrame:
    """Columns of the analysis table, in table order and with declared types."""
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in FINAL_ORDERS.fields])


REQUIRED = [f.name for f in FINAL_ORDERS.fields if not f.nullable]


def storable(candidates: DataFrame) -> DataFrame:
    """Candidates that have every column the table requires."""
    return candidates.dropna(subset=REQUIRED)


def rejected(candidates: DataFrame) -> DataFrame:
    """Candidates the table refuses, each with the required columns it lacks."""
    lacks = F.array_compact(F.array(*[F.when(F.col(c).isNull(), F.lit(c)) for c in REQUIRED]))
    return candidates.select("create_order_id", "source_swap_id", "destination_swap_id", lacks.alias("missing")).where(
        F.size("missing") > 0
    )


# Tie order among several candidates for one order; the original leaves it open.
_FIRST_WINS = ["source_swap_id", "destination_swap_id", "created_at", "source_chain", "destination_chain", "secret_hash"]


def first_per_order(candidates: DataFrame) -> DataFrame:
    """One candidate per ``create_order_id``: the smallest by ``_FIRST_WINS`` (NULLs first), then the rest.

    A grouped ``min`` of the packed row: after the settle fold the rows already
    arrive partitioned and sorted by ``create_order_id``, so this streams
    through them with no further shuffle or sort (a row_number window would
    sort them again).
    """
    rest = [c for c in candidates.columns if c != "create_order_id" and c not in _FIRST_WINS]
    packed = F.struct(*[F.col(c) for c in _FIRST_WINS + rest])
    return (
        candidates.groupBy("create_order_id")
        .agg(F.min(packed).alias("_first"))
        .select("create_order_id", "_first.*")
        .select(*candidates.columns)
    )


def append_new_orders(candidates: DataFrame, existing: DataFrame | None) -> DataFrame:
    """Rows to insert: candidates whose order is not stored yet (first write wins).

    Appending the result and running again yields nothing new (idempotent).
    Candidates that lack a required column are refused, as the table's NOT NULL
    rules did (``rejected`` lists them).
    """
    first = first_per_order(storable(candidates))
    if existing is None:
        return first
    return first.join(existing.select("create_order_id"), "create_order_id", "left_anti").select(*FINAL_ORDER_COLUMNS)


def table_profile(orders_table: DataFrame) -> DataFrame:
    """The analysis table as declared: per column its type, nullability and filled-row count.

    One pass over the table (a single global aggregate, partial per task).
    """
    fields = FINAL_ORDERS.fields
    counts = orders_table.agg(
        F.count(F.lit(1)).alias("_rows"), *[F.count(F.col(f.name)).alias(f.name) for f in fields]
    )
    entries = [
        F.struct(
            F.lit(i + 1).alias("position"),
            F.lit(f.name).alias("column_name"),
            F.lit(f.dataType.simpleString()).alias("data_type"),
            F.lit(f.nullable).alias("nullable"),
            F.col(f.name).alias("non_null_rows"),
        )
        for i, f in enumerate(fields)
    ]
    return counts.select(F.col("_rows").alias("total_rows"), F.inline(F.array(*entries))).select(
        "position", "column_name", "data_type", "nullable", "non_null_rows", "total_rows"
    )
