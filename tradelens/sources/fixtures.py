"""Source tables derived from the test ``orders`` table.

The original service reads live order-book tables and remote chain lookups.
For tests and benchmarks the same shapes are projected out of the driver's
``orders`` parquet with integer arithmetic only (see FIXTURES.md), so Spark and
the DuckDB oracle derive identical rows and the work grows with ``orders``.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# The nine chain names a key is mapped to (eight supported plus one unsupported).
FIXTURE_CHAINS = ["arbitrum", "base", "bitcoin", "ethereum", "hyperliquid", "starknet", "bera", "unichain", "solana"]
EPOCH_SHIFT = 700_000_000


@dataclass(frozen=True)
class Sources:
    create_orders: DataFrame
    matched_orders: DataFrame
    swaps: DataFrame
    blocks: DataFrame
    transactions: DataFrame


def _chain_of(n: Column) -> Column:
    return F.element_at(F.array(*[F.lit(c) for c in FIXTURE_CHAINS]), (n % 9 + 1).cast("int"))


def _s(c: str) -> Column:
    return F.col(c).cast("string")


def _utc(orders: DataFrame, c: str) -> Column:
    """A timestamp column as an instant; one without a zone is on the UTC clock."""
    if orders.schema[c].dataType.typeName() == "timestamp":
        return F.col(c)
    text = F.col(c).cast("timestamp_ntz").cast("string")
    return F.concat(text, F.lit("+00:00")).cast("timestamp")


def _offsets(orders: DataFrame) -> DataFrame:
    """Per order: ids, chains, and the block offsets of the lifecycle."""
    base = orders.select(
        F.col("o_orderkey").alias("k"),
        F.col("o_orderstatus").alias("st"),
        _utc(orders, "o_orderdate").alias("created_at"),
        (F.unix_seconds(_utc(orders, "o_orderdate")) - EPOCH_SHIFT).alias("e"),
        F.round(F.col("o_totalprice") * 100).cast("long").alias("x"),
        _chain_of(F.col("o_custkey")).alias("source_chain"),
        _chain_of(F.col("o_orderkey") + F.col("o_custkey")).alias("destination_chain"),
    )
    x, k, st = F.col("x"), F.col("k"), F.col("st")
    return base.select(
        "k",
        "st",
        "created_at",
        "x",
        "source_chain",
        "destination_chain",
        (
            F.col("e")
            + F.when(x % 41 == 0, F.lit(-30))
            .when(x % 29 == 0, 7200 + x % 5000)
            .otherwise(20 + x % 300)
        ).alias("b_ui"),
        F.when((x + k) % 31 == 0, F.lit(9000)).otherwise(15 + (x + k) % 120).alias("d_ci"),
        F.when((x + 3 * k) % 37 == 0, F.lit(20000)).otherwise(30 + (x + 5 * k) % 600).alias("d_ur"),
        F.when((x + 7 * k) % 43 == 0, F.lit(30000)).otherwise(10 + (x + 11 * k) % 400).alias("d_cr"),
        F.when((st == "P") & (x % 3 == 0), F.lit("open"))
        .when((st == "O") & (x % 5 == 0), F.lit("mixed"))
        .when(st == "O", F.lit("refund"))
        .otherwise(F.lit("redeem"))
        .alias("outcome"),
    )


def derive_sources(spark: SparkSession, sf_dir: str) -> Sources:
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet")
    off = _offsets(orders)
    x, k, out = F.col("x"), F.col("k"), F.col("outcome")
    b_ui, d_ci, d_ur, d_cr = F.col("b_ui"), F.col("d_ci"), F.col("d_ur"), F.col("d_cr")
    redeem_src = out == "redeem"
    refund_src = out.isin("refund", "mixed")
    redeem_dst = out.isin("redeem", "mixed")
    refund_dst = out == "refund"
    on_btc = F.col("source_chain") == "bitcoin"
    even, odd = x % 2 == 0, x % 2 == 1

    create_orders = off.select(
        F.concat(F.lit("co_"), _s("k")).alias("create_id"),
        "created_at",
        "source_chain",
        "destination_chain",
        F.concat(F.lit("sh_"), _s("x")).alias("secret_hash"),
    )
    matched_orders = off.where(x % 11 != 0).select(
        F.concat(F.lit("co_"), _s("k")).alias("create_order_id"),
        F.concat(F.lit("ss_"), _s("k")).alias("source_swap_id"),
        F.concat(F.lit("ds_"), _s("k")).alias("destination_swap_id"),
        "created_at",
        F.col("created_at").alias("updated_at"),
        F.when(x % 97 == 0, F.col("created_at")).alias("deleted_at"),
    )
    source_leg = F.struct(
        F.concat(F.lit("ss_"), _s("k")).alias("swap_id"),
        F.col("created_at").alias("updated_at"),
        F.col("source_chain").alias("chain"),
        F.concat(F.lit("tx_ssi_"), _s("k"), F.when(on_btc, F.lit(":0")).otherwise(F.lit(""))).alias("initiate_tx_hash"),
        F.when(redeem_src, F.concat(F.lit("tx_ssr_"), _s("k"), F.when(on_btc, F.lit(":1")).otherwise(F.lit(""))))
        .when(even, F.lit(""))
        .alias("redeem_tx_hash"),
        F.when(refund_src, F.concat(F.lit("tx_ssf_"), _s("k"))).when(odd, F.lit("")).alias("refund_tx_hash"),
        F.when(x % 101 == 0, F.lit(0).cast("long")).otherwise(b_ui).alias("initiate_block_number"),
        F.when(redeem_src, b_ui + d_ci + d_ur + d_cr).when(even, F.lit(0)).alias("redeem_block_number"),
        F.when(refund_src, b_ui + d_ci + 7200 + d_cr).when(odd, F.lit(0)).alias("refund_block_number"),
    )
    destination_leg = F.struct(
        F.concat(F.lit("ds_"), _s("k")).alias("swap_id"),
        F.col("created_at").alias("updated_at"),
        F.col("destination_chain").alias("chain"),
        F.concat(F.lit("tx_dsi_"), _s("k")).alias("initiate_tx_hash"),
        F.when(redeem_dst, F.concat(F.lit("tx_dsr_"), _s("k"))).when(even, F.lit("")).alias("redeem_tx_hash"),
        F.when(refund_dst, F.concat(F.lit("tx_dsf_"), _s("k"))).when(odd, F.lit("")).alias("refund_tx_hash"),
        (b_ui + d_ci).alias("initiate_block_number"),
        F.when(redeem_dst, b_ui + d_ci + d_ur).when(even, F.lit(0)).alias("redeem_block_number"),
        F.when(refund_dst, b_ui + d_ci + 7200 + d_ur).when(odd, F.lit(0)).alias("refund_block_number"),
    )
    # both legs of an order in one pass
    swaps = off.select(F.inline(F.array(source_leg, destination_leg)))

    # One row per (chain, hash, block) the swaps mention, unpivoted in one pass.
    legs = swaps.select(
        "chain",
        F.inline(
            F.array(
                F.struct(F.col("initiate_tx_hash").alias("tx_hash"), F.col("initiate_block_number").alias("block_number")),
                F.struct(F.col("redeem_tx_hash").alias("tx_hash"), F.col("redeem_block_number").alias("block_number")),
                F.struct(F.col("refund_tx_hash").alias("tx_hash"), F.col("refund_block_number").alias("block_number")),
            )
        ),
    )
    bn = F.col("block_number")
    # A block's time follows from its number and a chain's hashes lie together: only the keys are compared and shuffled.
    blocks = (
        legs.where((bn > 0) & (bn % 53 != 0))
        .select("chain", "block_number")
        .distinct()
        .select(
            "chain",
            "block_number",
            (bn + EPOCH_SHIFT).alias("block_time"),
            F.when(F.col("chain") == "hyperliquid", F.concat(F.lit("0x"), F.lower(F.hex(bn + EPOCH_SHIFT))))
            .otherwise((bn + EPOCH_SHIFT).cast("string"))
            .alias("block_time_raw"),
        )
    )
    transactions = (
        legs.where(
            F.col("chain").isin("ethereum", "arbitrum", "bitcoin")
            & (F.col("tx_hash") != "")
            & (bn > 0)
            & (bn % 59 != 0)
        )
        .select(
            "chain",
            F.when(F.col("chain") == "bitcoin", F.split(F.col("tx_hash"), ":").getItem(0))
            .otherwise(F.col("tx_hash"))
            .alias("tx_hash"),
            "block_number",
        )
        .repartition("chain", "tx_hash")
        .distinct()
        .select(
            "chain",
            "tx_hash",
            "block_number",
            F.when((F.col("chain") == "bitcoin") & (bn % 7 != 0), bn + EPOCH_SHIFT).alias("block_time"),
        )
    )
    return Sources(create_orders, matched_orders, swaps, blocks, transactions)
