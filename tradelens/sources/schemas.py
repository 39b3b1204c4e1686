"""Declared schemas of the source tables, the lookups and the analysis table."""

from __future__ import annotations

from pyspark.sql import types as T

from ..config import EVENTS

CREATE_ORDERS = T.StructType(
    [
        T.StructField("create_id", T.StringType(), False),
        T.StructField("created_at", T.TimestampType(), True),
        T.StructField("source_chain", T.StringType(), True),
        T.StructField("destination_chain", T.StringType(), True),
        T.StructField("secret_hash", T.StringType(), True),
    ]
)

MATCHED_ORDERS = T.StructType(
    [
        T.StructField("create_order_id", T.StringType(), False),
        T.StructField("source_swap_id", T.StringType(), True),
        T.StructField("destination_swap_id", T.StringType(), True),
        T.StructField("created_at", T.TimestampType(), True),
        T.StructField("updated_at", T.TimestampType(), True),
        T.StructField("deleted_at", T.TimestampType(), True),
    ]
)

SWAPS = T.StructType(
    [
        T.StructField("swap_id", T.StringType(), False),
        T.StructField("updated_at", T.TimestampType(), True),
        T.StructField("chain", T.StringType(), True),
        T.StructField("initiate_tx_hash", T.StringType(), True),
        T.StructField("redeem_tx_hash", T.StringType(), True),
        T.StructField("refund_tx_hash", T.StringType(), True),
        T.StructField("initiate_block_number", T.LongType(), True),
        T.StructField("redeem_block_number", T.LongType(), True),
        T.StructField("refund_block_number", T.LongType(), True),
    ]
)

# Replacements for the remote block / transaction lookups.
BLOCKS = T.StructType(
    [
        T.StructField("chain", T.StringType(), False),
        T.StructField("block_number", T.LongType(), False),
        T.StructField("block_time", T.LongType(), True),
        T.StructField("block_time_raw", T.StringType(), True),
    ]
)

TRANSACTIONS = T.StructType(
    [
        T.StructField("chain", T.StringType(), False),
        T.StructField("tx_hash", T.StringType(), False),
        T.StructField("block_number", T.LongType(), True),
        T.StructField("block_time", T.LongType(), True),
    ]
)


def _final_orders() -> T.StructType:
    fields = [
        T.StructField("create_order_id", T.StringType(), False),
        T.StructField("source_swap_id", T.StringType(), False),
        T.StructField("destination_swap_id", T.StringType(), False),
        T.StructField("created_at", T.TimestampType(), False),
        T.StructField("source_chain", T.StringType(), False),
        T.StructField("destination_chain", T.StringType(), False),
    ]
    fields += [T.StructField(e, T.TimestampType(), True) for e in EVENTS]
    fields.append(T.StructField("secret_hash", T.StringType(), True))
    fields += [T.StructField(f"{e}_block_number", T.LongType(), True) for e in EVENT_STORAGE_ORDER]
    fields += [T.StructField(f"{e}_tx_hash", T.StringType(), True) for e in EVENT_STORAGE_ORDER]
    return T.StructType(fields)


# Column order of the block-number and hash groups in the stored table.
EVENT_STORAGE_ORDER: tuple[str, ...] = (
    "user_init",
    "user_redeem",
    "user_refund",
    "cobi_init",
    "cobi_redeem",
    "cobi_refund",
)

FINAL_ORDERS = _final_orders()
FINAL_ORDER_COLUMNS: list[str] = [f.name for f in FINAL_ORDERS.fields]
