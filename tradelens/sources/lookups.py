"""Block and transaction lookups as bucketed tables.

The lookup tables only grow, while every run of the job brings new requests. They
are stored with one row per key, in buckets of the key and sorted inside each: a
join shuffles the requests into as many partitions and reads the lookup side
where it lies, with no exchange and no reduction.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import COMPRESSION
from ..operators.enrich import block_times, tx_records

BLOCK_KEYS = ("chain", "block_number")
TX_KEYS = ("chain", "tx_hash")


@dataclass(frozen=True)
class Lookups:
    """Prepared lookup tables, in the form that ``operators.enrich`` joins."""

    blocks: DataFrame
    transactions: DataFrame


def _buckets(spark: SparkSession, buckets: int | None) -> int:
    """As many as a shuffle has partitions, so that neither side of a join is dealt out anew."""
    return buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))


def _store(rows: DataFrame, keys: tuple[str, ...], name: str, path: str, buckets: int, mode: str) -> DataFrame:
    writer = rows.repartition(buckets, *keys).write.mode(mode).bucketBy(buckets, *keys).sortBy(*keys)
    writer.format("parquet").option("compression", COMPRESSION).option("path", path).saveAsTable(name)
    return rows.sparkSession.table(name)


def write_lookups(
    spark: SparkSession, blocks: DataFrame, transactions: DataFrame, folder: str, name: str, buckets: int | None = None
) -> Lookups:
    """Store both tables under ``folder`` and as ``<name>_blocks`` and ``<name>_transactions`` in the catalog."""
    n = _buckets(spark, buckets)
    return Lookups(
        _store(block_times(blocks), BLOCK_KEYS, f"{name}_blocks", f"{folder}/blocks", n, "errorifexists"),
        _store(tx_records(transactions), TX_KEYS, f"{name}_transactions", f"{folder}/transactions", n, "errorifexists"),
    )


def open_lookups(spark: SparkSession, folder: str, name: str, buckets: int) -> Lookups:
    """Tables that another application has stored under ``folder`` with so many buckets."""
    tables = []
    for kind, keys, columns in (
        ("blocks", BLOCK_KEYS, "chain STRING, block_number BIGINT, found_time BIGINT"),
        ("transactions", TX_KEYS, "chain STRING, tx_hash STRING, tx_block_number BIGINT, tx_time BIGINT"),
    ):
        by = ", ".join(keys)
        spark.sql(
            f"CREATE TABLE IF NOT EXISTS {name}_{kind} ({columns}) USING parquet "
            f"CLUSTERED BY ({by}) SORTED BY ({by}) INTO {buckets} BUCKETS LOCATION '{folder}/{kind}'"
        )
        tables.append(spark.table(f"{name}_{kind}"))
    return Lookups(*tables)


def add_lookups(
    spark: SparkSession, stored: Lookups, blocks: DataFrame, transactions: DataFrame, folder: str, name: str, buckets: int
) -> Lookups:
    """Append the keys that are not stored yet; a key once stored keeps its row."""
    new = [
        block_times(blocks).join(stored.blocks.select(*BLOCK_KEYS), list(BLOCK_KEYS), "left_anti"),
        tx_records(transactions).join(stored.transactions.select(*TX_KEYS), list(TX_KEYS), "left_anti"),
    ]
    for rows, keys, kind in zip(new, (BLOCK_KEYS, TX_KEYS), ("blocks", "transactions")):
        _store(rows, keys, f"{name}_{kind}", f"{folder}/{kind}", buckets, "append")
    return Lookups(spark.table(f"{name}_blocks"), spark.table(f"{name}_transactions"))
