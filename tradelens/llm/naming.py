"""Exact dedup by deterministic block naming.

A normalised text is cut into fixed-size byte blocks. The distinct blocks are
sorted and numbered, so that equal blocks get one integer name; then adjacent
pairs of names are named in the same way, level by level, until each document
has a single name. Two texts of as many blocks get the same final name exactly
if they are equal, so (number of blocks, name) is an identity without collisions.

Blocks travel once, in the aggregate that finds the distinct ones. Everything
else carries two hashes of a block instead. That is no loss of exactness: the
distinct blocks themselves are compared with their hashes, and another seed is
taken if two blocks ever share both.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import text_or_empty, written

SPACES = " \t\n\x0b\x0c\r"
BLOCK_BYTES = 4096


def without_spaces(text: Column) -> Column:
    """The text less every character of ``[\\x20\\x09-\\x0D]``."""
    return F.translate(text, SPACES, "")


def _blocks(data: Column, block_bytes: int) -> Column:
    """Fixed-size blocks of binary data in order; empty data has one empty block."""
    count = F.greatest(F.lit(1), F.ceil(F.octet_length(data) / block_bytes)).cast("int")
    return F.transform(
        F.sequence(F.lit(0), count - 1), lambda i: F.substring(data, i * block_bytes + 1, F.lit(block_bytes))
    )


def _hashes(block: Column, seed: int, bits: int) -> Column:
    """Two seeded hashes of a block; ``bits`` below 64 weakens them (tests)."""
    pair = [F.shiftrightunsigned(F.xxhash64(F.lit(2 * seed + k), block), 64 - bits) for k in (0, 1)]
    return F.struct(pair[0].alias("h1"), pair[1].alias("h2"))


def _numbered(distinct: DataFrame, keys: list[str], keep: list[str]) -> DataFrame:
    """Integer names of distinct keys by their place in sorted order, as a written table."""
    named = distinct.sortWithinPartitions(*keys).select(*keep, F.monotonically_increasing_id().alias("name"))
    return written(named, "names")


def _block_names(docs: DataFrame, text: str, block_bytes: int, seed: int, bits: int) -> DataFrame:
    blocks = docs.select(
        F.explode(
            F.transform(
                F.array(without_spaces(text_or_empty(text)).cast("binary")), lambda b: _blocks(b, block_bytes)
            )[0]
        ).alias("block")
    ).select(_hashes(F.col("block"), seed, bits).alias("h"), "block")
    distinct = blocks.select("h.h1", "h.h2", "block").distinct()
    return _numbered(distinct, ["h1", "h2", "block"], ["h1", "h2"])


def exact_dedup(
    docs: DataFrame, id: str = "doc_id", text: str = "text", block_bytes: int = BLOCK_BYTES, hash_bits: int = 64
) -> DataFrame:
    """One row per input row: ``id``, keep_id, group_size, kept, text_sha256, text_hash.

    Texts are equal when identical without ASCII white space; null counts as
    empty, and all empty texts are one group. Of a group the row with the most
    code points stays, then the smallest id (a null id comes last); of rows
    that agree even in that, the first read. ``keep_id`` is the id of that row.
    Repeated ids are separate rows. An empty table gives an empty result.
    ``text_hash`` is xxhash64 of the text as given, to find the row again.
    Other columns of ``docs`` are not read.
    """
    seed = 0
    while True:
        names = _block_names(docs, text, block_bytes, seed, hash_bits)
        if names.groupBy("h1", "h2").agg(F.count(F.lit(1)).alias("c")).where("c > 1").isEmpty():
            break
        seed += 1

    raw = text_or_empty(text)
    rows = docs.select(
        F.col(id).alias("id"),
        F.char_length(raw).alias("points"),
        F.xxhash64(raw).alias("text_hash"),
        F.transform(
            F.array(without_spaces(raw).cast("binary")),
            lambda b: F.struct(
                F.sha2(b, 256).alias("sha"),
                F.transform(_blocks(b, block_bytes), lambda x: _hashes(x, seed, hash_bits)).alias("hs"),
            ),
        )[0].alias("t"),
    )
    rows = written(
        rows.select("id", "points", "text_hash", "t.sha", "t.hs", F.monotonically_increasing_id().alias("row")), "rows"
    )

    placed = rows.select("row", F.size("hs").alias("n"), F.posexplode("hs").alias("pos", "h"))
    level = placed.select("row", "n", "pos", "h.h1", "h.h2").join(names, ["h1", "h2"])
    level = written(level.select("row", "n", F.col("n").alias("width"), "pos", "name"), "level")
    longest = rows.agg(F.max(F.size("hs"))).first()[0] or 0
    done = level.where("width = 1")
    while longest > 1:
        even = F.col("pos") % 2 == 0
        pairs = (
            level.where("width > 1")
            .groupBy("row", "n", "width", F.floor(F.col("pos") / 2).cast("int").alias("at"))
            .agg(
                F.max(F.when(even, F.col("name"))).alias("a"),
                F.coalesce(F.max(F.when(~even, F.col("name"))), F.lit(-1)).alias("b"),
            )
        )
        pairs = written(
            pairs.select("row", "n", F.ceil(F.col("width") / 2).cast("int").alias("width"), "at", "a", "b"), "pairs"
        )
        names = _numbered(pairs.select("a", "b").distinct(), ["a", "b"], ["a", "b"])
        level = pairs.join(names, ["a", "b"]).select("row", "n", "width", F.col("at").alias("pos"), "name")
        level = written(level, "level")
        done = done.unionByName(level.where("width = 1"))
        longest = -(-longest // 2)

    named = written(
        done.select("row", "n", "name").join(rows.drop("hs"), "row"),
        "named",
    )
    order = F.struct(
        (-F.col("points")).alias("p"), F.col("id").isNull().alias("z"), F.col("id").alias("id"), F.col("row").alias("row")
    )
    groups = named.groupBy("n", "name").agg(F.min(order).alias("best"), F.count(F.lit(1)).alias("group_size"))
    groups = written(groups, "groups")
    return named.join(groups, ["n", "name"]).select(
        F.col("id").alias(id),
        F.col("best.id").alias("keep_id"),
        "group_size",
        (F.col("row") == F.col("best.row")).alias("kept"),
        F.col("sha").alias("text_sha256"),
        "text_hash",
    )


def keep_rows(docs: DataFrame, verdict: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs`` that ``verdict`` (id, text_hash, kept) keeps, all columns.

    Rows are found again by id and text. Of rows that repeat both, one stays
    (those after the first are dropped only where there are any).
    """
    kept = verdict.where("kept").select(F.col(id).alias("_id"), F.col("text_hash").alias("_hash"))
    all_rows = verdict.groupBy(id, "text_hash").agg(F.count(F.lit(1)).alias("c"))
    repeated = not all_rows.where("c > 1").isEmpty()
    hashed = docs.withColumn("_row_hash", F.xxhash64(text_or_empty(text)))
    on = hashed[id].eqNullSafe(kept["_id"]) & (hashed["_row_hash"] == kept["_hash"])
    out = hashed.join(kept, on, "left_semi")
    if repeated:
        out = out.dropDuplicates([id, "_row_hash"])
    return out.drop("_row_hash")
