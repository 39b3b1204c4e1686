"""SimHash near-dedup: tiled exact comparison with exclusive-or and bit counts.

Fingerprints are made once per text; equal ones are merged. The distinct ones
are filed by the population counts of their two halves, and each file is cut
into tiles of about ``TILE`` fingerprints. The Hamming distance of two
fingerprints is at least the sum of the differences of these counts, so only
tile pairs whose counts differ by no more than the radius are compared, each in
one task, in full. A tile pair reports a spanning forest of its links, not the
links one by one; the forests are joined by connected components.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_arrow, slices, text_or_empty, written
from .components import components

SHINGLE = 4
SEED = 42
RADIUS = 4
TILE = 4096
_CHUNK = 1 << 15
_ROWS = 64


def fingerprint(text: bytes, shingle: int = SHINGLE) -> int:
    """The 64-bit fingerprint of a UTF-8 text (unsigned); 0 without words."""
    words = text.lower().split()  # of bytes: A-Z, and exactly [\x20\x09-\x0D]
    if not words:
        return 0
    digest = xxhash.xxh64_digest
    joined = b" ".join(words)
    if len(words) <= shingle:
        hashes = digest(joined, SEED)
    else:
        ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
        starts = np.concatenate(([0], ends[:-1] + 1))
        spans = zip(starts.tolist(), ends[shingle - 1 :].tolist())
        hashes = b"".join([digest(joined[s:e], SEED) for s, e in spans])
    rows = np.frombuffer(hashes, np.uint8).reshape(-1, 8)
    ones = np.zeros(64, np.int64)
    for at in range(0, len(rows), _CHUNK):
        ones += np.unpackbits(rows[at : at + _CHUNK], axis=1).sum(axis=0, dtype=np.int32)
    return int.from_bytes(np.packbits(2 * ones > len(rows)).tobytes(), "big")


def _fingerprints(shingle: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 1):
            texts = batch.column(1).cast(pa.binary()).to_pylist()
            prints = np.array([fingerprint(t, shingle) for t in texts], np.uint64).view(np.int64)
            yield pa.record_batch([batch.column(0), pa.array(prints), batch.column(2)], names=["id", "fp", "text_hash"])

    return run


def forest(a: np.ndarray, b: np.ndarray, same: bool, radius: int) -> np.ndarray:
    """Pairs (root, member) that connect what links of ``a`` x ``b`` connect; ``same``: the tile with itself."""
    both = a if same else np.concatenate([a, b])
    label = np.arange(len(both))
    shift = 0 if same else len(a)
    for at in range(0, len(a), _ROWS):
        near = np.bitwise_count(a[at : at + _ROWS, None] ^ b[None, :]) <= radius
        for i in np.flatnonzero(near.sum(axis=1) > (1 if same else 0)).tolist():
            met = np.unique(label[np.append(np.flatnonzero(near[i]) + shift, at + i)])
            if len(met) > 1:
                label[np.isin(label, met)] = met[0]
    members = np.flatnonzero(label != np.arange(len(both)))
    return np.stack([both[label[members]], both[members]], axis=1).view(np.int64)


def _compare(radius: int):
    schema = pa.schema([("u", pa.int64()), ("v", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                a, b = (batch.column(k)[i].values.to_numpy().view(np.uint64) for k in (0, 1))
                pairs = forest(a, b, batch.column(2)[i].as_py(), radius)
                if len(pairs):
                    yield pa.record_batch([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], schema=schema)

    return run


def links(prints: DataFrame, radius: int = RADIUS, tile: int = TILE) -> DataFrame:
    """Edges (u, v) over the distinct values of column ``fp`` that connect all pairs within ``radius`` bits."""
    low = F.col("fp").bitwiseAND(F.lit(0xFFFFFFFF))
    high = F.shiftrightunsigned("fp", 32)
    distinct = prints.select("fp").distinct().select("fp", F.bit_count(high).alias("p"), F.bit_count(low).alias("q"))
    distinct = written(distinct, "prints")
    # At most 33 x 33 rows.
    files = distinct.groupBy("p", "q").agg(F.ceil(F.count(F.lit(1)) / tile).cast("int").alias("tiles"))
    filed = distinct.join(F.broadcast(files), ["p", "q"])
    tiles = filed.groupBy("p", "q", F.pmod(F.xxhash64("fp"), F.col("tiles")).cast("int").alias("s")).agg(
        F.sort_array(F.collect_list("fp")).alias("fps")
    )
    tiles = written(tiles, "tiles")

    near = [
        (dp, dq)
        for dp in range(0, radius + 1)
        for dq in range(-radius, radius + 1)
        if dp + abs(dq) <= radius and (dp, dq) >= (0, 0)
    ]
    offsets = F.explode(F.array(*[F.struct(F.lit(x).alias("dp"), F.lit(y).alias("dq")) for x, y in near]))
    here = tiles.select("p", "q", "s").withColumn("d", offsets)
    here = here.select("p", "q", "s", (F.col("p") + F.col("d.dp")).alias("p2"), (F.col("q") + F.col("d.dq")).alias("q2"))
    there = tiles.select(F.col("p").alias("p2"), F.col("q").alias("q2"), F.col("s").alias("s2"))
    same_file = (F.col("p") == F.col("p2")) & (F.col("q") == F.col("q2"))
    pairs = here.join(there, ["p2", "q2"]).where(~same_file | (F.col("s") <= F.col("s2")))
    left = pairs.join(tiles.withColumnRenamed("fps", "a"), ["p", "q", "s"])
    right = tiles.select(F.col("p").alias("p2"), F.col("q").alias("q2"), F.col("s").alias("s2"), F.col("fps").alias("b"))
    work = left.join(right, ["p2", "q2", "s2"])
    work = work.select("a", "b", (same_file & (F.col("s") == F.col("s2"))).alias("same"))
    return map_arrow(work, _compare(radius), "u long, v long")


def simhash_dedup(
    docs: DataFrame,
    id: str = "doc_id",
    text: str = "text",
    shingle: int = SHINGLE,
    radius: int = RADIUS,
    tile: int = TILE,
) -> DataFrame:
    """One row per input row: ``id``, fp, component_id, kept, text_hash.

    ``fp`` is the fingerprint as a signed long. ``component_id`` is the smallest
    id that links of at most ``radius`` bits reach, over any number of links,
    the row itself included (null only if no row of the component has an id).
    One row of each component is ``kept``: that with the smallest id, then the
    first read. Null texts are empty; texts without words have fingerprint 0 and
    link like any other. Repeated ids are separate rows; an empty table gives an
    empty result. Other columns of ``docs`` are not read.
    """
    kind = docs.schema[id].dataType.simpleString()
    raw = text_or_empty(text)
    prints = docs.select(F.col(id).alias("id"), raw.alias("text"), F.xxhash64(raw).alias("text_hash"))
    prints = map_arrow(prints, _fingerprints(shingle), f"id {kind}, fp long, text_hash long")
    prints = written(prints.withColumn("row", F.monotonically_increasing_id()), "fingerprints")
    roots = components(links(prints, radius, tile)).select(F.col("node").alias("fp"), "root")
    rooted = prints.join(roots, "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    rooted = written(rooted, "rooted")
    order = F.struct(F.col("id").isNull().alias("z"), F.col("id").alias("id"), F.col("row").alias("row"))
    groups = written(rooted.groupBy("root").agg(F.min(order).alias("best")), "groups")
    return rooted.join(groups, "root").select(
        F.col("id").alias(id),
        "fp",
        F.col("best.id").alias("component_id"),
        (F.col("row") == F.col("best.row")).alias("kept"),
        "text_hash",
    )
