"""Token files with directly addressable codes.

Ids are split into chunks of eight bits, lowest first. A level holds one chunk
of each id that reaches it, a bitmap tells which of them go on to the next
level, and a rank directory counts the set bits before every block of the
bitmap. The place of an id's next chunk is the rank of its bit, so any token is
read from a few bytes without decoding others.

Files are Parquet, one row per segment: whole documents in ascending id order,
about ``SEGMENT`` tokens each. ``shard`` and ``segment`` give the order.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from .common import map_arrow, slices, text_or_empty
from .wordids import word_encoder

END_ID = 2
SEGMENT = 1 << 20
RANK_BLOCK = 512
_TEXT_BYTES = 12 << 20
_LEVELS = pa.list_(
    pa.struct([("chunks", pa.binary()), ("bits", pa.binary()), ("ranks", pa.binary())])
)


def encode(ids: np.ndarray) -> list[dict[str, bytes]]:
    """Levels of ``ids`` (unsigned 32 bits), lowest chunk first."""
    levels = []
    while True:
        rest = ids >> 8
        more = rest > 0
        bits = np.packbits(more, bitorder="little")
        padded = np.zeros(-(-len(bits) * 8 // RANK_BLOCK) * RANK_BLOCK // 8, np.uint8)
        padded[: len(bits)] = bits
        ones = np.bitwise_count(padded).reshape(-1, RANK_BLOCK // 8).sum(axis=1, dtype=np.uint32)
        ranks = np.cumsum(ones, dtype=np.uint32) - ones
        levels.append({"chunks": (ids & 255).astype(np.uint8).tobytes(), "bits": bits.tobytes(), "ranks": ranks.astype("<u4").tobytes()})
        ids = rest[more]
        if not len(ids):
            return levels


def read(levels: list[dict[str, bytes]], at: np.ndarray) -> np.ndarray:
    """The ids at places ``at``, by rank; nothing else is decoded."""
    out = np.zeros(len(at), np.uint32)
    todo, at = np.arange(len(at)), np.asarray(at, np.int64)
    for depth, level in enumerate(levels):
        out[todo] |= np.frombuffer(level["chunks"], np.uint8)[at].astype(np.uint32) << (8 * depth)
        bits = np.frombuffer(level["bits"], np.uint8)
        on = (bits[at >> 3] >> (at & 7).astype(np.uint8)) & 1 == 1
        at, todo = at[on], todo[on]
        if not len(at):
            break
        # Set bits before ``at``: those before its block, then those within it.
        block = at // RANK_BLOCK
        rank = np.frombuffer(level["ranks"], "<u4")[block].astype(np.int64)
        sums = np.concatenate(([0], np.cumsum(np.bitwise_count(bits), dtype=np.int64)))
        rank += sums[at >> 3] - sums[block * (RANK_BLOCK // 8)]
        rank += np.bitwise_count(bits[at >> 3] & ((1 << (at & 7)) - 1).astype(np.uint8))
        at = rank
    return out


def token(levels: list[dict[str, bytes]], at: int) -> int:
    """One id, reading at most one block of each bitmap."""
    out = 0
    for depth, level in enumerate(levels):
        out |= level["chunks"][at] << (8 * depth)
        if not level["bits"][at >> 3] >> (at & 7) & 1:
            return out
        block = at // RANK_BLOCK
        base = int.from_bytes(level["ranks"][4 * block : 4 * block + 4], "little")
        within = int.from_bytes(level["bits"][block * RANK_BLOCK // 8 : (at >> 3) + 1], "little")
        at = base + (within & ((1 << (at - block * RANK_BLOCK)) - 1)).bit_count()
    return out


def _write(kind: pa.DataType, path: str | None, end_id: int, segment: int) -> Callable:
    schema = pa.schema(
        [("shard", pa.int32()), ("segment", pa.int32()), ("n_tokens", pa.int64()), ("ids", pa.list_(kind)), ("ends", pa.list_(pa.int64())), ("levels", _LEVELS)]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = word_encoder(path)
        shard, number, names, sizes, parts, held = TaskContext.get().partitionId(), 0, [], [], [], 0

        def flush() -> pa.RecordBatch:
            ids, ends = np.concatenate(parts), np.cumsum(np.concatenate(sizes))
            row = [[shard], [number], [len(ids)], [pa.concat_arrays(names).to_pylist()], [ends.tolist()], [encode(ids)]]
            return pa.record_batch([pa.array(v, f.type) for v, f in zip(row, schema)], schema=schema)

        for batch in slices(batches, 1, _TEXT_BYTES):
            ids, ends = encoder.encode(batch.column(1), end_id)
            sizes_here = np.diff(ends, prepend=0)
            at = 0
            while at < len(ends):  # whole documents until the segment is full
                begun = ends[at - 1] if at else 0
                upto = max(at + 1, int(np.searchsorted(ends, begun + segment - held, side="right")))
                names.append(batch.column(0).slice(at, upto - at))
                sizes.append(sizes_here[at:upto])
                parts.append(ids[begun : ends[upto - 1]])
                held += int(ends[upto - 1] - begun)
                at = upto
                if held >= segment or at < len(ends):
                    yield flush()
                    number, names, sizes, parts, held = number + 1, [], [], [], 0
        if held:
            yield flush()

    return run


def write_tokens(
    docs: DataFrame,
    path: str,
    id: str = "doc_id",
    text: str = "text",
    end_id: int = END_ID,
    segment: int = SEGMENT,
    tokenizer: str | None = None,
) -> None:
    """Write the ids of all documents, each closed by ``end_id``, to ``path`` in ascending id order.

    Null ids come first; rows with one id are ordered by a hash of their text. Null and empty
    texts are the end id alone. Repeated rows are kept. An empty table writes a
    folder without segments. Other columns of ``docs`` are not read.
    """
    raw = text_or_empty(text)
    ordered = docs.select(F.col(id).alias("id"), raw.alias("text"), F.xxhash64(raw).alias("tie"))
    ordered = ordered.repartitionByRange("id", "tie").sortWithinPartitions("id", "tie").select("id", "text")
    kind = docs.schema[id].dataType
    out = map_arrow(
        ordered,
        _write(to_arrow_type(kind), tokenizer, end_id, segment),
        f"shard int, segment int, n_tokens long, ids array<{kind.simpleString()}>, ends array<bigint>, "
        "levels array<struct<chunks: binary, bits: binary, ranks: binary>>",
    )
    out.write.parquet(path)


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for i in range(batch.num_rows):
            ids, ends = batch.column(0)[i].values, batch.column(1)[i].values.to_numpy()
            tokens = read(batch.column(2)[i].as_py(), np.arange(ends[-1]))
            raw = memoryview(tokens.astype("<u4").tobytes())
            starts = ends - np.diff(ends, prepend=0)
            crcs = [zlib.crc32(raw[4 * s : 4 * e]) for s, e in zip(starts.tolist(), ends.tolist())]
            place = [pa.array(np.full(len(ends), batch.column(k)[i].as_py(), np.int32)) for k in (3, 4)]
            yield pa.record_batch(
                [*place, ids, pa.array(starts), pa.array(ends - starts), pa.array(crcs, pa.int64())],
                names=["shard", "segment", "id", "at", "n_tokens", "ids_crc32"],
            )


def read_documents(spark: SparkSession, path: str, id: str = "doc_id") -> DataFrame:
    """One row per document of the files: ``id``, start, n_tokens, ids_crc32.

    ``start`` counts the ids of all documents before it: running sums within
    each shard, then over the shards (one row per written partition).
    """
    files = spark.read.parquet(path)
    shards = files.groupBy("shard").agg(F.sum("n_tokens").alias("n"))
    earlier = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    shards = shards.select("shard", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("base"))
    before = Window.partitionBy("shard").orderBy("segment").rowsBetween(Window.unboundedPreceding, -1)
    starts = files.select("shard", "segment", F.coalesce(F.sum("n_tokens").over(before), F.lit(0)).alias("inner"))
    starts = starts.join(shards, "shard").select("shard", "segment", (F.col("base") + F.col("inner")).alias("base"))
    kind = files.schema["ids"].dataType.elementType.simpleString()
    work = files.select("ids", "ends", "levels", "shard", "segment")
    out = map_arrow(work, _read, f"shard int, segment int, id {kind}, at long, n_tokens long, ids_crc32 long")
    out = out.join(starts, ["shard", "segment"])
    return out.select(F.col("id").alias(id), (F.col("base") + F.col("at")).alias("start"), "n_tokens", "ids_crc32")
