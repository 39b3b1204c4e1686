"""Mixture-controlled packing by deficit round-robin over source queues.

Each source is a queue of its documents' tokens. In every round (a window of
about ``window`` tokens) each queue's deficit grows by its quantum, which is the
window times its target proportion; it then gives as many whole grains as its
deficit covers, and the rest of the deficit is carried to the next round. Since
documents may be cut, what a queue has given after r rounds has a closed form,

    given(q, r) = min(tokens(q), grain * floor(r * quantum(q) / grain)),

in exact integers (a quantum is a whole number of parts of a grain). So every document can be placed by itself: its place in its
queue tells the round, and the sum of what all queues gave before is its place
in the packed stream. Deficits are carried across rounds and partitions with no
sequential pass. The stream is cut every ``sequence`` tokens; what is left over
at its end is cut into powers of two, so that nothing is padded.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Callable, Iterator
from fractions import Fraction
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import map_arrow, slices, text_or_empty, written
from .wordids import word_encoder

SEQUENCE = 2048
WINDOW = 64 * SEQUENCE
GRAIN = 1024
END_ID = 1
#: Quanta are counted in so many parts of a grain; a queue's is one part at least.
PARTS = 1 << 20
_TEXT_BYTES = 12 << 20
_KEPT_COUNTS = 1 << 20


def _stored(path: str | None, end_id: int) -> np.dtype:
    """How ids are kept between the passes: in two bytes where the vocabulary allows it."""
    return np.dtype("<u2" if max(word_encoder(path).tokenizer.get_vocab_size(), end_id + 1) <= 1 << 16 else "<u4")


def _tokenise(path: str | None, end_id: int, stored: np.dtype) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = word_encoder(path)
        for batch in slices(batches, 2, _TEXT_BYTES):
            ids, ends = encoder.encode(batch.column(2), end_id)
            offsets = pa.py_buffer(np.concatenate(([0], ends * stored.itemsize)).astype(np.int32))
            data = pa.Array.from_buffers(pa.binary(), batch.num_rows, [None, offsets, pa.py_buffer(ids.astype(stored))])
            sizes = np.diff(ends, prepend=0).astype(np.int64)
            yield pa.record_batch([batch.column(0), batch.column(1), pa.array(sizes), data], names=["id", "source", "n", "ids"])

    return run


class Rounds:
    """Where each queue's tokens lie in the packed stream."""

    def __init__(self, tokens: np.ndarray, quanta: np.ndarray, grain: int, sequence: int):
        """``quanta``: in parts of a grain."""
        self.tokens, self.quanta, self.grain, self.sequence = tokens, quanta, grain, sequence
        self.total = int(tokens.sum())
        self.full = self.total // sequence
        self.after = lru_cache(maxsize=max(16, min(4096, _KEPT_COUNTS // max(1, len(tokens)))))(self._after)

    def _after(self, rounds: int) -> tuple[np.ndarray, int]:
        given = np.minimum(self.tokens, rounds * self.quanta // PARTS * self.grain)
        return given, int(given.sum())

    def spans(self, queue: int, start: int, length: int) -> Iterator[tuple[int, int, int]]:
        """(place in the queue, length, place in the stream) of the runs of ``length`` tokens from ``start``."""
        quantum = int(self.quanta[queue])
        at, end = start, start + length
        while at < end:
            grains = at // self.grain + 1
            turn = -(-grains * PARTS // quantum) - 1  # the first round after which the queue has given more than ``at``
            (before, done), (after, _) = self.after(turn), self.after(turn + 1)
            upto = min(end, int(after[queue]))
            place = done + int(after[:queue].sum() - before[:queue].sum()) + at - int(before[queue])
            yield at, upto - at, place
            at = upto

    def pieces(self, queue: int, start: int, length: int) -> Iterator[tuple[int, int, int, int]]:
        """(place in the queue, length, sequence, offset there) of pieces that stay within a sequence."""
        for at, size, place in self.spans(queue, start, length):
            while size:
                number, offset = divmod(place, self.sequence)
                room = self.sequence - offset
                if number == self.full:  # the rest of the stream, as powers of two from the largest
                    rest = self.total - self.full * self.sequence
                    while True:
                        room = 1 << rest.bit_length() - 1
                        if offset < room:
                            room -= offset
                            break
                        offset, rest, number = offset - room, rest - room, number + 1
                cut = min(size, room)
                yield at, cut, number, offset
                at, place, size = at + cut, place + cut, size - cut


PIECES = "length long, start long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, queue int"


def _cut(shared, stored: np.dtype, grain: int, sequence: int, with_ids: bool) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rounds = Rounds(*shared.value, grain, sequence)
        for batch in slices(batches, 2, _TEXT_BYTES):
            rows, out, ids = [], [], []
            queues, places = batch.column(1).to_pylist(), batch.column(3).to_pylist()
            for i, data in enumerate(batch.column(2)):
                raw = np.frombuffer(data.as_buffer(), stored).astype("<u4")
                size, first = len(raw), places[i]
                view = memoryview(raw.tobytes())
                for at, length, number, offset in rounds.pieces(queues[i], first, size):
                    start = at - first
                    piece = view[4 * start : 4 * (start + length)]
                    rows.append(i)
                    out.append((length, start, zlib.crc32(piece), size, number, offset, queues[i]))
                    if with_ids:
                        ids.append(bytes(piece))
            columns = [np.array(c, np.int64) for c in zip(*out)]
            arrays = [batch.column(0).take(pa.array(rows, pa.int64())), *map(pa.array, columns[:-1]), pa.array(columns[-1].astype(np.int32))]
            names = ["id", "length", "start", "ids_crc32", "doc_tokens", "sequence_id", "offset", "queue"]
            if with_ids:
                arrays, names = [*arrays, pa.array(ids, pa.binary())], [*names, "ids"]
            yield pa.record_batch(arrays, names=names)

    return run


def pack(
    docs: DataFrame,
    id: str = "doc_id",
    text: str = "text",
    source: str = "source",
    targets: dict[str, float] | None = None,
    sequence: int = SEQUENCE,
    window: int = WINDOW,
    grain: int = GRAIN,
    end_id: int = END_ID,
    tokenizer: str | None = None,
    with_ids: bool = True,
) -> DataFrame:
    """One row per piece: ``id``, start, length, ids_crc32, doc_tokens, sequence_id, offset, queue[, ids].

    Sequences hold ``sequence`` tokens, gapless from offset 0; only the last few
    are shorter, each a power of two. A document is its ids and ``end_id``; null
    and empty texts are the end id alone. ``targets`` gives weights by source
    (default, and for sources it leaves out: the source's own share of all
    tokens). Every source is a queue of its own, a null one too, whatever their
    number; the driver holds a row for each. A queue that runs out leaves its part
    of later rounds to the others. Repeated ids and rows are separate documents. An empty
    table gives an empty result. ``ids`` are little-endian unsigned 32-bit ids.
    """
    kind = docs.schema[id].dataType.simpleString()
    tokens = docs.select(
        F.col(id).alias("id"), F.col(source).cast("string").alias("source"), text_or_empty(text).alias("text")
    )
    stored = _stored(tokenizer, end_id)
    tokens = map_arrow(tokens, _tokenise(tokenizer, end_id, stored), f"id {kind}, source string, n long, ids binary")
    tokens = written(tokens.withColumn("row", F.monotonically_increasing_id()), "tokens")

    totals = tokens.groupBy("source").agg(F.sum("n").alias("n")).collect()  # a row for each source
    totals = sorted((r["source"] is not None, r["source"] or "", r["n"]) for r in totals)
    names = [s if some else None for some, s, _ in totals]
    sizes = np.array([n for *_, n in totals], np.int64)
    every = int(sizes.sum())
    wanted = [Fraction((targets or {}).get(s, n / every)) if targets else Fraction(n, every) for s, n in zip(names, sizes.tolist())]
    if any(w <= 0 for w in wanted):
        raise ValueError("targets must be above 0: every document is packed")
    whole = sum(wanted)
    quanta = np.array([max(1, round(PARTS * window * w / (whole * grain))) for w in wanted], np.int64)

    # Places in the queues: running sums within buckets of bounded size, then over the buckets.
    spark = docs.sparkSession
    numbered = spark.createDataFrame(list(enumerate(names)), "queue int, _source string")
    tokens = tokens.join(F.broadcast(numbered), F.col("source").eqNullSafe(F.col("_source"))).drop("_source")
    buckets = math.isqrt(tokens.count()) + 1
    placed = tokens.select("row", "n", "queue", F.pmod(F.xxhash64("row"), F.lit(buckets)).alias("bucket"))
    before = Window.partitionBy("queue", "bucket").orderBy("row").rowsBetween(Window.unboundedPreceding, -1)
    placed = placed.withColumn("inner", F.coalesce(F.sum("n").over(before), F.lit(0)))
    earlier = Window.partitionBy("queue").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    bases = tokens.select("n", "queue", F.pmod(F.xxhash64("row"), F.lit(buckets)).alias("bucket"))
    bases = bases.groupBy("queue", "bucket").agg(F.sum("n").alias("n"))
    bases = bases.select("queue", "bucket", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("base"))
    placed = placed.join(bases, ["queue", "bucket"]).select("row", "queue", (F.col("base") + F.col("inner")).alias("place"))

    schema = f"id {kind}, {PIECES}" + (", ids binary" if with_ids else "")
    work = tokens.drop("queue").join(placed, "row").select("id", "queue", "ids", "place")
    shared = spark.sparkContext.broadcast((sizes, quanta))
    return map_arrow(work, _cut(shared, stored, grain, sequence, with_ids), schema).withColumnRenamed("id", id)
