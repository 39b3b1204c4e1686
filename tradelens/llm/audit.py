"""Filter interaction audit: what each of five filters removes, in every order of them.

A document fails some of the filters and may carry labels; both are bits of its
mask. A mask stands for one big integer with a field for each of the 600 steps (120
orders of five filters): 1 in the field of every step that removes the
document, and the same again in two further stretches of fields if it is good or
toxic. Tasks add up the integers of their documents per part; the sums of tasks
are added in rounds; each part's sum is unpacked once. A field is 64 bits wide, so
it cannot overflow into the next before 2^64 documents are counted.

Everything else follows from the fields: what a step keeps is what the steps up
to it have not removed; a filter's failures are what it removes when it comes
first, and those that fail no other are what it removes when it comes last.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from functools import lru_cache
from itertools import permutations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.joins import lookup_join
from .boundaries import flat_texts
from .common import map_arrow, slices, text_or_empty, written

FILTERS = "ABCDE"
MIN_WORDS = 100
DISTINCT_PERCENT = 80
CAPITAL_PERCENT = 10
# Fixed value: the signs of filter D.
SIGNS = "#$%&*|"
_A, _B, _C, _D, _E, _GOOD, _TOXIC = (1 << k for k in range(7))
ORDERS = ["".join(p) for p in permutations(FILTERS)]
STEPS = len(ORDERS) * len(FILTERS)
_FIELD_BYTES = 8
#: Removed, good and toxic fields, and one that counts the documents.
FIELDS = 3 * STEPS + 1
_TEXT_BYTES = 4 << 20
_ROUND = 256  # sums that one sum of the next round takes, about


@lru_cache(maxsize=1)
def packed() -> list[int]:
    """The big integer of each mask; the lowest field is the first."""
    out = []
    for mask in range(1 << 7):
        fields = np.zeros(FIELDS, "<u8")
        fields[-1] = 1
        for o, order in enumerate(ORDERS):
            s = next((s for s, f in enumerate(order) if mask >> FILTERS.index(f) & 1), None)
            if s is not None:
                for k, held in enumerate((True, mask & _GOOD, mask & _TOXIC)):
                    fields[k * STEPS + o * len(FILTERS) + s] = bool(held)
        out.append(int.from_bytes(fields.tobytes(), "little"))
    return out


def unpacked(total: bytes) -> dict[str, np.ndarray]:
    """The audit's columns, a row for each step, from a part's sum."""
    fields = np.frombuffer(total, "<u8").astype(np.int64)
    removed, good, toxic = fields[:-1].reshape(3, len(ORDERS), len(FILTERS))
    which = np.array([[FILTERS.index(f) for f in order] for order in ORDERS])
    fails, unique, shapley = (np.zeros(len(FILTERS), np.int64) for _ in range(3))
    fails[which[:, 0]] = removed[:, 0]
    unique[which[:, -1]] = removed[:, -1]
    np.add.at(shapley, which, removed)
    columns = {
        "kept": fields[-1] - removed.cumsum(axis=1),
        "removed": removed,
        "redundant": fails[which] - removed,
        "unique_fails": unique[which],
        "good_lost": good,
        "toxic_lost": toxic,
        "shapley": shapley[which],
    }
    return {name: values.reshape(-1) for name, values in columns.items()}


def failures(texts: pa.Array) -> np.ndarray:
    """Bits of the filters A to D that each text (null: empty) fails; white space is [\\x20\\x09-\\x0D]."""
    buffer, data, offsets = flat_texts(texts)
    n = len(texts)
    split = pc.ascii_split_whitespace(texts.fill_null(""))
    words = split.flatten()
    ends = split.offsets.to_numpy().astype(np.int64)
    text_of = np.repeat(np.arange(n), np.diff(ends))
    real = pc.binary_length(words).to_numpy(zero_copy_only=False) > 0  # white space around a text leaves empty ones
    text_of = text_of[real]
    coded = words.filter(pa.array(real)).dictionary_encode()
    count = np.bincount(text_of, minlength=n)
    pairs = text_of * max(1, len(coded.dictionary)) + coded.indices.to_numpy()
    distinct = np.bincount(np.unique(pairs) // max(1, len(coded.dictionary)), minlength=n)

    def held(found: np.ndarray) -> np.ndarray:
        upto = np.concatenate(([0], np.cumsum(found, dtype=np.int64)))[offsets]
        return np.diff(upto)

    capitals = held((data >= ord("A")) & (data <= ord("Z")))
    points = held((data & 0xC0) != 0x80)
    signs = held(np.isin(data, np.frombuffer(SIGNS.encode(), np.uint8)))
    out = (count < MIN_WORDS) * _A
    out += (100 * distinct < DISTINCT_PERCENT * count) * _B
    out += (100 * capitals > CAPITAL_PERCENT * points) * _C
    return out + (signs > 0) * _D


def _judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches, 2, _TEXT_BYTES):
        texts = batch.column(2)
        names = [hashlib.sha256(t.as_buffer()).digest() for t in texts.fill_null("").cast(pa.binary())]
        mask = pa.array(failures(texts), pa.int32())
        yield pa.record_batch([batch.column(0), batch.column(1), mask, pa.array(names, pa.binary())], names=["id", "part", "mask", "name"])


def masks(docs: DataFrame, labels: DataFrame, id: str = "doc_id", text: str = "text", part: str = "lang") -> DataFrame:
    """(id, part, mask) per document: the filters it fails, E among them, and its labels.

    A text is known by its SHA-256. Only texts that stand in several rows are
    looked up; those in a thousandth of the rows or more are joined by a
    broadcast of at most 1,000 names, the rest by a shuffle, and so are labels.
    """
    kind = docs.schema[id].dataType.simpleString()
    rows = docs.select(F.col(id).alias("id"), F.coalesce(F.col(part).cast("string"), F.lit("")).alias("part"), text_or_empty(text).alias("text"))
    judged = written(map_arrow(rows, _judge, f"id {kind}, part string, mask int, name binary"), "audit")
    firsts = judged.groupBy("name").agg(F.min("id").alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1")
    firsts = written(firsts.select(F.hex("name").alias("name"), "first", "n"), "audit-firsts")
    hot = firsts.where(F.col("n") * 1000 >= F.lit(judged.count())).select("name")  # at most 1,000
    salt = F.concat_ws(":", "name", F.xxhash64("id", "part"))
    judged = judged.withColumn("name", F.hex("name"))
    found = lookup_join(judged, firsts.select("name", "first"), ["name"], hot, salt)
    copy = F.coalesce(F.col("id") > F.col("first"), F.lit(False))
    found = found.select("id", "part", (F.col("mask") + F.when(copy, _E).otherwise(0)).alias("mask"), F.xxhash64("name").alias("spread"))

    told = labels.where(F.col(id).isNotNull()).groupBy(F.col(id).cast(kind).alias("id")).agg(
        F.max(F.when(F.col("quality") == 1, _GOOD).otherwise(0)).alias("good"),
        F.max(F.when(F.col("toxic") == 1, _TOXIC).otherwise(0)).alias("toxic"),
    )
    # A row without an id has no label; it goes to any task.
    key = [F.col("id").isNull().alias("none"), F.when(F.col("id").isNull(), F.col("spread")).otherwise(F.lit(0)).alias("spread")]
    found = found.select("id", "part", "mask", *key)
    told = told.select("id", F.lit(False).alias("none"), F.lit(0).cast("long").alias("spread"), (F.col("good") + F.col("toxic")).alias("label"))
    joined = found.join(told, ["id", "none", "spread"], "left")
    return joined.select("id", "part", (F.col("mask") + F.coalesce(F.col("label"), F.lit(0))).cast("int").alias("mask"))


def _bytes(total: int) -> bytes:
    return total.to_bytes(FIELDS * _FIELD_BYTES, "little")


def _sums(totals: dict[str, int]) -> pa.RecordBatch:
    return pa.record_batch([pa.array(totals.keys(), pa.string()), pa.array(map(_bytes, totals.values()), pa.binary())], names=["part", "total"])


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One sum for each part of the task's documents (more if a task meets very many parts)."""
    integers, totals = packed(), {}
    for batch in batches:
        for part, mask in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            totals[part] = totals.get(part, 0) + integers[mask]
        if len(totals) > 1000:
            yield _sums(totals)
            totals.clear()
    yield _sums(totals)


def _add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sums of equal parts, which come one after the other."""
    last, total = None, 0
    for batch in batches:
        for part, more in zip(batch.column(0).to_pylist(), batch.column(1)):
            if last is not None and part != last:
                yield _sums({last: total})
                total = 0
            last, total = part, total + int.from_bytes(more.as_buffer(), "little")
    if last is not None:
        yield _sums({last: total})


_SUM = "part string, total binary"


def _added(sums: DataFrame, *keys: Column) -> DataFrame:
    """(part, total): the sums of rows with equal ``keys``, the part among them, one after the other in a task."""
    names = [f"k{i}" for i in range(len(keys))]
    keyed = sums.select("part", "total", *[k.alias(n) for k, n in zip(keys, names)])
    near = keyed.repartition(*names).sortWithinPartitions(*names)
    return map_arrow(near.select("part", "total"), _add, _SUM)


def part_sums(masked: DataFrame) -> DataFrame:
    """(part, total): the sum of the big integers of each part's documents, a row a part."""
    sums = map_arrow(masked.select("part", "mask"), _count, _SUM).withColumn("task", F.spark_partition_id())
    # First in groups of tasks, so that no task adds the sums of all of them.
    groups = _added(sums, F.col("part"), F.pmod(F.xxhash64("task"), F.lit(_ROUND)))
    return _added(groups, F.col("part"))


def _unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    orders = pa.array(np.repeat(ORDERS, len(FILTERS)).tolist(), pa.string())
    steps = pa.array(np.tile(np.arange(1, len(FILTERS) + 1), len(ORDERS)), pa.int32())
    for batch in batches:
        for part, total in zip(batch.column(0).to_pylist(), batch.column(1)):
            found = unpacked(total.as_py())
            columns = [pa.array([part] * STEPS, pa.string()), orders, steps, *map(pa.array, found.values())]
            yield pa.record_batch(columns, names=["part", "filter_order", "step", *found])


def audit(docs: DataFrame, labels: DataFrame, id: str = "doc_id", text: str = "text", part: str = "lang") -> DataFrame:
    """One row per part, order of the filters and step: what the step keeps, removes and loses.

    Null texts are empty ones, null parts the empty string. A repeated row counts
    each time; copies of a text fail E where their id is larger than the smallest
    of that text, so rows of one id are not copies of each other, and a row
    without an id is none and has no label. Of several labels of an id one that
    says 1 counts. An empty table gives an empty result; other columns are not read.
    """
    counts = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")
    schema = ", ".join(["part string, filter_order string, step int", *[f"{c} long" for c in counts]])
    return map_arrow(part_sums(masks(docs, labels, id, text, part)), _unpack, schema)
