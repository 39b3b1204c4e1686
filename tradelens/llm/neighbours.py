"""Nearest neighbours by a block matrix join.

Vectors are packed into blocks with an eight-bit code of each: the vector is
its scale times whole numbers in [-127, 127] plus a rest whose length is known.
A tile is a block of queries against a block of candidates. The product of the
codes is exact: it is summed over slices of ``_SLICE`` components, whose products
are whole numbers below 2 ** 24 in single precision. With the lengths of the
rests it bounds every distance from both sides. Pairs whose lower
bound exceeds the query's k-th smallest upper bound cannot be among its nearest;
the others are computed anew in double precision from the original vectors and
merged by heaps, per tile and then per query. The result is exact.

Candidate blocks stay where they are written. Query blocks come to them by
broadcast, in passes of bounded size, so neither the driver nor a shuffle holds
a copy of the vectors for every tile.
"""

from __future__ import annotations

import heapq
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import map_arrow, written

K = 10
CANDIDATE_ROWS = 8192
QUERY_ROWS = 1024
#: Of query vectors that the driver and every executor hold at once.
PASS_BYTES = 16 << 20
_FILE_BLOCKS = 4
_CHUNK = 64
_SLICE = 1024
_BLOCK = "ids array<bigint>, rows array<bigint>, vectors binary, dim int"


def _pack(rows: int) -> Callable:
    """Blocks of at most ``rows`` vectors, each block of one dimension."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list] = {}

        def block(dim: int) -> pa.RecordBatch:
            ids, numbers, vectors = zip(*held.pop(dim))
            data = np.stack(vectors).astype("<f8").tobytes()
            columns = [pa.array([list(ids)], pa.list_(pa.int64())), pa.array([list(numbers)], pa.list_(pa.int64()))]
            return pa.record_batch(
                [*columns, pa.array([data], pa.binary()), pa.array([dim], pa.int32())], names=["ids", "rows", "vectors", "dim"]
            )

        for batch in batches:
            for i, n, v in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2)):
                vector = v.values.to_numpy(zero_copy_only=False).astype(np.float64)
                here = held.setdefault(len(vector), [])
                here.append((i, n, vector))
                if len(here) == rows:
                    yield block(len(vector))
        for dim in list(held):
            yield block(dim)

    return run


def codes(x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Eight-bit codes, scales, and an upper bound of the length of what the codes leave out."""
    scale = np.abs(x).max(axis=1) / 127
    code = np.rint(x / scale[:, None]).astype(np.int8)
    rest = np.sqrt(((x - code * scale[:, None]) ** 2).sum(axis=1))
    return code, scale, rest * (1 + 1e-9) + np.abs(x).max(axis=1) * 1e-12


def _product(q: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Exact products of eight-bit codes: (rows, components) by (components, columns), both in single precision."""
    out = (q[:, :_SLICE] @ c[:_SLICE]).astype(np.float64)
    for at in range(_SLICE, q.shape[1], _SLICE):
        out += q[:, at : at + _SLICE] @ c[at : at + _SLICE]
    return out


def nearest_in_tile(
    q: np.ndarray, q_rows: np.ndarray, c: np.ndarray, c_rows: np.ndarray, c_ids: np.ndarray, k: int
) -> Iterator[tuple[int, list[tuple[float, int, int]]]]:
    """For each query its nearest in the tile: (distance, id, row), nearest first, itself left out."""
    (qq, qs, qe), (cc, cs, ce) = codes(q), codes(c)
    ccf = cc.astype(np.float32).T.copy()
    c2 = (cc.astype(np.float64) ** 2).sum(axis=1) * cs**2
    q2 = (qq.astype(np.float64) ** 2).sum(axis=1) * qs**2
    for at in range(0, len(q), _CHUNK):
        part = slice(at, at + _CHUNK)
        product = _product(qq[part].astype(np.float32), ccf)
        square = q2[part, None] + c2 - 2 * qs[part, None] * cs * product
        # The square is right to rounding; a slack of that size keeps the bounds safe.
        slack = 1e-6 * np.sqrt(q2[part, None] + c2)
        middle = np.sqrt(np.maximum(square, 0))
        margin = qe[part, None] + ce + slack
        own = q_rows[part, None] == c_rows
        upper = np.where(own, np.inf, middle + margin)
        lower = np.where(own, np.inf, middle - margin)
        bound = np.partition(upper, k - 1, axis=1)[:, k - 1] if upper.shape[1] > k else np.full(len(upper), np.finfo(np.float64).max)
        i, j = np.nonzero(lower <= bound[:, None])
        total = np.zeros(len(i))
        for d in range(q.shape[1]):  # in order of the components: the sum that a plain loop gives
            total += (q[at + i, d] - c[j, d]) ** 2
        distance = np.sqrt(total)
        starts = np.searchsorted(i, np.arange(len(upper) + 1))
        for row in range(len(upper)):
            s = slice(starts[row], starts[row + 1])
            found = zip(distance[s].tolist(), c_ids[j[s]].tolist(), c_rows[j[s]].tolist())
            yield at + row, heapq.nsmallest(k, found)


def _tiles(k: int) -> Callable:
    schema = pa.schema([(n, pa.int64()) for n in ("row", "query_id")] + [("score", pa.float64())] + [(n, pa.int64()) for n in ("vec_id", "vec_row")])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for b in range(batch.num_rows):
                ids, rows, data, dim, c_ids, c_rows, c_data = (batch.column(n)[b] for n in range(7))
                shape = (-1, dim.as_py())
                q, c = (np.frombuffer(x.as_buffer(), "<f8").reshape(shape) for x in (data, c_data))
                ids, rows, c_ids, c_rows = (x.values.to_numpy() for x in (ids, rows, c_ids, c_rows))
                out = [
                    (rows[i], ids[i], d, v, r)
                    for i, found in nearest_in_tile(q, rows, c, c_rows, c_ids, k)
                    for d, v, r in found
                ]
                if out:
                    yield pa.record_batch([pa.array(x, f.type) for x, f in zip(zip(*out), schema)], schema=schema)

    return run


def nearest(
    vectors: DataFrame,
    queries: Column,
    id: str = "vec_id",
    vector: str = "embedding",
    k: int = K,
    candidate_rows: int = CANDIDATE_ROWS,
    query_rows: int = QUERY_ROWS,
    pass_bytes: int = PASS_BYTES,
) -> DataFrame:
    """query_id, rank (from 1), ``id``, score: the ``k`` nearest rows of each row that ``queries`` selects.

    Euclidean distance in double precision, ties to the smaller id, then to the
    row read first; fewer than ``k`` if there are no more. A query's own row is
    no candidate, but other rows of the same id are. Rows whose id is null or
    whose vector is null, empty, zero or holds null or non-finite components
    take no part; vectors of different lengths are never compared. An empty
    table gives an empty result.

    The candidates are read once for each ``pass_bytes`` of query vectors.
    """
    x = F.col(vector).cast("array<double>")
    bad = F.exists(x, lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
    valid = F.col(id).isNotNull() & x.isNotNull() & ~bad & F.exists(x, lambda v: v != 0)
    rows = vectors.where(valid).select(F.col(id).cast("long").alias("id"), queries.alias("asked"), x.alias("x"))
    rows = written(rows.withColumn("row", F.monotonically_increasing_id()).withColumn("size", F.size("x")), "vectors")
    candidates = map_arrow(rows.select("id", "row", "x"), _pack(candidate_rows), _BLOCK)
    candidates = written(candidates, "candidates", rows_per_file=_FILE_BLOCKS)  # tiles are dealt to tasks by file
    candidates = candidates.select("dim", F.col("ids").alias("c_ids"), F.col("rows").alias("c_rows"), F.col("vectors").alias("c_vectors"))
    # Queries are dealt into blocks by number, so that a block is full whatever part of a file they are,
    # and blocks into passes by the task that packs them, as many tasks to each pass.
    asked = rows.where("asked")
    count, components = asked.agg(F.count("*"), F.coalesce(F.sum("size"), F.lit(0))).first()
    passes = max(1, -(-8 * components // pass_bytes))
    parts = passes * max(1, -(-count // (passes * query_rows)))
    asked = map_arrow(asked.select("id", "row", "x").repartition(parts, F.xxhash64("row")), _pack(query_rows), _BLOCK)
    asked = asked.withColumn("number", F.monotonically_increasing_id()).withColumn("pass", F.spark_partition_id() % passes)
    asked = written(asked, "queries")

    def nearest_of_pass(n: int) -> DataFrame:
        # Every candidate block meets every query block of its dimension. It takes their numbers first, so that the
        # join is on a block, not on the dimension that all may share. Spark's estimate of a join knows nothing of
        # the rows that explode makes, so the side that is broadcast is the one without it.
        left = asked.where(F.col("pass") == n).drop("pass")
        numbers = left.groupBy("dim").agg(F.collect_list("number").alias("numbers"))  # a row for each length of vectors
        right = candidates.join(F.broadcast(numbers), "dim").withColumn("number", F.explode("numbers")).drop("numbers")
        work = right.join(F.broadcast(left), ["dim", "number"]).select("ids", "rows", "vectors", "dim", "c_ids", "c_rows", "c_vectors")
        found = map_arrow(work, _tiles(k), "row long, query_id long, score double, vec_id long, vec_row long")
        order = Window.partitionBy("row").orderBy("score", "vec_id", "vec_row")
        found = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
        return found.select("query_id", "rank", F.col("vec_id").alias(id), "score")

    # All of a query's rows are in one pass. One is worked off after the other: together their broadcasts are all queries.
    out = nearest_of_pass(passes - 1)
    for n in range(passes - 1):
        out = out.unionAll(written(nearest_of_pass(n), "nearest"))
    return out
