"""Helpers shared by the operators: written intermediate tables, clean columns, Arrow batches."""

from __future__ import annotations

import io
import tempfile
import uuid
import zipfile
from collections.abc import Callable, Iterator
from pathlib import Path

import pyarrow as pa
import pyarrow.compute
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def shared_dir(spark: SparkSession) -> str:
    """The shared folder that the cluster names in ``spark.checkpoint.dir``.

    A local master without the setting gets a private folder (driver and
    executors are one process there); any other master without it is an error.
    """
    sc = spark.sparkContext
    configured = sc.getConf().get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if configured:
        return configured
    if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    sc.setCheckpointDir(tempfile.mkdtemp(prefix="tradelens-shared-"))
    return sc.getCheckpointDir()


def written(df: DataFrame, name: str, rows_per_file: int | None = None) -> DataFrame:
    """Write ``df`` to a fresh folder of the shared directory and read it back.

    Cuts the lineage in a way that outlives any executor. Each call writes its
    own folder, so nothing is ever reused between calls, sessions or inputs.
    Large rows need ``rows_per_file``: Parquet looks at its buffer's size only
    after 100 rows, and a task reads a whole row group at least.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/tradelens-{name}-{uuid.uuid4().hex}"
    writer = df.write.option("maxRecordsPerFile", rows_per_file) if rows_per_file else df.write
    writer.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def put(spark: SparkSession, name: str, data: bytes) -> str:
    """Write a small file into the shared folder; its path."""
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{shared_dir(spark)}/{name}")
    out = path.getFileSystem(spark._jsc.hadoopConfiguration()).create(path)
    out.write(bytearray(data))
    out.close()
    return path.toString()


_SHIPPED: set[str] = set()


def _ship_package(spark: SparkSession) -> None:
    """Send this package to the executors' Python workers, once per application."""
    app = spark.sparkContext.applicationId
    if app in _SHIPPED:
        return
    root, data = Path(__file__).resolve().parents[1], io.BytesIO()
    with zipfile.ZipFile(data, "w") as z:
        for f in sorted(root.rglob("*.py")):
            z.write(f, f.relative_to(root.parent))
    spark.sparkContext.addPyFile(put(spark, f"tradelens-{uuid.uuid4().hex}.zip", data.getvalue()))
    _SHIPPED.add(app)


def map_arrow(df: DataFrame, function: Callable, schema: str) -> DataFrame:
    """``df.mapInArrow`` with this package at hand in the workers."""
    _ship_package(df.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from function(batches)
        pa.default_memory_pool().release_unused()  # the worker lives on for other tasks

    return df.mapInArrow(run, schema)


def text_or_empty(column: str = "text") -> Column:
    """The text with null as the empty string."""
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def slices(batches: Iterator[pa.RecordBatch], text: int, max_bytes: int = 8 << 20) -> Iterator[pa.RecordBatch]:
    """Cut Arrow batches so that the text column of each piece stays near ``max_bytes``.

    A piece always holds at least one row, so a single longer text is still whole.
    """
    for batch in batches:
        sizes = pa.compute.binary_length(batch.column(text)).fill_null(0).to_numpy(zero_copy_only=False)
        start = 0
        total = 0
        for i, size in enumerate(sizes.tolist()):
            if total and total + size > max_bytes:
                yield batch.slice(start, i - start)
                start, total = i, 0
            total += size
        if batch.num_rows > start:
            yield batch.slice(start)
