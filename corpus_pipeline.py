"""The corpus pipeline over ``documents``.

Five stages, each written as Parquet and read again as the next one's documents:
toxic documents go, of exact copies one stays, of near copies one stays,
personal data is masked, and what is left is packed into token sequences.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tradelens.llm.common import documents, text_or_empty, written
from tradelens.llm.naming import exact_dedup, keep_rows
from tradelens.llm.packing import pack
from tradelens.llm.pii import find_pii, redact
from tradelens.llm.simhash import simhash_dedup
from tradelens.llm.toxicity import THRESHOLD, toxicity


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that score below the threshold; labels of all rows are learned from."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    aside = {c: f"_own_{c}" for c in ("score", "restored") if c in docs.columns}
    scored = toxicity(docs.withColumnsRenamed(aside), labels).where(F.col("score") < THRESHOLD)
    return scored.drop("score", "restored").withColumnsRenamed({v: k for k, v in aside.items()}).select(*docs.columns)


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of texts that are equal without white space, the longest with the smallest id."""
    return keep_rows(docs, exact_dedup(docs))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked by fingerprints of at most four differing bits, that with the smallest id."""
    return keep_rows(docs, simhash_dedup(docs))


def mask_pii(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every span of personal data replaced by its kind in brackets, and n_chars counted anew where it was."""
    found = find_pii(docs.withColumnRenamed("pii", "_pii"), "text")
    hit = F.size("pii") > 0
    found = found.withColumn("text", F.when(hit, redact(text_or_empty(), F.col("pii"))).otherwise(F.col("text")))
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        found = found.withColumn("n_chars", F.when(hit, F.char_length("text").cast(kind)).otherwise(F.col("n_chars")))
    return found.drop("pii").withColumnRenamed("_pii", "pii").select(*docs.columns)


def pack_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row per piece of a sequence, with its ids."""
    return pack(docs).select(
        "doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "ids"
    )


STAGES = [
    ("toxicity", drop_toxic),
    ("exact dedup", drop_copies),
    ("SimHash near-dedup", drop_near_copies),
    ("PII", mask_pii),
    ("packing", pack_documents),
]

#: SQL cannot score, link by bits or tokenise; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows over ``documents``, without the ids themselves."""
    docs = documents(spark, sf_dir)
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"stage-{name.replace(' ', '-')}")
    return docs.drop("ids")
