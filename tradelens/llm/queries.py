"""The registered queries of the training-data operators, and their SQL where SQL can express them."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bytebpe, pii, rankbpe, secrets
from .audit import audit
from .common import documents, shared_dir
from .dac import read_documents, write_tokens
from .naming import exact_dedup
from .neighbours import nearest
from .packing import pack
from .simhash import simhash_dedup
from .toxicity import THRESHOLD, toxicity
from .urls import judge_urls
from .variants import spelling_variants


def op1_url_templates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge_urls(spark.read.parquet(f"{sf_dir}/pages.parquet"))


def op2_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup(documents(spark, sf_dir)).drop("text_hash")


def op3_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), F.col("vec_id") % 100 == 0)


def op4_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash_dedup(documents(spark, sf_dir))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op5_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.find_pii(documents(spark, sf_dir).select("doc_id", "text"))
    return found.select("doc_id", *pii.digest(F.col("pii")))


def held_out(id: str = "doc_id") -> Column:
    """The rows whose labels are never learned from."""
    return F.crc32(F.col(id).cast("string").cast("binary")) % 4 == 2


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    scored = toxicity(docs, labels, learn_from=~held_out())
    return scored.select(
        "doc_id",
        held_out().alias("held_out"),
        "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
    )


def op7_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    texts = bytebpe.decode(bytebpe.encode(documents(spark, sf_dir)))
    return texts.select(
        "doc_id",
        F.floor(F.octet_length("ids") / 4).alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.col("text").cast("binary"), 256).alias("decoded_sha256"),
    )


def op8_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.find_secrets(documents(spark, sf_dir).select("doc_id", "text"))
    return found.select("doc_id", *secrets.digest(F.col("secrets")))


def op9_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = f"{shared_dir(spark)}/tradelens-token-files-{uuid.uuid4().hex}"
    write_tokens(documents(spark, sf_dir), path)
    return read_documents(spark, path)


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = pack(documents(spark, sf_dir), with_ids=False)
    return pieces.select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "queue")


def op11_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))


def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling_variants(documents(spark, sf_dir))


def op13_rank_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = rankbpe.decode(rankbpe.encode(documents(spark, sf_dir)))
    return found.select(
        "doc_id",
        F.floor(F.octet_length("ids") / 4).alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("bytes", 256).alias("decoded_sha256"),
    )


QUERIES = {
    "op1_url_templates": op1_url_templates,
    "op2_exact_dedup": op2_exact_dedup,
    "op3_neighbours": op3_neighbours,
    "op4_simhash": op4_simhash,
    "op5_pii": op5_pii,
    "op6_toxicity": op6_toxicity,
    "op7_byte_bpe": op7_byte_bpe,
    "op8_secrets": op8_secrets,
    "op9_token_files": op9_token_files,
    "op10_packing": op10_packing,
    "op11_filter_audit": op11_filter_audit,
    "op12_spelling_variants": op12_spelling_variants,
    "op13_rank_bpe": op13_rank_bpe,
}

ORACLE_SQL = {
    "op2_exact_dedup": r"""
        WITH t AS (
            SELECT doc_id, length(coalesce(text, '')) AS points,
                   regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS plain
            FROM documents
        )
        SELECT doc_id,
               first_value(doc_id) OVER w AS keep_id,
               count(*) OVER (PARTITION BY plain) AS group_size,
               doc_id = first_value(doc_id) OVER w AS kept,
               sha256(plain) AS text_sha256
        FROM t
        WINDOW w AS (PARTITION BY plain ORDER BY points DESC, doc_id)
    """,
    "op3_neighbours": """
        WITH v AS (
            SELECT vec_id, embedding::DOUBLE[] AS x FROM embeddings
            WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda e: e IS NULL OR NOT isfinite(e))) = 0
              AND len(list_filter(embedding, lambda e: e <> 0)) > 0
        ), d AS (
            SELECT q.vec_id AS query_id, c.vec_id,
                   sqrt(list_sum(list_transform(list_zip(q.x, c.x), lambda p: (p[1] - p[2]) * (p[1] - p[2])))) AS score
            FROM v q JOIN v c ON q.vec_id <> c.vec_id AND len(q.x) = len(c.x)
            WHERE q.vec_id % 100 = 0
        ), r AS (
            SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score, vec_id) AS place FROM d
        )
        SELECT query_id, place::INTEGER AS rank, vec_id, score FROM r WHERE place <= 10
    """,
    "op11_filter_audit": r"""
        WITH words AS (
            SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS text,
                   regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w
            FROM documents
        ), told AS (
            SELECT doc_id, max(coalesce(quality = 1, false)::INT) AS good, max(coalesce(toxic = 1, false)::INT) AS toxic
            FROM labels GROUP BY doc_id
        ), fails AS (
            SELECT w.doc_id, part,
                   len(w) < 100 AS a,
                   100 * len(list_distinct(w)) < 80 * len(w) AS b,
                   100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 10 * length(text) AS c,
                   regexp_matches(text, '[#$%&*|]') AS d,
                   coalesce(w.doc_id > min(w.doc_id) OVER (PARTITION BY text), false) AS e,
                   coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic
            FROM words w LEFT JOIN told t ON w.doc_id = t.doc_id
        ), masks AS (
            SELECT part, [a, b, c, d, e] AS f, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic
            FROM fails GROUP BY ALL
        ), letters AS (SELECT unnest([1, 2, 3, 4, 5]) AS x
        ), orders AS (
            SELECT [p.x, q.x, r.x, s.x, t.x] AS o FROM letters p, letters q, letters r, letters s, letters t
            WHERE len(list_distinct([p.x, q.x, r.x, s.x, t.x])) = 5
        ), steps AS (
            SELECT o, list_aggregate(list_transform(o, lambda x: substr('ABCDE', x, 1)), 'string_agg', '') AS filter_order,
                   unnest([1, 2, 3, 4, 5]) AS step
            FROM orders
        ), met AS (
            SELECT part, filter_order, step, o[step] AS x, n, good, toxic, f[o[step]] AS fails,
                   len(list_filter(o[:step - 1], lambda y: f[y])) > 0 AS gone,
                   len(list_filter(f, lambda y: y)) = 1 AS alone
            FROM masks, steps
        ), counted AS (
            SELECT part, filter_order, step, x,
                   sum(n) FILTER (NOT gone AND NOT fails) AS kept, sum(n) FILTER (fails AND NOT gone) AS removed,
                   sum(n) FILTER (fails AND gone) AS redundant, sum(n) FILTER (fails AND alone) AS unique_fails,
                   sum(good) FILTER (fails AND NOT gone) AS good_lost, sum(toxic) FILTER (fails AND NOT gone) AS toxic_lost
            FROM met GROUP BY ALL
        )
        SELECT part, filter_order, step, coalesce(kept, 0)::BIGINT AS kept, coalesce(removed, 0)::BIGINT AS removed,
               coalesce(redundant, 0)::BIGINT AS redundant, coalesce(unique_fails, 0)::BIGINT AS unique_fails,
               coalesce(good_lost, 0)::BIGINT AS good_lost, coalesce(toxic_lost, 0)::BIGINT AS toxic_lost,
               coalesce(sum(removed) OVER (PARTITION BY part, x), 0)::BIGINT AS shapley
        FROM counted
    """,
    "op12_spelling_variants": r"""
        WITH RECURSIVE runs AS (
            SELECT coalesce(doc_id::VARCHAR, '') AS id,
                   unnest(regexp_extract_all(coalesce(text, ''), '[A-Za-z\x{00C0}-\x{00FF}]+')) AS run
            FROM documents
        ), lowered AS (
            SELECT id, translate(run, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run, count(*) AS c
            FROM runs WHERE length(run) >= 6 GROUP BY ALL
        ), numbered AS (
            SELECT row_number() OVER () AS k, *, hex(encode(id || ':' || run)) AS bytes FROM lowered
        ), zero AS (  -- the checksum register after a byte, bit by bit
            SELECT i AS b, list_reduce([i::UBIGINT] || list_transform(range(8), lambda x: x::UBIGINT),
                lambda v, x: CASE WHEN v % 2 = 1 THEN xor(v >> 1, 3988292384::UBIGINT) ELSE v >> 1 END) AS v
            FROM range(256) r(i)
        ), ahead AS (  -- and after d more zero bytes
            SELECT 0 AS d, b, v FROM zero
            UNION ALL
            SELECT d + 1, a.b, xor(z.v, a.v >> 8) FROM ahead a JOIN zero z ON z.b = a.v % 256
            WHERE d < (SELECT max(length(bytes)) // 2 FROM numbered)
        ), each AS (
            SELECT k, unnest(range(length(bytes) // 2)) AS pos, length(bytes) // 2 AS size, bytes FROM numbered
        ), summed AS (
            SELECT k, xor(bit_xor(v), 4294967295::UBIGINT) AS h
            FROM each JOIN ahead ON d = size - pos - 1
              AND b = CASE WHEN pos < 4 THEN 255 - ('0x' || substr(bytes, 2 * pos + 1, 2))::BIGINT
                           ELSE ('0x' || substr(bytes, 2 * pos + 1, 2))::BIGINT END
            GROUP BY k
        ), altered AS (
            SELECT CASE WHEN h % 199 = 0 THEN substr(run, 1, (h % length(run))::BIGINT) || substr(run, (h % length(run))::BIGINT + 2)
                        ELSE run END AS word, c
            FROM numbered JOIN summed USING (k)
        ), words AS (
            SELECT word, sum(c)::BIGINT AS n FROM altered WHERE length(word) >= 6 GROUP BY word HAVING sum(c) >= 5
        ), places AS (
            SELECT word, unnest(range(length(word))) AS i FROM words
        ), less AS (
            SELECT word, i, length(word) AS l, substr(word, 1, i) || substr(word, i + 2) AS rest FROM places
        ), near AS (
            SELECT DISTINCT a.word, b.word AS near FROM less a JOIN less b ON a.l = b.l AND a.i = b.i AND a.rest = b.rest AND a.word <> b.word
            UNION SELECT a.word, b.word FROM less a JOIN words b ON a.rest = b.word
            UNION SELECT b.word, a.word FROM less a JOIN words b ON a.rest = b.word
        ), ranked AS (
            SELECT p.word, p.near, w.n, count(*) OVER (PARTITION BY p.word) AS n_near,
                   row_number() OVER (PARTITION BY p.word ORDER BY w.n DESC, p.near) AS place
            FROM near p JOIN words w ON w.word = p.near
        ), formed AS (
            SELECT w.word, w.n, coalesce(n_near, 0) AS n_near,
                   CASE WHEN r.n >= 5 * w.n THEN near END AS form, CASE WHEN r.n >= 5 * w.n THEN r.n END AS form_n
            FROM words w LEFT JOIN ranked r ON r.word = w.word AND place = 1
        ), walk AS (
            SELECT word, word AS pos, 0 AS step FROM words
            UNION ALL
            SELECT k.word, f.form, step + 1 FROM walk k JOIN formed f ON f.word = k.pos WHERE f.form IS NOT NULL
        )
        SELECT word, form, arg_max(pos, step) AS root, n, n_near, form_n
        FROM formed JOIN walk USING (word) GROUP BY word, form, n, n_near, form_n
    """,
}
