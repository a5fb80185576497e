"""The registered query of each corpus operator, applied to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from gatewright.llm import balanced_shards, exact_dedup, hadamard_codes, html_consensus, ngram_join, packing, pii, piece_codec, pq_neardup, token_align, token_files, toxicity, warc
from gatewright.llm.common import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    def register(fn):
        QUERIES[fn.__name__] = fn
        if sql is not None:
            ORACLES[fn.__name__] = sql
        return fn

    return register


@query("""
WITH d AS (
  SELECT doc_id, sha256(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')) AS text_sha256
  FROM documents
)
SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
       doc_id = max(doc_id) OVER same AS kept, text_sha256
FROM d WINDOW same AS (PARTITION BY text_sha256)
""")
def op6_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return exact_dedup.exact_dedup(table(spark, folder, "documents"))


@query()
def op1_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packing.pack_documents(table(spark, folder, "documents"))


@query()
def op7_token_files(spark: SparkSession, folder: str) -> DataFrame:
    return token_files.round_trip(spark, table(spark, folder, "documents"))


@query()
def op3_sentencepiece(spark: SparkSession, folder: str) -> DataFrame:
    return piece_codec.piece_digests(table(spark, folder, "documents"))


@query("""
WITH p AS (SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest FROM pages),
     f AS (SELECT payload_digest, min(page_id) AS first_id FROM p WHERE payload_bytes >= 100 GROUP BY 1)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN first_id <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN first_id <> page_id THEN first_id END AS refers_to
FROM p LEFT JOIN f USING (payload_digest)
""")
def op5_warc(spark: SparkSession, folder: str) -> DataFrame:
    records = warc.archive_pages(spark, table(spark, folder, "pages"))
    return records.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


@query()
def op9_pii(spark: SparkSession, folder: str) -> DataFrame:
    return pii.find_spans(table(spark, folder, "documents"))


@query()
def op2_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    return toxicity.score_documents(docs, toxicity.fit(docs, table(spark, folder, "labels")))


@query()
def op10_html_consensus(spark: SparkSession, folder: str) -> DataFrame:
    return html_consensus.main_text(table(spark, folder, "pages"))


@query()
def op8_pq_neardup(spark: SparkSession, folder: str) -> DataFrame:
    return pq_neardup.near_duplicates(table(spark, folder, "embeddings"))


@query()
def op4_ngram_join(spark: SparkSession, folder: str) -> DataFrame:
    return ngram_join.similar_groups(table(spark, folder, "documents"))


@query()
def op12_token_alignment(spark: SparkSession, folder: str) -> DataFrame:
    return token_align.align_documents(table(spark, folder, "documents"))


def _codes_sql(rounds: int = hadamard_codes.ROUNDS, entries: int = hadamard_codes.ENTRIES, parts: int = hadamard_codes.PARTS) -> str:
    """The rounds written out one after the other, for vectors of one length that ``parts`` divides."""
    steps = [f"""
kept AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY vec_id, embedding) AS r, vec_id, label, len(embedding) // {parts} AS size,
         list_transform(embedding, lambda x: CAST(floor(4096 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
),
cells AS MATERIALIZED (
  SELECT r, (i - 1) // size AS p, (i - 1) % size AS k, x
  FROM (SELECT r, size, unnest(v) AS x, generate_subscripts(v, 1) AS i FROM kept)
),
book0 AS MATERIALIZED (SELECT p, r - 1 AS e, k, x FROM cells WHERE r <= {entries})"""]
    for n in range(rounds + 1):
        steps.append(f"""
near{n} AS MATERIALIZED (
  SELECT r, p, min(s) AS s
  FROM (SELECT c.r, c.p, {{'d': sum((c.x - b.x) * (c.x - b.x)), 'e': b.e}} AS s FROM cells c JOIN book{n} b USING (p, k) GROUP BY c.r, c.p, b.e)
  GROUP BY r, p
)""")
        if n < rounds:
            steps.append(f"""
mean{n} AS MATERIALIZED (SELECT c.p, a.s.e AS e, c.k, sum(c.x) AS total, count(*) AS n FROM cells c JOIN near{n} a USING (r, p) GROUP BY ALL),
book{n + 1} AS MATERIALIZED (
  SELECT p, e, k, CAST(coalesce((total - ((total % n) + n) % n) // n, x) AS BIGINT) AS x FROM book{n} LEFT JOIN mean{n} USING (p, e, k)
)""")
    return f"""WITH {",".join(steps)},
coded AS (
  SELECT vec_id, label, string_agg(printf('%02x', s.e), '' ORDER BY p) AS code, CAST(sum(s.d) AS BIGINT) AS error
  FROM near{rounds} JOIN kept USING (r) GROUP BY r, vec_id, label
)
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error,
       (SELECT sha256(string_agg(CAST(x AS VARCHAR), ',' ORDER BY p, e, k)) FROM book{rounds}) AS codebooks_sha256
FROM coded
"""


@query(_codes_sql())
def op11_hadamard_codes(spark: SparkSession, folder: str) -> DataFrame:
    return hadamard_codes.compress(table(spark, folder, "embeddings"))


@query()
def op13_balanced_shards(spark: SparkSession, folder: str) -> DataFrame:
    return balanced_shards.shard_documents(table(spark, folder, "documents"))
