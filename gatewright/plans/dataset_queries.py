"""Dataset-build operators on the given tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gatewright.functions import dates, hashing, labels
from gatewright.operators import build
from gatewright.plans.registry import Tables, query

LINE_KEY = ["l_orderkey", "l_linenumber"]
# The survivor of a repeated key is decided by all remaining columns.
LINE_ORDER = [
    "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate",
]


def bucket_sql(text: str) -> str:
    """SHA-256 modulo 100 as SQL: 8 digits at a time, 16**8 leaves 96."""
    acc = "0"
    for i in range(8):
        acc = f"(({acc}) * 96 + ('0x' || substr(sha256({text}), {1 + 8 * i}, 8))::BIGINT) % 100"
    return f"({acc})::INTEGER"


def split_sql(bucket: str) -> str:
    return f"CASE WHEN {bucket} < 70 THEN 'train' WHEN {bucket} < 85 THEN 'val' ELSE 'test' END"


FIRST_LINES_SQL = f"""
SELECT * EXCLUDE (rn) FROM (
  SELECT *, row_number() OVER (PARTITION BY {', '.join(LINE_KEY)} ORDER BY {', '.join(LINE_ORDER)}) AS rn FROM lineitem
) WHERE rn = 1
"""


def first_lines(t: Tables) -> DataFrame:
    return build.dedup_first(t.lineitem, LINE_KEY, LINE_ORDER)


@query(FIRST_LINES_SQL)
def dedup_first(t: Tables) -> DataFrame:
    return first_lines(t)


@query(f"SELECT doc_id, bucket, {split_sql('bucket')} AS split FROM (SELECT doc_id, {bucket_sql('text')} AS bucket FROM documents)")
def hash_split(t: Tables) -> DataFrame:
    split = build.hash_split(t.documents, "text")
    return split.select("doc_id", hashing.split_bucket(F.col("text")).alias("bucket"), "split")


@query(
    f"""SELECT {split_sql('b')} AS split, count(*)::BIGINT AS "rows"
    FROM (SELECT {bucket_sql('l_partkey::VARCHAR')} AS b FROM lineitem) GROUP BY 1"""
)
def split_counts(t: Tables) -> DataFrame:
    return build.split_counts(build.hash_split(t.lineitem, "l_partkey"))


@query(
    f"""
WITH kept AS (SELECT {split_sql('b')} AS split FROM
  (SELECT DISTINCT l_orderkey, l_linenumber, {bucket_sql('l_orderkey::VARCHAR')} AS b FROM lineitem))
SELECT count(*)::BIGINT AS row_count,
       ((SELECT count(*) FROM lineitem) - count(*))::BIGINT AS duplicates_removed,
       count(*) FILTER (split = 'train')::BIGINT AS train,
       count(*) FILTER (split = 'val')::BIGINT AS val,
       count(*) FILTER (split = 'test')::BIGINT AS test,
       'curated/lineitem/v1' AS storage_uri
FROM kept"""
)
def build_summary(t: Tables) -> DataFrame:
    summary = build.build_summary(t.lineitem, LINE_KEY, "l_orderkey", "curated/lineitem/v1")
    parts = [F.coalesce(F.col("splits")[s], F.lit(0)).cast("bigint").alias(s) for s in ("train", "val", "test")]
    return summary.select("row_count", "duplicates_removed", *parts, "storage_uri")


@query(
    """
SELECT c_name AS name, c_nationkey AS nation, c_acctbal AS balance, c_mktsegment AS segment FROM customer
UNION ALL
SELECT s_name, s_nationkey, s_acctbal, NULL FROM supplier"""
)
def union_by_name(t: Tables) -> DataFrame:
    return build.union_by_name(
        [
            t.customer.selectExpr("c_name AS name", "c_nationkey AS nation", "c_acctbal AS balance", "c_mktsegment AS segment"),
            t.supplier.selectExpr("s_acctbal AS balance", "s_nationkey AS nation", "s_name AS name"),
        ]
    )


@query("SELECT * FROM events WHERE ts >= TIMESTAMP '2024-01-15' AND ts < TIMESTAMP '2024-01-16'")
def day_filter(t: Tables) -> DataFrame:
    return dates.day_filter(t.events, "ts", "2024-01-15")


@query(
    """SELECT o_orderkey, date_trunc('day', o_orderdate)::TIMESTAMP AS captured_from,
    (date_trunc('day', o_orderdate) + INTERVAL 1 DAY)::TIMESTAMP AS captured_to FROM orders"""
)
def capture_interval(t: Tables) -> DataFrame:
    bounds = dates.capture_interval(F.date_format("o_orderdate", "yyyy-MM-dd"))
    return t.orders.select("o_orderkey", *[c.alias(n) for n, c in bounds.items()])


@query(
    """
WITH k AS (SELECT page_id, split(regexp_replace(url, '^[a-z]+://[^/]*/', ''), '/') AS p FROM pages)
SELECT page_id,
       CASE WHEN len(p) > 3 THEN p[3] ELSE 'unknown' END AS site,
       regexp_replace(p[len(p)], '\\.csv$', '') AS camera_id,
       CASE WHEN len(p) > 1 THEN p[2] END AS day
FROM k"""
)
def path_parts(t: Tables) -> DataFrame:
    return t.pages.select("page_id", *[c.alias(n) for n, c in labels.path_parts(F.col("url")).items()])


@query(
    """SELECT o_orderkey,
    CASE WHEN o_orderpriority NOT LIKE '1-%' AND o_orderpriority NOT LIKE '2-%' THEN 'untouched'
         WHEN date_diff('day', o_orderdate::DATE, DATE '2001-06-30') > 90 THEN 'delete'
         WHEN date_diff('day', o_orderdate::DATE, DATE '2001-06-30') > 30 THEN 'cool' ELSE 'hot' END AS tier
    FROM orders"""
)
def lifecycle_tier(t: Tables) -> DataFrame:
    urgent = F.col("o_orderpriority").startswith("1-") | F.col("o_orderpriority").startswith("2-")
    path = F.concat(F.when(urgent, F.lit("raw/")).otherwise(F.lit("curated/")), F.col("o_orderkey").cast("string"))
    return t.orders.select("o_orderkey", dates.lifecycle_tier(path, F.col("o_orderdate"), "2001-06-30").alias("tier"))
