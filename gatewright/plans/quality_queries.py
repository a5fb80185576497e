"""Data-quality rules and suites on the given tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gatewright.operators import build, quality
from gatewright.plans import suites
from gatewright.plans.dataset_queries import FIRST_LINES_SQL, LINE_KEY, bucket_sql, first_lines, split_sql
from gatewright.plans.registry import Tables, query

RESULT = ["pos", "expectation_type", "column_name", "success", "element_count", "unexpected_count", "unexpected_percent"]


def result_sql(pos: int, kind: str, column: str | None, n: str, bad: str, source: str, ok: str = "true") -> str:
    name = f"'{column}'" if column else "NULL::VARCHAR"
    return f"""SELECT {pos}::INTEGER AS pos, '{kind}' AS expectation_type, {name} AS column_name,
  ({ok}) AND bad = 0 AS success, n AS element_count, bad AS unexpected_count,
  CASE WHEN n = 0 THEN 0.0 ELSE round(100.0 * bad / n, 4) END::DOUBLE AS unexpected_percent
  FROM (SELECT ({n})::BIGINT AS n, ({bad})::BIGINT AS bad FROM {source})"""


def bad_rows_sql(pos: int, kind: str, column: str, condition: str, source: str) -> str:
    return result_sql(pos, kind, column, "count(*)", f"coalesce(sum(CASE WHEN {condition} THEN 1 ELSE 0 END), 0)", source)


def repeats_sql(pos: int, column: str, keys: str, source: str) -> str:
    groups = f"(SELECT count(*) AS c FROM {source} GROUP BY {keys})"
    return result_sql(pos, quality.UNIQUE, column, "sum(c)", "sum(CASE WHEN c > 1 THEN c ELSE 0 END)", groups)


def run(df: DataFrame, *rules: quality.Expectation) -> DataFrame:
    return quality.run_suite(df, list(rules)).select(*RESULT)


@query(
    result_sql(0, quality.EXISTS, "o_orderstatus", "count(*)", "0", "orders")
    + " UNION ALL "
    + result_sql(1, quality.EXISTS, "plate", "count(*)", "0", "orders", ok="false")
)
def expect_column_to_exist(t: Tables) -> DataFrame:
    return run(t.orders, quality.column_exists("o_orderstatus"), quality.column_exists("plate"))


@query(
    bad_rows_sql(0, quality.NOT_NULL, "status", "o_orderstatus = 'P'", "orders")
    + " UNION ALL "
    + bad_rows_sql(1, quality.NOT_NULL, "total", "o_totalprice > 400000 OR o_totalprice < 50000", "orders")
)
def expect_column_values_to_not_be_null(t: Tables) -> DataFrame:
    price = F.col("o_totalprice")
    frame = t.orders.select(
        F.nullif("o_orderstatus", F.lit("P")).alias("status"),
        F.when(price < 50000, F.lit(float("nan"))).when(price <= 400000, price).alias("total"),
    )
    return run(frame, quality.not_null("status"), quality.not_null("total"))


@query(
    repeats_sql(0, "l_orderkey", "l_orderkey", "lineitem")
    + " UNION ALL "
    + repeats_sql(1, "l_extendedprice", "l_extendedprice", "lineitem")
    + " UNION ALL "
    + repeats_sql(2, "flag", "nullif(l_returnflag, 'R')", "lineitem")
)
def expect_column_values_to_be_unique(t: Tables) -> DataFrame:
    frame = t.lineitem.withColumn("flag", F.nullif("l_returnflag", F.lit("R")))
    return run(frame, *[quality.unique(c) for c in ("l_orderkey", "l_extendedprice", "flag")])


@query(
    bad_rows_sql(0, quality.BETWEEN, "c_acctbal", "NOT (c_acctbal BETWEEN 0 AND 9000)", "customer")
    + " UNION ALL "
    + bad_rows_sql(1, quality.BETWEEN, "as_text", "c_mktsegment = 'MACHINERY' OR NOT (c_acctbal BETWEEN 0 AND 9000)", "customer")
)
def expect_column_values_to_be_between(t: Tables) -> DataFrame:
    text = F.when(F.col("c_mktsegment") != "MACHINERY", F.col("c_acctbal").cast("string")).otherwise(
        F.concat(F.col("c_acctbal").cast("string"), F.lit("d"))
    )
    frame = t.customer.withColumn("as_text", text)
    return run(frame, quality.between("c_acctbal", 0, 9000), quality.between("as_text", 0, 9000))


@query(bad_rows_sql(0, quality.REGEX, "p_brand", "NOT regexp_full_match(p_brand, 'Brand#[0-9]')", "part"))
def expect_column_values_to_match_regex(t: Tables) -> DataFrame:
    return run(t.part, quality.matches("p_brand", "Brand#[0-9]"))


@query(
    bad_rows_sql(0, quality.IN_SET, "o_orderstatus", "o_orderstatus NOT IN ('O', 'F')", "orders")
    + " UNION ALL "
    + bad_rows_sql(1, quality.IN_SET, "o_totalprice", "true", "orders")
)
def expect_column_values_to_be_in_set(t: Tables) -> DataFrame:
    return run(t.orders, quality.in_set("o_orderstatus", ["O", "F"]), quality.in_set("o_totalprice", ["1"]))


@query(
    result_sql(0, quality.ROW_COUNT, None, "count(*)", "CASE WHEN count(*) BETWEEN 1 AND 10000000 THEN 0 ELSE 1 END", "events")
    + " UNION ALL "
    + result_sql(1, quality.ROW_COUNT, None, "count(*)", "CASE WHEN count(*) BETWEEN 1 AND 5 THEN 0 ELSE 1 END", "events")
)
def expect_table_row_count_to_be_between(t: Tables) -> DataFrame:
    return run(t.events, quality.row_count(1, 10_000_000), quality.row_count(1, 5))


LINE_SUITE = [
    quality.row_count(1, 10_000_000),
    quality.not_null("l_shipdate"),
    quality.between("l_quantity", 2, 45),
    quality.matches("l_returnflag", "[AN]"),
    quality.in_set("split", suites.SPLITS),
    quality.unique("l_orderkey"),
    quality.column_exists("plate"),
]
CURATED_SQL = f"(SELECT *, {split_sql('b')} AS split FROM (SELECT *, {bucket_sql('l_orderkey::VARCHAR')} AS b FROM ({FIRST_LINES_SQL})))"
LINE_SUITE_SQL = " UNION ALL ".join(
    [
        result_sql(0, quality.ROW_COUNT, None, "count(*)", "CASE WHEN count(*) BETWEEN 1 AND 10000000 THEN 0 ELSE 1 END", CURATED_SQL),
        bad_rows_sql(1, quality.NOT_NULL, "l_shipdate", "l_shipdate IS NULL", CURATED_SQL),
        bad_rows_sql(2, quality.BETWEEN, "l_quantity", "NOT (l_quantity BETWEEN 2 AND 45)", CURATED_SQL),
        bad_rows_sql(3, quality.REGEX, "l_returnflag", "NOT regexp_full_match(l_returnflag, '[AN]')", CURATED_SQL),
        bad_rows_sql(4, quality.IN_SET, "split", "split NOT IN ('train', 'val', 'test')", CURATED_SQL),
        repeats_sql(5, "l_orderkey", "l_orderkey", CURATED_SQL),
        result_sql(6, quality.EXISTS, "plate", "count(*)", "0", CURATED_SQL, ok="false"),
    ]
)


def curated_lines(t: Tables) -> DataFrame:
    return build.hash_split(first_lines(t), "l_orderkey")


def line_results(t: Tables) -> DataFrame:
    return quality.run_suite(curated_lines(t), LINE_SUITE)


@query(LINE_SUITE_SQL)
def run_suite(t: Tables) -> DataFrame:
    return line_results(t).select(*RESULT)


@query(
    f"""SELECT bool_and(success) AS success, count(*)::BIGINT AS evaluated_expectations,
    count(*) FILTER (success)::BIGINT AS successful_expectations,
    count(*) FILTER (NOT success)::BIGINT AS unsuccessful_expectations,
    round(100.0 * count(*) FILTER (success) / count(*), 2)::DOUBLE AS success_percent FROM ({LINE_SUITE_SQL})"""
)
def suite_statistics(t: Tables) -> DataFrame:
    return quality.suite_statistics(line_results(t))


FAILED_SQL = f"""SELECT string_agg(expectation_type || '(' || coalesce(column_name, '') || ')', ';' ORDER BY pos)
 AS failed FROM ({LINE_SUITE_SQL}) WHERE NOT success"""


@query(FAILED_SQL)
def failed_expectations(t: Tables) -> DataFrame:
    return quality.failed_expectations(line_results(t)).select(F.array_join("failed_expectations", ";").alias("failed"))


@query(f"SELECT 'failed' AS status, 'reports/v1' AS report_uri, failed AS failed_checks FROM ({FAILED_SQL}) WHERE failed IS NOT NULL")
def quality_verdict(t: Tables) -> DataFrame:
    return quality.quality_verdict(line_results(t), "reports/v1").withColumn("failed_checks", F.array_join("failed_checks", ";"))


@query(
    """SELECT user_id, count(*)::BIGINT AS n, count(*) FILTER (event_type = 'error')::BIGINT AS bad,
    round(100.0 * count(*) FILTER (event_type = 'error') / count(*), 4)::DOUBLE AS percent FROM events GROUP BY 1"""
)
def unexpected_percent(t: Tables) -> DataFrame:
    counts = t.events.groupBy("user_id").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col("event_type") == "error").alias("bad")
    )
    return counts.withColumn("percent", quality.unexpected_percent(F.col("bad"), F.col("n")))


# Events dressed as plate reads: some plates too long, some confidences above one, some plates missing.
READS_SQL = f"""(SELECT *, {split_sql('b')} AS split FROM (SELECT *, {bucket_sql("coalesce(plate, 'nan')")} AS b FROM (
  SELECT CASE WHEN event_type = 'error' THEN NULL WHEN event_type = 'view' THEN '??' ELSE 'KR ' || user_id::VARCHAR END AS plate,
  'cam-' || (user_id % 7)::VARCHAR AS camera_id, ts::VARCHAR AS captured_at, value / 100 AS confidence FROM events)))"""


def plate_reads(t: Tables) -> DataFrame:
    kind = F.col("event_type")
    reads = t.events.select(
        F.when(kind == "error", F.lit(None)).when(kind == "view", F.lit("??")).otherwise(
            F.concat(F.lit("KR "), F.col("user_id").cast("string"))
        ).alias("plate"),
        F.concat(F.lit("cam-"), (F.col("user_id") % 7).cast("string")).alias("camera_id"),
        F.col("ts").cast("string").alias("captured_at"),
        (F.col("value") / 100).alias("confidence"),
    )
    return build.hash_split(reads, "plate")


@query(
    " UNION ALL ".join(
        [
            result_sql(0, quality.ROW_COUNT, None, "count(*)", "CASE WHEN count(*) BETWEEN 1 AND 10000000 THEN 0 ELSE 1 END", READS_SQL),
            *[
                result_sql(1 + i, quality.EXISTS, c, "count(*)", "0", READS_SQL)
                for i, c in enumerate(("plate", "camera_id", "captured_at", "confidence"))
            ],
            *[bad_rows_sql(5 + i, quality.NOT_NULL, c, f"{c} IS NULL", READS_SQL) for i, c in enumerate(("plate", "camera_id", "captured_at"))],
            bad_rows_sql(8, quality.BETWEEN, "confidence", "NOT (confidence BETWEEN 0 AND 1)", READS_SQL),
            bad_rows_sql(9, quality.REGEX, "plate", f"NOT coalesce(regexp_full_match(plate, '{suites.PLATE_PATTERN}'), false)", READS_SQL),
            bad_rows_sql(10, quality.IN_SET, "split", "split NOT IN ('train', 'val', 'test')", READS_SQL),
        ]
    )
)
def event_suite(t: Tables) -> DataFrame:
    return run(plate_reads(t), *suites.event_suite())
