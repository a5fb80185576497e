"""Rules and suites: parity cases and the scenarios of a clean and a dirty frame."""

import json
import math

import pandas as pd
import pytest
from pyspark.sql import functions as F

from gatewright.operators import quality as q
from gatewright.plans.suites import event_suite

GOOD = [
    ("KR 12345", "cam-07", "2026-09-01T08:00:00Z", 0.98, "train"),
    ("WA 99887", "cam-11", "2026-09-01T08:05:00Z", 0.81, "val"),
]
SCHEMA = "plate string, camera_id string, captured_at string, confidence double, split string"


def results(df, *rules):
    return q.run_suite(df, list(rules)).orderBy("pos").collect()


def bad(df, rule):
    return results(df, rule)[0].unexpected_count


def test_clean_frame_passes(spark):
    rows = results(spark.createDataFrame(GOOD, SCHEMA), *event_suite())
    assert len(rows) == 11 and all(r.success for r in rows)


def test_dirty_frame_reports_every_rule(spark):
    rows = [(GOOD[0][0], *GOOD[0][1:3], 1.7, GOOD[0][4]), (None, *GOOD[1][1:])]
    found = q.run_suite(spark.createDataFrame(rows, SCHEMA), event_suite())
    assert q.failed_expectations(found).first()[0] == [
        "expect_column_values_to_not_be_null(plate)",
        "expect_column_values_to_be_between(confidence)",
        "expect_column_values_to_match_regex(plate)",
    ]
    stats = q.suite_statistics(found).first()
    assert (stats.evaluated_expectations, stats.unsuccessful_expectations, stats.success_percent) == (11, 3, 72.73)
    verdict = q.quality_verdict(found, "r").first()
    assert verdict.status == "failed" and len(verdict.failed_checks) == 3


def test_null_and_nan_both_missing(spark):
    df = spark.createDataFrame([(1.0,), (None,), (math.nan,)], "x double")
    assert bad(df, q.not_null("x")) == 2


def test_unique_counts_every_member_and_nulls_repeat(spark):
    df = spark.createDataFrame([(1.0, "a"), (1.0, "b"), (None, "c"), (math.nan, "c"), (2.0, "c")], "x double, y string")
    rows = results(df, q.unique("x"), q.unique("y"), q.not_null("x"), q.row_count(1, 4))
    assert [r.unexpected_count for r in rows] == [4, 3, 2, 1]
    assert {r.element_count for r in rows} == {5}


@pytest.mark.parametrize(
    "text, ok",
    [("1", True), (" 1 ", True), ("1.0d", False), ("2f", False), ("abc", False), ("1_000", False), (None, False), ("10", True), ("10.01", False), ("NaN", False)],
)
def test_between_on_text(spark, text, ok):
    df = spark.createDataFrame([(text,)], "x string")
    assert bad(df, q.between("x", 0, 10)) == (0 if ok else 1)


def test_between_bounds_are_inclusive_and_infinity_is_a_number(spark):
    df = spark.createDataFrame([(0.0,), (10.0,), (math.nan,), (None,), (math.inf,)], "x double")
    assert bad(df, q.between("x", 0, 10)) == 3
    assert bad(spark.createDataFrame([("inf",)], "x string"), q.between("x", 0, math.inf)) == 0


def test_regex_is_a_full_match(spark):
    df = spark.createDataFrame([("AB1",), ("AB1\n",), ("xAB1",), (None,)], "x string")
    assert bad(df, q.matches("x", "[A-Z]+[0-9]|[a-z]")) == 3


def test_in_set_never_crosses_types(spark):
    df = spark.createDataFrame([(1.0, "a"), (2.0, None)], "x double, y string")
    assert bad(df, q.in_set("x", ["1"])) == 2
    assert bad(df, q.in_set("x", [1])) == 1
    assert bad(df, q.in_set("y", ["a"])) == 1
    assert bad(df, q.in_set("y", ["a", None])) == 0


def test_missing_column(spark):
    df = spark.createDataFrame(GOOD, SCHEMA)
    rules = [q.not_null("z"), q.unique("z"), q.between("z", 0, 1), q.matches("z", "a"), q.in_set("z", [1]), q.column_exists("z")]
    rows = results(df, *rules)
    assert not any(r.success for r in rows)
    assert [r.unexpected_count for r in rows] == [2, 2, 2, 2, 2, 0]
    assert all(r.element_count == 2 and r.details is None for r in rows)


def test_empty_table_and_empty_suite(spark):
    empty = spark.createDataFrame([], SCHEMA)
    rows = results(empty, q.not_null("plate"), q.unique("plate"), q.row_count(1, 5), q.not_null("z"))
    assert [r.unexpected_percent for r in rows] == [0.0] * 4
    assert [r.success for r in rows] == [True, True, False, False]
    stats = q.suite_statistics(q.run_suite(empty, [])).first()
    assert stats.success and stats.success_percent == 100.0


def test_suite_equals_rule_by_rule_and_pandas(spark):
    frame = pd.DataFrame({"k": [i % 7 for i in range(50)], "v": [float(i) for i in range(50)], "s": ["ab"[i % 2] * (i % 3) for i in range(50)]})
    df = spark.createDataFrame(frame)
    suite = [q.unique("k"), q.unique("v"), q.between("v", 5, 40), q.matches("s", "a+"), q.in_set("k", [1, 2]), q.unique("s")]
    fused = [r.unexpected_count for r in results(df, *suite)]
    assert fused == [bad(df, rule) for rule in suite]
    assert fused[0] == int(frame.k.duplicated(keep=False).sum())
    assert fused[2] == int((~frame.v.between(5, 40)).sum())
    assert fused[3] == int((~frame.s.str.fullmatch("a+")).sum())


def test_suite_from_json_and_custom_rule(spark):
    text = json.dumps([{"expectation_type": q.BETWEEN, "kwargs": {"column": "confidence", "min_value": 0.9, "max_value": 1}}])
    even = q.custom("expect_even_length", "plate", lambda df, c, _: F.length(c) % 2 == 1)
    rows = results(spark.createDataFrame(GOOD, SCHEMA), *q.suite_from_json(text), even)
    assert [r.unexpected_count for r in rows] == [1, 0]
    assert rows[0].details == {"min_value": "0.9", "max_value": "1"}


def test_suite_reads_its_input_once(spark):
    df = spark.range(10).selectExpr("id", "id % 3 as k")
    plan = q.run_suite(df, [q.unique("id"), q.unique("k"), q.between("id", 0, 5)])._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Range (0, 10") == 1
