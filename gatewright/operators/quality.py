"""Data-quality suites.

A rule is data: a name, a column and its arguments, plus a function that turns
them into a "this row is bad" column. A suite evaluates all its rules together,
reading its input once whatever the number of rules.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gatewright.functions.numbers import parse_number
from gatewright.functions.labels import full_match

EXISTS = "expect_column_to_exist"
NOT_NULL = "expect_column_values_to_not_be_null"
UNIQUE = "expect_column_values_to_be_unique"
BETWEEN = "expect_column_values_to_be_between"
REGEX = "expect_column_values_to_match_regex"
IN_SET = "expect_column_values_to_be_in_set"
ROW_COUNT = "expect_table_row_count_to_be_between"

BadRow = Callable[[DataFrame, str, Mapping[str, Any]], Column]


@dataclass(frozen=True)
class Expectation:
    kind: str
    column: str | None = None
    args: Mapping[str, Any] = field(default_factory=dict)
    bad_row: BadRow | None = None

    @property
    def label(self) -> str:
        return f"{self.kind}({self.column or ''})"


def column_exists(column: str) -> Expectation:
    return Expectation(EXISTS, column)


def not_null(column: str) -> Expectation:
    return Expectation(NOT_NULL, column, bad_row=lambda df, c, _: is_missing(df, c))


def unique(column: str) -> Expectation:
    return Expectation(UNIQUE, column)


def between(column: str, min_value: float, max_value: float) -> Expectation:
    return Expectation(BETWEEN, column, {"min_value": min_value, "max_value": max_value}, _outside)


def matches(column: str, regex: str) -> Expectation:
    return Expectation(
        REGEX, column, {"regex": regex}, lambda df, c, a: ~full_match(F.col(c).cast("string"), a["regex"])
    )


def in_set(column: str, value_set: Sequence[Any]) -> Expectation:
    return Expectation(IN_SET, column, {"value_set": list(value_set)}, _not_in_set)


def row_count(min_value: int, max_value: int | None = None) -> Expectation:
    """Number of rows; without ``max_value`` there is no upper bound."""
    return Expectation(ROW_COUNT, None, {"min_value": min_value, "max_value": max_value})


def custom(name: str, column: str, bad_row: BadRow, **args: Any) -> Expectation:
    """A rule of your own; ``bad_row`` returns a boolean column, native or a pandas UDF."""
    return Expectation(name, column, args, bad_row)


_FACTORIES = {
    EXISTS: column_exists,
    NOT_NULL: not_null,
    UNIQUE: unique,
    BETWEEN: between,
    REGEX: matches,
    IN_SET: in_set,
    ROW_COUNT: row_count,
}


def suite_from_json(text: str) -> list[Expectation]:
    """Load a suite stored as ``[{"expectation_type": ..., "kwargs": {...}}, ...]``."""
    return [_FACTORIES[rule["expectation_type"]](**rule.get("kwargs", {})) for rule in json.loads(text)]


def _type(df: DataFrame, column: str) -> T.DataType:
    return df.schema[column].dataType


def is_missing(df: DataFrame, column: str) -> Column:
    """Null, or NaN in a floating-point column."""
    col = F.col(column)
    if isinstance(_type(df, column), (T.FloatType, T.DoubleType)):
        return col.isNull() | F.isnan(col)
    return col.isNull()


def _outside(df: DataFrame, column: str, args: Mapping[str, Any]) -> Column:
    col, kind = F.col(column), _type(df, column)
    if isinstance(kind, T.StringType):
        number = parse_number(col)
    elif isinstance(kind, (T.NumericType, T.BooleanType)):
        number = col if isinstance(kind, T.NumericType) else col.cast("int")
    else:
        return F.lit(True)
    bad = ~number.between(args["min_value"], args["max_value"])
    if not isinstance(kind, (T.IntegralType, T.DecimalType, T.BooleanType)):
        bad = bad | F.isnan(number)
    return F.coalesce(bad, F.lit(True))


def _not_in_set(df: DataFrame, column: str, args: Mapping[str, Any]) -> Column:
    kind = _type(df, column)
    if isinstance(kind, T.StringType):
        wanted = [v for v in args["value_set"] if isinstance(v, str)]
    elif isinstance(kind, (T.NumericType, T.BooleanType)):
        # Text never equals a number; no value is converted across types.
        wanted = [v for v in args["value_set"] if isinstance(v, (int, float))]
        if isinstance(kind, T.BooleanType):
            wanted = [bool(v) for v in wanted if v in (0, 1)]
    else:
        wanted = [v for v in args["value_set"] if v is not None]
    found = F.coalesce(F.col(column).isin(wanted), F.lit(False)) if wanted else F.lit(False)
    if any(v is None for v in args["value_set"]):
        found = found | is_missing(df, column)
    return ~found


def _details(rule: Expectation, missing: bool) -> Column:
    """Arguments as text; a rule on an absent column reports none."""
    if missing or not rule.args:
        return F.lit(None).cast("map<string,string>")
    texts = {k: v if isinstance(v, str) else json.dumps(v) for k, v in rule.args.items()}
    return F.create_map(*[F.lit(x) for kv in texts.items() for x in kv])


def _unexpected(df: DataFrame, rule: Expectation, index: int) -> Column:
    n = F.col("n")
    if rule.kind == ROW_COUNT:
        low, high = rule.args["min_value"], rule.args["max_value"]
        inside = n >= low if high is None else n.between(low, high)
        return F.when(inside, 0).otherwise(1).cast("bigint")
    if rule.kind == EXISTS:
        return F.lit(0).cast("bigint")
    return F.col(f"bad_{index}") if rule.column in df.columns else n


def _counts(df: DataFrame, row_rules: Sequence[tuple[int, Expectation]], unique_rules: Sequence[tuple[int, Expectation]]) -> DataFrame:
    """One row: number of rows ``n`` and bad rows ``bad_<i>`` per rule, from one evaluation of ``df``.

    Without uniqueness rules this is a plain aggregation. With them each row
    becomes one typed key per uniqueness rule, grouped with map-side counting;
    the row rules ride along with the first key. Every row of a repeated value
    is bad, and nulls repeat each other.
    """
    flags = {f"bad_{i}": F.coalesce(r.bad_row(df, r.column, r.args), F.lit(False)).cast("bigint") for i, r in row_rules}
    if not unique_rules:
        return df.agg(F.count(F.lit(1)).alias("n"), *[F.coalesce(F.sum(f), F.lit(0)).alias(name) for name, f in flags.items()])

    keys = {f"key_{i}": F.when(~is_missing(df, r.column), F.col(r.column)) for i, r in unique_rules}
    base = df.select(*[c.alias(name) for name, c in {**keys, **flags}.items()])
    lead = next(iter(keys))
    variants = [
        F.struct(
            F.lit(name).alias("rule"),
            *[(F.col(k) if k == name else F.lit(None).cast(base.schema[k].dataType)).alias(k) for k in keys],
            *[(F.col(f) if name == lead else F.lit(0).cast("bigint")).alias(f) for f in flags],
        )
        for name in keys
    ]
    groups = base.select(F.inline(F.array(*variants))).groupBy("rule", *keys).agg(
        F.count(F.lit(1)).alias("copies"), *[F.sum(f).alias(f) for f in flags]
    )

    def total(value: Column) -> Column:
        return F.coalesce(F.sum(value), F.lit(0))

    copies, rule = F.col("copies"), F.col("rule")
    return groups.agg(
        total(F.when(rule == lead, copies)).alias("n"),
        *[total(F.col(f)).alias(f) for f in flags],
        *[total(F.when((rule == k) & (copies > 1), copies)).alias(k.replace("key_", "bad_")) for k in keys],
    )


def run_suite(df: DataFrame, suite: Sequence[Expectation]) -> DataFrame:
    """Evaluate every rule; one result row per rule, in suite order (``pos``)."""
    if not suite:
        return df.sparkSession.createDataFrame([], RESULT_SCHEMA)
    present = set(df.columns)
    row_rules = [(i, r) for i, r in enumerate(suite) if r.bad_row is not None and r.column in present]
    unique_rules = [(i, r) for i, r in enumerate(suite) if r.kind == UNIQUE and r.column in present]
    entries = [
        F.struct(
            F.lit(i).alias("pos"),
            F.lit(r.kind).alias("expectation_type"),
            F.lit(r.column).cast("string").alias("column_name"),
            F.lit(r.kind == ROW_COUNT or r.column in present).alias("column_present"),
            F.col("n").alias("element_count"),
            _unexpected(df, r, i).alias("unexpected_count"),
            _details(r, r.column is not None and r.column not in present).alias("details"),
        )
        for i, r in enumerate(suite)
    ]
    results = _counts(df, row_rules, unique_rules).select(F.inline(F.array(*entries)))
    return results.select(
        "pos",
        "expectation_type",
        "column_name",
        (F.col("column_present") & (F.col("unexpected_count") == 0)).alias("success"),
        "element_count",
        "unexpected_count",
        unexpected_percent(F.col("unexpected_count"), F.col("element_count")).alias("unexpected_percent"),
        "details",
    )


RESULT_SCHEMA = T.StructType(
    [
        T.StructField("pos", T.IntegerType()),
        T.StructField("expectation_type", T.StringType()),
        T.StructField("column_name", T.StringType()),
        T.StructField("success", T.BooleanType()),
        T.StructField("element_count", T.LongType()),
        T.StructField("unexpected_count", T.LongType()),
        T.StructField("unexpected_percent", T.DoubleType()),
        T.StructField("details", T.MapType(T.StringType(), T.StringType())),
    ]
)


def unexpected_percent(bad: Column, total: Column) -> Column:
    """Share of bad rows in percent, four decimals, 0 for an empty table."""
    return F.when(total == 0, F.lit(0.0)).otherwise(F.round(F.try_divide(bad * 100, total), 4))


def suite_statistics(results: DataFrame) -> DataFrame:
    """One row over suite results; an empty suite succeeds with 100 percent."""
    evaluated = F.count(F.lit(1))
    good = F.count_if("success")
    return results.agg(
        (good == evaluated).alias("success"),
        evaluated.alias("evaluated_expectations"),
        good.alias("successful_expectations"),
        (evaluated - good).alias("unsuccessful_expectations"),
        F.when(evaluated == 0, F.lit(100.0)).otherwise(F.round(F.try_divide(good * 100, evaluated), 2)).alias("success_percent"),
    )


def failed_expectations(results: DataFrame) -> DataFrame:
    """One row: labels of failed rules in suite order (at most one per rule of the suite)."""
    label = F.concat("expectation_type", F.lit("("), F.coalesce("column_name", F.lit("")), F.lit(")"))
    failed = F.collect_list(F.when(~F.col("success"), F.struct("pos", label.alias("label"))))
    return results.agg(F.transform(F.sort_array(failed), lambda x: x["label"]).alias("failed_expectations"))


def quality_verdict(results: DataFrame, report_uri: str) -> DataFrame:
    """The verdict row recorded on a dataset version."""
    return failed_expectations(results).select(
        F.when(F.size("failed_expectations") == 0, "passed").otherwise("failed").alias("status"),
        F.lit(report_uri).alias("report_uri"),
        F.col("failed_expectations").alias("failed_checks"),
    )
