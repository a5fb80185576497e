"""Label and path expressions."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The service's routes, in matching order.
ROUTES = (
    ("GET", "/healthz"),
    ("GET", "/readyz"),
    ("GET", "/metrics"),
    ("POST", "/api/v1/sources"),
    ("GET", "/api/v1/sources"),
    ("POST", "/api/v1/datasets"),
    ("GET", "/api/v1/datasets/{name}"),
    ("POST", "/api/v1/datasets/{name}/versions"),
    ("GET", "/api/v1/datasets/{name}/versions/{version}"),
    ("PUT", "/api/v1/datasets/{name}/versions/{version}/quality"),
    ("POST", "/api/v1/datasets/{name}/versions/{version}/freeze"),
    ("GET", "/api/v1/datasets/{name}/versions/{version}/lineage"),
)

# Domain outcome -> HTTP status; anything else is 500.
OUTCOME_STATUS = {
    "ok": 200,
    "created": 201,
    "bad_request": 400,
    "not_found": 404,
    "conflict": 409,
    "quality_not_passed": 409,
    "frozen": 409,
}


def full_match(col: Column, pattern: str) -> Column:
    """Whole-string regex match; a missing value does not match."""
    return F.coalesce(col.rlike(rf"\A(?:{pattern})\z"), F.lit(False))


def route_template(method: Column, path: Column, routes: Sequence[tuple[str, str]] = ROUTES) -> Column:
    """Bounded route label ``METHOD /pattern`` for a raw path, or ``unmatched``."""
    label = None
    for verb, route in routes:
        # Literal parts are quoted; each {placeholder} stands for one path segment.
        parts = re.split(r"\{\w+\}", route)
        pattern = "[^/]+".join(re.escape(p) for p in parts)
        # A GET route also answers HEAD.
        verbs = ("GET", "HEAD") if verb == "GET" else (verb,)
        hit = method.isin(*verbs) & full_match(path, pattern)
        label = F.when(hit, F.lit(f"{verb} {route}")) if label is None else label.when(hit, F.lit(f"{verb} {route}"))
    return label.otherwise(F.lit("unmatched")) if label is not None else F.lit("unmatched")


def outcome_code(outcome: Column, statuses: Mapping[str, int] = OUTCOME_STATUS) -> Column:
    code = F.lit(None).cast("int")
    for name, status in statuses.items():
        code = F.coalesce(code, F.when(outcome == name, F.lit(status)))
    return F.coalesce(code, F.lit(500))


def label_filter(
    df: DataFrame, labels: str, equal: Mapping[str, str] | None = None, matches: Mapping[str, str] | None = None
) -> DataFrame:
    """Keep series by label: exact values and fully anchored patterns. An absent label reads as empty."""

    def value(name: str) -> Column:
        return F.coalesce(F.element_at(F.col(labels), F.lit(name)), F.lit(""))

    for name, wanted in (equal or {}).items():
        df = df.filter(value(name) == wanted)
    for name, pattern in (matches or {}).items():
        df = df.filter(full_match(value(name), pattern))
    return df


@dataclass(frozen=True)
class Relabel:
    """One rewrite rule over label columns; sources are joined with ``;`` before matching."""

    sources: tuple[str, ...]
    regex: str = "(.*)"
    action: str = "replace"
    target: str | None = None
    replacement: str = "$1"


def relabel(df: DataFrame, rules: Sequence[Relabel]) -> DataFrame:
    for rule in rules:
        joined = F.concat_ws(";", *[F.coalesce(F.col(s).cast("string"), F.lit("")) for s in rule.sources])
        hit = full_match(joined, rule.regex)
        if rule.action == "keep":
            df = df.filter(hit)
        elif rule.action == "replace":
            if rule.target is None:
                raise ValueError("replace needs a target label")
            new = F.regexp_replace(joined, rf"\A(?:{rule.regex})\z", rule.replacement)
            old = F.col(rule.target) if rule.target in df.columns else F.lit(None).cast("string")
            df = df.withColumn(rule.target, F.when(hit, new).otherwise(old))
        else:
            raise ValueError(f"unknown relabel action {rule.action!r}")
    return df


def clamp_min(value: Column, floor: float = 0.001) -> Column:
    """Raise values below ``floor`` to it; a missing value stays missing."""
    return F.when(value.isNotNull(), F.greatest(value, F.lit(floor)))


def alert_text(template: str, **columns: Column) -> Column:
    """Fill ``{name}`` placeholders of a summary text with label values."""
    pieces = []
    for piece in re.split(r"(\{\w+\})", template):
        if re.fullmatch(r"\{\w+\}", piece):
            pieces.append(F.coalesce(columns[piece[1:-1]].cast("string"), F.lit("")))
        elif piece:
            pieces.append(F.lit(piece))
    return F.concat(*pieces)


def path_parts(uri: Column) -> dict[str, Column]:
    """``site``, ``camera_id`` and ``day`` of an object URI shaped ``<root>/<day>/<site>/<camera>.csv``.

    Scheme and bucket are dropped first. Shorter paths have site ``unknown``.
    """
    key = F.regexp_replace(uri, r"\A[A-Za-z][A-Za-z0-9+.-]*://[^/]*/", "")
    parts = F.split(key, "/")
    return {
        "site": F.when(F.size(parts) > 3, F.get(parts, F.lit(2))).otherwise(F.lit("unknown")),
        "camera_id": F.regexp_replace(F.element_at(parts, -1), r"\.csv\z", ""),
        "day": F.when(F.size(parts) > 1, F.get(parts, F.lit(1))),
    }
