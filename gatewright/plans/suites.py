"""The plate-read suite."""

from __future__ import annotations

from gatewright.operators.quality import Expectation, between, column_exists, in_set, matches, not_null, row_count

# Accepted plate text, 3 to 10 characters.
PLATE_PATTERN = r"[A-Z0-9][A-Z0-9 \-]{1,8}[A-Z0-9]"
SPLITS = ("train", "val", "test")


def event_suite(min_rows: int = 1, max_rows: int | None = 10_000_000) -> list[Expectation]:
    """The rules of a day of plate reads; ``max_rows`` None lifts the upper bound."""
    return [
        row_count(min_rows, max_rows),
        *[column_exists(c) for c in ("plate", "camera_id", "captured_at", "confidence")],
        *[not_null(c) for c in ("plate", "camera_id", "captured_at")],
        between("confidence", 0.0, 1.0),
        matches("plate", PLATE_PATTERN),
        in_set("split", SPLITS),
    ]
