"""Table schemas."""

from __future__ import annotations

# A raw read as it stands in the files: text only, so identifiers keep their leading zeros.
READ_COLUMNS = ("plate", "camera_id", "site", "captured_at", "confidence", "direction")
READ_KEY = ("plate", "camera_id", "captured_at")

SOURCES = (
    "id STRING, kind STRING, camera_id STRING, site STRING, uri STRING, "
    "captured_from TIMESTAMP, captured_to TIMESTAMP, size_bytes BIGINT, created_at TIMESTAMP"
)
DATASETS = "name STRING, description STRING, owner STRING, pii STRING, retention_days INT, created_at TIMESTAMP"
QUALITY = "STRUCT<status: STRING, report_uri: STRING, failed_checks: ARRAY<STRING>, recorded_at: TIMESTAMP>"
VERSIONS = (
    "dataset STRING, version INT, row_count BIGINT, splits MAP<STRING, BIGINT>, storage_uri STRING, git_commit STRING, "
    f"created_by STRING, created_at TIMESTAMP, quality {QUALITY}, frozen BOOLEAN, frozen_at TIMESTAMP, fingerprint STRING"
)
VERSION_SOURCES = "dataset STRING, version INT, pos INT, source_id STRING"
ACTIONS = (
    "dataset STRING, version INT, ts TIMESTAMP, seq BIGINT, action STRING, status STRING, "
    "report_uri STRING, failed_checks ARRAY<STRING>"
)
SAMPLES = "metric STRING, labels MAP<STRING, STRING>, ts TIMESTAMP, value DOUBLE"

CATALOG = {
    "sources": SOURCES,
    "datasets": DATASETS,
    "versions": VERSIONS,
    "version_sources": VERSION_SOURCES,
    "actions": ACTIONS,
}
