"""Deduplication, split, CSV reading and the whole daily build."""

import hashlib
import os
import random

import pytest
from pyspark.sql import functions as F

from gatewright.functions import hashing, labels
from gatewright.operators import build
from gatewright.schemas import READ_KEY
from gatewright.functions import positions
from gatewright.sources import curated, events_csv, objects


def test_split_matches_big_integer_modulo(spark):
    texts = ["", "KR 12345", "żółć", "nan", "日本", *[f"p{i}" for i in range(300)]]
    rows = spark.createDataFrame([(t,) for t in texts], "t string").select("t", hashing.split_bucket(F.col("t")).alias("b")).collect()
    assert all(r.b == int(hashlib.sha256(r.t.encode()).hexdigest(), 16) % 100 for r in rows)


def test_missing_key_splits_like_the_text_nan(spark):
    df = build.hash_split(spark.createDataFrame([(None,), ("nan",)], "p string"), "p")
    assert [r.split for r in df.collect()] == ["val", "val"]


def test_split_is_stable_under_repartitioning(spark):
    df = spark.range(500).select(F.col("id").cast("string").alias("p"))
    a = {r.p: r.split for r in build.hash_split(df, "p").collect()}
    b = {r.p: r.split for r in build.hash_split(df.repartition(7, F.rand(1)), "p").collect()}
    assert a == b


def test_dedup_keeps_first_with_null_keys_and_is_idempotent(spark):
    rows = [("a", "c", 2), ("a", "c", 1), (None, "c", 5), (None, "c", 4), ("b", None, 3)]
    df = spark.createDataFrame(rows, "k string, j string, o int")
    once = build.dedup_first(df, ["k", "j"], ["o"])
    assert sorted(once.collect(), key=str) == sorted([("a", "c", 1), (None, "c", 4), ("b", None, 3)], key=str)
    assert build.dedup_first(once, ["k", "j"], ["o"]).count() == 3


def test_dedup_limits_each_key_before_the_shuffle(spark):
    df = spark.range(1000).selectExpr("id % 3 as k", "id as o")
    plan = build.dedup_first(df, ["k"], ["o"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2


def test_summary_and_empty_input(spark):
    df = spark.createDataFrame([("a", 1), ("a", 1), ("b", 1)], "p string, t int")
    row = build.build_summary(df, ["p", "t"], "p", "u").first()
    assert (row.row_count, row.duplicates_removed, sum(row.splits.values())) == (2, 1, 2)
    empty = build.build_summary(df.limit(0), ["p", "t"], "p", "u").first()
    assert (empty.row_count, empty.duplicates_removed, empty.splits) == (0, 0, {})
    with pytest.raises(ValueError):
        build.build_summary(df, ["t"], "p", "u")


def test_fingerprint_ignores_row_order(spark):
    df = spark.range(100).selectExpr("id", "id * 2 as b")
    assert build.fingerprint(df).first() == build.fingerprint(df.orderBy(F.desc("id"))).first()
    assert build.fingerprint(df).first() != build.fingerprint(df.filter("id > 0")).first()


def test_path_parts(spark):
    uris = ["alpr/2026-09-01/gate/cam-1.csv", "s3://raw/alpr/2026-09-01/gate/cam-1.csv", "alpr/2026-09-01/cam.csv", "cam.csv"]
    parts = labels.path_parts(F.col("u"))
    rows = spark.createDataFrame([(u,) for u in uris], "u string").select(*[c.alias(n) for n, c in parts.items()]).collect()
    assert [tuple(r) for r in rows] == [
        ("gate", "cam-1", "2026-09-01"),
        ("gate", "cam-1", "2026-09-01"),
        ("unknown", "cam", "2026-09-01"),
        ("unknown", "cam", None),
    ]


def write(path, text):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as handle:
        handle.write(text)
    return str(path)


def test_csv_columns_are_matched_by_name(spark, tmp_path):
    a = write(f"{tmp_path}/a.csv", "plate,camera_id,confidence\n007,c1,0.5\n,c1,x\n")
    b = write(f"{tmp_path}/b.csv", "confidence,plate,site\n0.25,NA,north\n")
    rows = events_csv.read_events_csv(spark, [a, b]).orderBy(*events_csv.FILE_ORDER).collect()
    assert [(r.plate, r.camera_id, r.confidence, r.site) for r in rows] == [
        ("007", "c1", 0.5, None),
        (None, "c1", None, None),
        ("NA", None, 0.25, "north"),
    ]
    assert rows[0].source_uri.endswith("/a.csv") and rows[2].source_uri.endswith("/b.csv")


def test_discover_lists_only_csv_of_the_day(spark, tmp_path):
    for name in ("alpr/2026-09-01/north/cam-1.csv", "alpr/2026-09-01/north/notes.txt", "alpr/2026-09-02/north/cam-1.csv"):
        write(f"{tmp_path}/{name}", "plate\nx\n")
    rows = objects.discover_objects(spark, str(tmp_path), "2026-09-01").collect()
    assert [(r.object, r.site, r.camera_id, r.day, r["size"]) for r in rows] == [
        ("alpr/2026-09-01/north/cam-1.csv", "north", "cam-1", "2026-09-01", 8)
    ]
    os.makedirs(f"{tmp_path}/alpr/2026-09-03")
    with pytest.raises(objects.NoObjects):
        objects.discover_objects(spark, str(tmp_path), "2026-09-03")


def test_curated_versions_are_written_once(spark, tmp_path):
    df = spark.range(3)
    curated.write_curated(df, str(tmp_path), "d", 1)
    assert curated.read_curated(spark, str(tmp_path), "d", 1, df.schema).count() == 3
    with pytest.raises(Exception, match="(?i)already exists"):
        curated.write_curated(df, str(tmp_path), "d", 1)


SITES = {"gate-north": ["cam-07", "cam-08"], "gate-south": ["cam-11"]}


def day_files(base, day, corrupt):
    """200 distinct reads and 10 repeats per camera; a corrupt day spoils the first three rows after copying."""
    rng = random.Random(7)
    for site, cameras in SITES.items():
        for camera in cameras:
            rows = [
                [f"KR {rng.randrange(10000, 99999)}", camera, site, f"{day}T{i // 60:02d}:{i % 60:02d}:00Z", f"{rng.random() * 0.99:.3f}", rng.choice(["in", "out"])]
                for i in range(200)
            ]
            rows += [list(r) for r in rows[:10]]
            if corrupt:
                rows[0][4], rows[1][0], rows[2][0] = "1.7", "", "??"
            text = "plate,camera_id,site,captured_at,confidence,direction\n" + "".join(",".join(r) + "\n" for r in rows)
            write(f"{base}/alpr/{day}/{site}/{camera}.csv", text)


def test_daily_build(spark, tmp_path):
    from gatewright.plans.daily_build import build_day
    from gatewright.sources.catalog_store import load_catalog

    raw, root = f"{tmp_path}/raw", f"{tmp_path}/lake"
    day_files(raw, "2026-09-01", corrupt=False)
    day_files(raw, "2026-09-02", corrupt=True)

    clean = build_day(spark, raw, "2026-09-01", root, "gate-reads", now="2026-09-01 23:00:00")
    assert (clean.version, clean.row_count, clean.duplicates_removed, clean.frozen, clean.failed) == (1, 600, 30, True, [])
    dirty = build_day(spark, raw, "2026-09-02", root, "gate-reads", now="2026-09-02 23:00:00")
    assert (dirty.version, dirty.row_count, dirty.duplicates_removed, dirty.frozen) == (2, 606, 24, False)
    assert dirty.failed == [
        "expect_column_values_to_not_be_null(plate)",
        "expect_column_values_to_be_between(confidence)",
        "expect_column_values_to_match_regex(plate)",
    ]
    again = build_day(spark, raw, "2026-09-01", root, "gate-reads", now="2026-09-03 23:00:00")
    assert again.version == 3 and again.frozen

    tables = load_catalog(spark, root + "/catalog")
    assert tables["sources"].count() == 6 and tables["datasets"].count() == 1
    versions = {r.version: r for r in tables["versions"].collect()}
    assert [versions[v].frozen for v in (1, 2, 3)] == [True, False, True]
    assert sum(versions[2].splits.values()) == 606
    assert tables["version_sources"].count() == 9
    report = spark.read.json(dirty.report_uri)
    assert sorted(r.unexpected_count for r in report.filter("not success").collect()) == [3, 3, 6]
    assert curated.read_curated(spark, root + "/curated", "gate-reads", 2).select(*READ_KEY).distinct().count() == 606


def test_reader_skips_blank_lines_and_wants_a_header(spark, tmp_path):
    folder = tmp_path / "a day"
    folder.mkdir()
    (folder / "a b.csv").write_text("\n  \nplate,camera_id,confidence\nAA 1,c1,0.5f\n")
    (folder / "c.csv").write_text("﻿confidence,plate,camera_id\n0.25,BB 2,c2\n\n")
    (folder / "d%20.csv").write_text("plate,confidence\nCC 3,1e0\n")
    rows = events_csv.read_events_csv(spark, [str(folder / n) for n in ("a b.csv", "c.csv", "d%20.csv")]).collect()
    assert sorted((r.plate, r.camera_id, r.confidence) for r in rows) == [("AA 1", "c1", None), ("BB 2", "c2", 0.25), ("CC 3", None, 1.0)]
    (folder / "empty.csv").write_text("\n\n")
    with pytest.raises(events_csv.NoHeader):
        events_csv.read_events_csv(spark, [str(folder / "c.csv"), str(folder / "empty.csv")])


def test_many_files_of_three_layouts_are_one_scan(spark, tmp_path):
    layouts = ["plate,camera_id,confidence", "confidence,plate,site", "site,camera_id,plate,confidence"]
    expected = []
    for k in range(60):
        names = layouts[k % 3].split(",")
        rows = [{"plate": f"{k:03d}-{i}", "camera_id": f"c{k}", "site": "north, \"upper\"", "confidence": f"0.{i + 1}"} for i in range(1 + k % 4)]
        quoted = lambda v: '"' + v.replace('"', '\\"') + '"'
        write(f"{tmp_path}/d{k % 7}/f {k}.csv", layouts[k % 3] + "\n" + "".join(",".join(quoted(r[n]) for n in names) + "\n" for r in rows))
        expected += [(r["plate"], r["camera_id"] if "camera_id" in names else None, r["site"] if "site" in names else None, float(r["confidence"])) for r in rows]
    (tmp_path / "d0" / "notes.txt").write_text("no table")
    found = events_csv.read_events_csv(spark, str(tmp_path))
    assert sorted(map(repr, found.select("plate", "camera_id", "site", "confidence").collect())) == sorted(
        map(repr, spark.createDataFrame(expected, "plate string, camera_id string, site string, confidence double").collect())
    )
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("csv") == 1 and "Union" not in plan
    assert found.select("source_uri").distinct().count() == 60


def test_line_breaks_in_quoted_fields(spark, tmp_path):
    write(f"{tmp_path}/a.csv", 'plate,site\n1,"two\nlines"\n2,x\n')
    write(f"{tmp_path}/b.csv", 'site,plate\n"a, b\n\nc",3\n')
    rows = events_csv.read_events_csv(spark, str(tmp_path), multiline=True).collect()
    assert sorted((r.plate, r.site) for r in rows) == [("1", "two\nlines"), ("2", "x"), ("3", "a, b\n\nc")]


@pytest.mark.parametrize("count", [0, 1, 500])
def test_positions_follow_the_order(spark, count):
    rows = spark.range(count).selectExpr("id * 7919 % 499 AS a", "cast(id AS string) AS b").repartition(5)
    found = [(r.pos, r.a, r.b) for r in positions.with_position(rows, ["a", "b"]).orderBy("pos").collect()]
    assert [p for p, *_ in found] == list(range(count)) and [x[1:] for x in found] == sorted(x[1:] for x in found)


def test_curated_csv_is_read_back(spark, tmp_path):
    df = spark.createDataFrame([("001", "x,y")], "a string, b string")
    curated.write_curated(df, str(tmp_path), "d", 1, "csv")
    assert curated.read_curated(spark, str(tmp_path), "d", 1, file_format="csv").collect() == df.collect()


def raw_day(tmp_path, rows=40):
    folder = tmp_path / "raw" / "alpr" / "2026-09-01" / "gate"
    folder.mkdir(parents=True)
    lines = [f"AB {i:04d},cam-1,gate,2026-09-01T00:00:{i % 60:02d}Z,0.9,in" for i in range(rows)]
    (folder / "cam-1.csv").write_text("plate,camera_id,site,captured_at,confidence,direction\n" + "\n".join([*lines, lines[0]]) + "\n")
    return str(tmp_path / "raw")


def test_build_after_a_run_that_died(spark, tmp_path):
    from gatewright.plans.daily_build import build_day
    from gatewright.sources.catalog_store import load_catalog

    raw, root = raw_day(tmp_path), str(tmp_path / "lake")
    spark.range(3).write.parquet(curated.curated_path(f"{root}/curated", "reads", 1))
    spark.range(3).write.json(curated.report_path(f"{root}/curated", "reads", 1))
    spark.range(3).write.parquet(f"{root}/catalog/actions/run=1")
    done = build_day(spark, raw, "2026-09-01", root, "reads", now="2026-09-01 23:00:00", max_rows=None)
    assert (done.version, done.row_count, done.duplicates_removed, done.frozen) == (1, 40, 1, True)
    stored = load_catalog(spark, f"{root}/catalog")
    assert stored["versions"].first().fingerprint and stored["actions"].count() == 2
    bounded = build_day(spark, raw, "2026-09-01", root, "reads", now="2026-09-02 23:00:00", max_rows=39)
    assert bounded.version == 2 and not bounded.frozen
    assert len(list((tmp_path / "lake" / "catalog" / "sources" / "run=2").glob("*.parquet"))) <= 1


def test_build_leaves_an_imported_version_alone(spark, tmp_path):
    import json

    from gatewright.plans.daily_build import build_day
    from gatewright.sources import catalog_store

    held = {"dataset": "old", "version": 1, "source_ids": [], "row_count": 7, "frozen": True, "frozen_at": "2026-01-01T00:00:00Z",
            "quality": {"status": "passed", "report_uri": "r", "failed_checks": [], "recorded_at": "2026-01-01T00:00:00Z"}}
    (tmp_path / "snapshot.json").write_text(json.dumps({"sources": {}, "datasets": {}, "versions": {"old": [held]}}))
    root = str(tmp_path / "lake")
    catalog_store.save_catalog(catalog_store.import_catalog_snapshot(spark, str(tmp_path / "snapshot.json")), f"{root}/catalog")
    before = catalog_store.load_catalog(spark, f"{root}/catalog")["versions"].filter("dataset = 'old'").collect()
    build_day(spark, raw_day(tmp_path), "2026-09-01", root, "reads", now="2026-09-01 23:00:00")
    after = catalog_store.load_catalog(spark, f"{root}/catalog")["versions"].filter("dataset = 'old'").collect()
    assert before == after and after[0].frozen and after[0].quality.status == "passed"
