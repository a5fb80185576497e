"""Catalog rules, the action fold against a sequential model, snapshots."""

import json
import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from gatewright import schemas
from gatewright.operators import catalog
from gatewright.sources import catalog_store, json_entries
from gatewright.sources.keyed_tables import KeyedTable

T0 = datetime(2026, 9, 1)
LOG = "dataset string, version int, ts timestamp, seq long, action string, status string"


def log(spark, steps):
    return spark.createDataFrame([("d", 1, T0 + timedelta(hours=i), i, a, s) for i, (a, s) in enumerate(steps)], LOG)


@pytest.fixture(scope="module")
def one_version(spark):
    return spark.createDataFrame([("d", 1)], "dataset string, version int")


@pytest.mark.parametrize(
    "steps, outcomes, frozen_at",
    [
        ([("freeze", None)], ["quality_not_passed"], None),
        ([("quality", "failed"), ("freeze", None)], ["ok", "quality_not_passed"], None),
        ([("quality", "passed"), ("freeze", None)], ["ok", "ok"], 1),
        ([("quality", "passed"), ("freeze", None), ("quality", "failed"), ("freeze", None)], ["ok", "ok", "frozen", "ok"], 1),
        ([("quality", "passed"), ("quality", "failed"), ("freeze", None)], ["ok", "ok", "quality_not_passed"], None),
        ([("quality", "passed"), ("quality", "maybe"), ("freeze", None)], ["ok", "bad_request", "ok"], 2),
    ],
)
def test_freeze_gate(spark, one_version, steps, outcomes, frozen_at):
    actions = log(spark, steps)
    folded = catalog.fold_actions(actions, one_version, chunk_seconds=3600).orderBy("seq").collect()
    assert [r.outcome for r in folded] == outcomes
    state = catalog.catalog_fold(actions, one_version).first()
    assert state.frozen_at == (None if frozen_at is None else T0 + timedelta(hours=frozen_at))
    assert state.frozen == (frozen_at is not None)


def model(actions, known):
    """The same rules, one action after the other."""
    verdict, frozen, out = {}, set(), {}
    for key, seq, action, status in actions:
        if action == "quality" and status not in ("passed", "failed"):
            out[seq] = "bad_request"
        elif key not in known:
            out[seq] = "not_found"
        elif action == "quality":
            out[seq] = "frozen" if key in frozen else "ok"
            if key not in frozen:
                verdict[key] = status
        else:
            ok = key in frozen or verdict.get(key) == "passed"
            out[seq] = "ok" if ok else "quality_not_passed"
            if ok:
                frozen.add(key)
    return out, verdict, frozen


@pytest.mark.parametrize("chunk_seconds", [60, 3600, 10**9])
def test_fold_equals_sequential_model(spark, chunk_seconds):
    rng = random.Random(chunk_seconds)
    actions = [
        ((f"d{rng.randrange(3)}", rng.randrange(1, 15)), i, *rng.choice([("quality", "passed"), ("quality", "failed"), ("quality", "x"), ("freeze", None), ("freeze", None)]))
        for i in range(1500)
    ]
    known = {(f"d{d}", v) for d in range(3) for v in range(1, 13)}
    rows = [(k[0], k[1], T0 + timedelta(seconds=97 * seq // 10), seq, a, s) for k, seq, a, s in actions]
    df = spark.createDataFrame(rows, LOG)
    versions = spark.createDataFrame(sorted(known), "dataset string, version int")
    outcomes, verdict, frozen = model(actions, known)
    folded = {r.seq: r.outcome for r in catalog.fold_actions(df, versions, chunk_seconds).collect()}
    assert folded == outcomes
    state = {(r.dataset, r.version): r for r in catalog.catalog_fold(df, versions, chunk_seconds).collect()}
    assert {k for k, r in state.items() if r.frozen} == frozen
    assert {k: r.quality.status for k, r in state.items() if r.quality} == verdict


def test_versions_continue_and_come_only_from_the_catalog(spark):
    held = spark.createDataFrame([("a", 1), ("a", 2)], "dataset string, version int")
    rows = [("a", 1, T0), ("a", 2, T0 + timedelta(days=90)), ("b", 3, T0), ("a", 4, T0)]
    requests = spark.createDataFrame(rows, "dataset string, request_id long, requested_at timestamp")
    found = {r.request_id: r.version for r in catalog.assign_versions(requests, held).collect()}
    assert found == {1: 3, 4: 4, 2: 5, 3: 1}
    first = {r.request_id: r.version for r in catalog.assign_versions(requests, held.limit(0)).collect()}
    assert first == {1: 1, 4: 2, 2: 3, 3: 1}


def test_register_is_idempotent_on_uri(spark):
    new = spark.createDataFrame([("u1", 2), ("u1", 1), ("u2", 1)], "uri string, n int")
    existing = spark.createDataFrame([("known", "u2")], "id string, uri string")
    first = {r.uri: r for r in catalog.register_sources(new, existing, ["n"]).collect()}
    again = {r.uri: r for r in catalog.register_sources(new, existing, ["n"]).collect()}
    assert {u: r.id for u, r in first.items()} == {u: r.id for u, r in again.items()}
    assert first["u2"].id == "known" and not first["u2"].created
    assert first["u1"].created and len(first["u1"].id) == 24 and first["u1"].n == 1


def test_create_datasets(spark):
    new = spark.createDataFrame([("a", 1), ("a", 2), ("b", 1)], "name string, o int")
    existing = spark.createDataFrame([("b",)], "name string")
    found = {(r.name, r.o): r.outcome for r in catalog.create_datasets(new, existing, ["o"]).collect()}
    assert found == {("a", 1): "created", ("a", 2): "conflict", ("b", 1): "conflict"}
    ensured = {(r.name, r.o): r.outcome for r in catalog.create_datasets(new, existing, ["o"], ensure=True).collect()}
    assert ensured[("b", 1)] == "ok"


def test_unknown_references_and_lineage(spark):
    datasets = spark.createDataFrame([("d", "direct")], "name string, pii string")
    sources = spark.createDataFrame([("s1", "u1"), ("s2", "u2")], "id string, uri string")
    requests = spark.createDataFrame([(1, "d"), (2, "d"), (3, "x"), (4, "d")], "request_id int, dataset string")
    cited = spark.createDataFrame([(1, "s1"), (2, "s1"), (2, "gone"), (3, "s1")], "request_id int, source_id string")
    found = {r.request_id: r.outcome for r in catalog.validate_version_refs(requests, cited, datasets, sources).collect()}
    assert found == {1: "ok", 2: "not_found", 3: "not_found", 4: "ok"}

    versions = spark.createDataFrame([("d", 1, "abc"), ("d", 2, "def")], "dataset string, version int, git_commit string")
    listed = spark.createDataFrame([("d", 1, 0, "s2"), ("d", 1, 1, "gone"), ("d", 1, 2, "s1"), ("d", 2, 0, "gone")],
        "dataset string, version int, pos int, source_id string")
    rows = catalog.lineage(versions, listed, datasets, sources).orderBy("version", "pos").collect()
    assert [(r.version, r.dataset_pii, r.source_id, r.source_uri) for r in rows] == [
        (1, "direct", "s2", "u2"), (1, "direct", "s1", "u1"), (2, "direct", None, None)
    ]
    assert catalog.lineage(versions, listed, datasets, sources, "d", 1).count() == 2
    for version in (0, -1, 99):
        assert catalog.get_version(versions, "d", version).isEmpty()
    assert catalog.get_dataset(datasets, "nope").isEmpty()


def test_list_sources(spark):
    df = spark.createDataFrame([("b", 1), ("a", 1), ("c", 0)], "id string, created_at int")
    assert [r.id for r in catalog.list_sources(df, 2).collect()] == ["c", "a"]
    assert catalog.list_sources(df, 0).count() == 3 and catalog.list_sources(df, -1).count() == 3


def scanned(frame):
    """Rows that the scans of a collected frame gave out."""
    leaves = frame._jdf.queryExecution().executedPlan().collectLeaves()
    return sum(leaves.apply(k).metrics().apply("numOutputRows").value() for k in range(leaves.size()))


def test_a_look_up_reads_a_small_share(spark):
    versions = spark.range(200_000).selectExpr("concat('d', id % 2000) AS dataset", "cast(id div 2000 AS int) + 1 AS version", "id AS n")
    table = KeyedTable.of(versions, ["dataset", "version"], 8)
    for key in (("d77", 13), ("d1999", 100), ("d1", 1)):
        frame = table.lookup(*key)
        expected = versions.filter((F.col("dataset") == key[0]) & (F.col("version") == key[1])).collect()
        assert frame.collect() == expected and len(expected) == 1
        assert scanned(frame) < 0.2 * 200_000
    assert table.lookup("d77").count() == 100 and table.lookup("none", 1).count() == 0
    again = KeyedTable.open(spark, "dataset STRING, version INT, n BIGINT", ["dataset", "version"], 8, table.path)
    again.append(spark.createDataFrame([("d77", 101, 5)], "dataset string, version int, n bigint"))
    assert again.lookup("d77").count() == 101 and again.lookup("d77", 101).first().n == 5


def exchanges_above(plan, path):
    """Whether the scan of a table stands below an exchange."""
    lines = plan.split("\n")
    at = next(k for k, line in enumerate(lines) if "FileScan" in line and path in line)
    depth, found = lines[at].index("FileScan"), []
    for line in reversed(lines[:at]):
        indent = len(line) - len(line.lstrip(" :+-*(0123456789)"))
        if indent < depth:
            depth = indent
            found.append(line.strip(" :+-"))
    joins = next(k for k, line in enumerate(found) if "Join" in line)
    return any("Exchange" in line for line in found[:joins])


def test_a_stored_catalog_is_not_shuffled(spark):
    rng = random.Random(5)
    sources = spark.createDataFrame([(f"s{k}", f"u{k}") for k in range(50)], "id string, uri string")
    datasets = spark.createDataFrame([(f"d{k}",) for k in range(20)], "name string")
    new = spark.createDataFrame([(f"u{rng.randrange(90)}", k) for k in range(200)] + [(None, 500)], "uri string, at int")
    asked = spark.createDataFrame([(f"d{rng.randrange(40)}", k) for k in range(60)] + [("", 99), (None, 98)], "name string, at int")
    requests = spark.createDataFrame([(k, f"d{k % 30}") for k in range(80)] + [(99, None)], "request_id int, dataset string")
    cited = spark.createDataFrame([(k, f"s{k * 7 % 60}") for k in range(80)], "request_id int, source_id string")
    by_uri, by_id, by_name = KeyedTable.of(sources, ["uri"], 3), KeyedTable.of(sources, ["id"], 5), KeyedTable.of(datasets, ["name"], 3)
    pairs = [
        (catalog.register_sources(new, sources, ["at"]), catalog.register_sources(new, by_uri.rows(), ["at"], 3), [by_uri]),
        (catalog.create_datasets(asked, datasets, ["at"]), catalog.create_datasets(asked, by_name.rows(), ["at"], buckets=3), [by_name]),
        (catalog.validate_version_refs(requests, cited, datasets, sources), catalog.validate_version_refs(requests, cited, by_name.rows(), by_id.rows(), 3, 5), [by_name, by_id]),
    ]
    for plain, stored, tables in pairs:
        plan = stored._sc._jvm.PythonSQLUtils.explainString(stored._jdf.queryExecution(), "simple")
        assert sorted(map(repr, plain.collect())) == sorted(map(repr, stored.collect()))
        for table in tables:
            assert not exchanges_above(plan, table.name)


SNAPSHOT = {
    "sources": {"s1": {"id": "s1", "uri": "u1", "size_bytes": 5, "created_at": "2026-09-01T08:00:00.123456789Z"}},
    "datasets": {"d": {"name": "d", "pii": "direct", "retention_days": 90}},
    "versions": {
        "d": [
            {"dataset": "d", "version": 1, "source_ids": ["s1"], "row_count": 4211, "splits": {"train": 4211}, "frozen": True,
             "quality": {"status": "passed", "report_uri": "r", "failed_checks": []}},
        ]
    },
}


def test_snapshot_import_save_and_reload(spark, tmp_path):
    path = tmp_path / "catalog.json"
    path.write_text(json.dumps(SNAPSHOT, indent=2))
    tables = catalog_store.import_catalog_snapshot(spark, str(path))
    row = tables["versions"].first()
    assert (row.row_count, row.frozen, row.quality.status, row.splits) == (4211, True, "passed", {"train": 4211})
    assert tables["sources"].first().created_at == datetime(2026, 9, 1, 8, 0, 0, 123456)
    root = str(tmp_path / "lake")
    assert catalog_store.save_catalog(tables, root) == 1
    loaded = catalog_store.load_catalog(spark, root)
    assert loaded["version_sources"].first().source_id == "s1"
    request = spark.createDataFrame([("d", 1, T0)], "dataset string, request_id long, requested_at timestamp")
    assert catalog.assign_versions(request, loaded["versions"]).first().version == 2


def large_snapshot(sources, datasets, seed=3):
    """A snapshot whose names and texts are full of commas, brackets, quotes and escapes."""
    import random

    rng = random.Random(seed)
    odd = [",", "{", "}", "[", "]", '"', "\\", '\\"', "\n", "é", "a", '{"id": "x"}, ', ":", " "]
    text = lambda: "".join(rng.choice(odd) for _ in range(rng.randrange(12)))
    ids = [f"s{k}{text()}" for k in range(sources)]
    names = [f"d{k}{text()}" for k in range(datasets)]
    return {
        "versions": {
            n: [
                {"dataset": n, "version": v + 1, "source_ids": rng.sample(ids, min(3, sources)), "row_count": v, "splits": {text() + "x": 1}, "created_by": text(),
                 "quality": {"status": "passed", "report_uri": text(), "failed_checks": [text(), text()]} if v % 2 else None}
                for v in range(rng.randrange(4))
            ] for n in names
        },
        "later": {"sources": {"a": {"id": "no source"}}, "x": [1, [2, {"b": "c, d"}]]},
        "sources": {i: {"id": i, "uri": text(), "size_bytes": k} for k, i in enumerate(ids)},
        "datasets": {n: {"name": n, "owner": text(), "pii": None} for n in names},
        "last": None,
    }


@pytest.mark.parametrize("indent", [None, 2])
def test_one_document_is_read_by_many_tasks(spark, tmp_path, indent):
    written = large_snapshot(60, 40)
    path = tmp_path / "catalog.json"
    path.write_text(json.dumps(written, indent=indent, ensure_ascii=False))
    size = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1000")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    try:
        assert json_entries.fragments(spark, str(path)).rdd.getNumPartitions() > 8
        cut = catalog_store.import_catalog_snapshot(spark, str(path))
        found = {name: sorted(map(repr, rows.collect())) for name, rows in cut.items()}
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
        spark.conf.unset("spark.sql.files.openCostInBytes")
    (tmp_path / "line.json").write_text(json.dumps(written))
    whole = catalog_store.import_catalog_snapshot(spark, str(tmp_path / "line.json"), multiline=False)
    assert found == {name: sorted(map(repr, rows.collect())) for name, rows in whole.items()}
    assert len(found["sources"]) == 60 and len(found["datasets"]) == 40


@pytest.mark.parametrize("text, counts", [("{}", (0, 0, 0)), ('{"sources": {}, "versions": {"d": [], "e": null}, "datasets": null}', (0, 0, 0)), ('{"versions":{"d":[{"dataset":"d"},{"dataset":"d"}]},"sources":{"a":{"id":"a"}}}', (1, 0, 2))])
def test_small_documents(spark, tmp_path, text, counts):
    (tmp_path / "catalog.json").write_text(text)
    tables = catalog_store.import_catalog_snapshot(spark, str(tmp_path / "catalog.json"))
    assert tuple(tables[n].count() for n in ("sources", "datasets", "versions")) == counts


@pytest.mark.parametrize("text", ["{", '{"sources": {"a": {"id": "a"}}', '{"sources": "a}', '{"sources": {"a": {"id" "a"}}}', "}{"])
def test_broken_documents_fail(spark, tmp_path, text):
    (tmp_path / "bad.json").write_text(text)
    with pytest.raises(Exception):
        catalog_store.import_catalog_snapshot(spark, str(tmp_path / "bad.json"))["sources"].collect()


def test_missing_snapshot_is_empty_and_bad_text_fails(spark, tmp_path):
    tables = catalog_store.import_catalog_snapshot(spark, str(tmp_path / "none.json"))
    assert set(tables) == set(schemas.CATALOG) and all(t.isEmpty() for t in tables.values())
    (tmp_path / "bad.json").write_text("{")
    with pytest.raises(Exception):
        catalog_store.import_catalog_snapshot(spark, str(tmp_path / "bad.json"))["sources"].collect()


def test_unpublished_state_is_invisible(spark, tmp_path):
    root = str(tmp_path)
    tables = catalog_store.empty_catalog(spark)
    spark.range(1).write.parquet(f"{root}/sources/run=1")
    assert catalog_store.published_state(spark, root) == 0
    assert catalog_store.save_catalog(tables, root) == 1 and catalog_store.save_catalog(tables, root) == 2
    assert catalog_store.published_state(spark, root) == 2


STORED = "dataset string, version int, quality struct<status: string, report_uri: string>, frozen boolean, frozen_at timestamp"


def test_fold_starts_from_the_stored_state(spark):
    versions = spark.createDataFrame(
        [("d", 1, ("passed", "r1"), True, T0), ("d", 2, ("passed", "r2"), False, None), ("d", 3, ("failed", "r3"), False, None), ("d", 4, None, None, None)], STORED
    )
    steps = [(1, "quality", "failed"), (1, "freeze", None), (2, "freeze", None), (2, "quality", "failed"), (3, "freeze", None), (4, "freeze", None)]
    actions = spark.createDataFrame([("d", v, T0 + timedelta(days=9, hours=i), i, a, s) for i, (v, a, s) in enumerate(steps)], LOG)
    outcomes = {r.seq: r.outcome for r in catalog.fold_actions(actions, versions, chunk_seconds=3600).collect()}
    assert outcomes == {0: "frozen", 1: "ok", 2: "ok", 3: "frozen", 4: "quality_not_passed", 5: "quality_not_passed"}
    state = {r.version: r for r in catalog.catalog_fold(actions, versions).collect()}
    assert {v: (r.frozen, r.frozen_at) for v, r in state.items()} == {
        1: (True, T0), 2: (True, T0 + timedelta(days=9, hours=2)), 3: (False, None), 4: (False, None)
    }
    assert {v: r.quality and tuple(r.quality) for v, r in state.items()} == {1: ("passed", "r1"), 2: ("passed", "r2"), 3: ("failed", "r3"), 4: None}
    assert sorted(r.version for r in catalog.freezable_versions(versions.fillna(False, ["frozen"])).collect()) == [2]


def test_folding_in_two_runs_equals_one(spark):
    rng = random.Random(5)
    rows = [("d", rng.randrange(1, 9), T0 + timedelta(hours=i), i, *rng.choice([("quality", "passed"), ("quality", "failed"), ("freeze", None)])) for i in range(120)]
    versions = spark.createDataFrame([("d", v) for v in range(1, 9)], "dataset string, version int")
    whole = catalog.catalog_fold(spark.createDataFrame(rows, LOG), versions)
    half = catalog.catalog_fold(spark.createDataFrame(rows[:60], LOG), versions)
    both = catalog.catalog_fold(spark.createDataFrame(rows[60:], LOG), half)
    columns = ["version", "quality", "frozen", "frozen_at"]
    assert sorted(map(str, whole.select(columns).collect())) == sorted(map(str, both.select(columns).collect()))


def test_empty_names_are_bad_requests(spark):
    new = spark.createDataFrame([(None, 1), ("", 2), ("a", 3)], "name string, o int")
    found = {r.o: r.outcome for r in catalog.create_datasets(new, new.limit(0), ["o"]).collect()}
    assert found == {1: "bad_request", 2: "bad_request", 3: "created"}
    listed = spark.createDataFrame([(None, 1), ("", 2), ("u", 3)], "uri string, n int")
    known = spark.createDataFrame([], "id string, uri string")
    rows = {r.n: (r.id is None, r.created) for r in catalog.register_sources(listed, known, ["n"]).collect()}
    assert rows == {1: (True, False), 2: (True, False), 3: (False, True)}
