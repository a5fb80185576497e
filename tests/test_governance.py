"""Admission cases, cost, budget and storage tiers."""

import copy
import json
from datetime import date, datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from gatewright.functions import dates
from gatewright.operators import cost, governance

REGISTRY = "images.plates.test/"


def deployment(**pod_fields):
    """A manifest that breaks no rule, unless ``pod_fields`` say so."""
    worker = {"name": "reader", "image": REGISTRY + "reader@sha256:0f", "resources": {"limits": {"memory": "1Gi", "cpu": "2"}}}
    spec = {"securityContext": {"runAsNonRoot": True, "fsGroup": 7}, "containers": [worker, worker | {"name": "uploader"}]}
    return {"review": {"object": {"kind": "Deployment", "metadata": {"namespace": "gates"}, "spec": {"template": {"spec": spec | pod_fields}}}}}


GOOD = deployment()


def pod(manifest):
    return manifest["review"]["object"]["spec"]["template"]["spec"]


def audit(spark, *manifests, **options):
    rows = [(i, m if isinstance(m, str) else json.dumps(m)) for i, m in enumerate(manifests)]
    parsed = governance.parse_manifests(spark.createDataFrame(rows, "id int, manifest string")).drop("manifest")
    return [r.messages for r in governance.policy_audit(parsed, REGISTRY, **options).orderBy("id").collect()]


def changed(change):
    manifest = copy.deepcopy(GOOD)
    change(manifest)
    return manifest


def one(**fields):
    return {"name": "reader", "image": REGISTRY + "reader:7", "resources": {"limits": {"memory": "64Mi"}}} | fields


@pytest.mark.parametrize(
    "fields, texts",
    [
        ({}, []),
        ({"containers": [one(image="elsewhere.test/reader:7")]}, [governance.FOREIGN_IMAGE % ("elsewhere.test/reader:7", REGISTRY[:-1])]),
        ({"containers": [one(), one(name="b", image=REGISTRY + "b:latest")]}, [governance.MUTABLE_TAG % (REGISTRY + "b:latest")]),
        ({"containers": [one(resources={"limits": {"cpu": "1"}})]}, [governance.NO_MEMORY_LIMIT % "reader"]),
        ({"securityContext": {"runAsNonRoot": False}}, [governance.MAY_RUN_AS_ROOT]),
        ({"containers": [one(image=REGISTRY + "reader")]}, []),
        ({"containers": []}, []),
    ],
)
def test_rules_of_deployments(spark, fields, texts):
    assert audit(spark, deployment(**fields)) == [texts]


def test_unreadable_manifest_is_denied(spark):
    assert len(audit(spark, "{not json")[0]) == 1


def test_a_field_of_another_type_concerns_its_own_rule_only(spark):
    image = "elsewhere.test/reader:latest"
    told = {governance.FOREIGN_IMAGE % (image, REGISTRY[:-1]), governance.MUTABLE_TAG % image, governance.NO_MEMORY_LIMIT % "reader", governance.MAY_RUN_AS_ROOT}
    found = audit(
        spark,
        deployment(securityContext={"runAsNonRoot": "true"}, containers=[{"name": "reader", "image": image}]),
        deployment(securityContext="none", containers=[{"name": "reader", "image": image, "resources": "many"}]),
        deployment(securityContext=[True], containers={"a": {"name": "reader", "image": image, "resources": {"limits": {"memory": False}}}}),
        deployment(containers=[one(resources={"limits": {"memory": 1 << 30}})]),
        deployment(containers=[one(image=5), "text", None, 7]),
        deployment(containers="none", initContainers=3),
        changed(lambda m: m["review"]["object"].update(kind=5, metadata="x", spec=[])),
    )
    assert [set(f) for f in found[:3]] == [told] * 3 and found[3] == [] and found[5] == [] and found[6] == []
    assert found[4].count(governance.FOREIGN_IMAGE % ("5", REGISTRY[:-1])) == 1 and any("<missing>" in m for m in found[4])


def test_annotations_of_any_type(spark):
    def service(**annotations):
        return {"review": {"object": {"kind": "InferenceService", "metadata": {"namespace": "models-prod", "annotations": annotations}, "spec": {}}}}

    named = dict.fromkeys(governance.REQUIRED_ANNOTATIONS, "x")
    first = governance.REQUIRED_ANNOTATIONS[0]
    counts = [len(m) for m in audit(spark, service(**named), service(**named | {first: 7}), service(**named | {first: {"a": [1]}}), service(**named | {first: False}))]
    assert counts == [0, 0, 0, 1]
    listed = service()
    listed["review"]["object"]["metadata"]["annotations"] = ["x"]
    assert [len(m) for m in audit(spark, listed, {"review": {"object": 3}}, {"review": 1}, [], 5)] == [3, 1, 1, 1, 1]


def test_provenance_and_empty_annotation(spark):
    service = {"review": {"object": {"kind": "InferenceService", "metadata": {"namespace": "models-prod", "annotations": {"mlops.io/model-card": ""}},
                                      "spec": {"template": {"spec": {"containers": []}}}}}}
    bare = copy.deepcopy(service)
    del bare["review"]["object"]["metadata"]["annotations"]
    staging = copy.deepcopy(service)
    staging["review"]["object"]["metadata"]["namespace"] = "models"
    assert [len(m) for m in audit(spark, service, bare, staging)] == [2, 3, 0]


def test_init_containers_missing_fields_and_predictor_path(spark):
    init = changed(lambda m: pod(m).update(initContainers=[{"image": None}]))
    twice = changed(lambda m: pod(m).update(initContainers=copy.deepcopy(pod(m)["containers"])))
    predictor = {"review": {"object": {"kind": "InferenceService", "metadata": {}, "spec": {"predictor": {"containers": [{"name": "m", "image": "x:latest"}]}}}}}
    found = audit(spark, init, twice, predictor)
    assert len(found[0]) == 2 and all("<missing>" in m for m in found[0])
    assert found[1] == [] and found[2] == []
    assert len(audit(spark, predictor, pod_paths=("spec.template.spec", "spec.predictor"))[0]) == 3


def test_audit_needs_no_shuffle(spark):
    rows = spark.createDataFrame([(1, json.dumps(GOOD))], "id int, manifest string")
    plan = governance.violations(governance.policy_audit(governance.parse_manifests(rows), REGISTRY))._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan


def test_cost_and_budget(spark):
    lines = spark.createDataFrame(
        [(date(2026, 9, 1), "vm", Decimal("10.10")), (date(2026, 9, 10), "disk", Decimal("5.00")), (date(2026, 9, 10), "vm", Decimal("0.01")), (date(2026, 8, 3), "vm", Decimal("30"))],
        "usage_date date, service string, cost decimal(18,4)",
    )
    assert [(r.service, float(r.cost)) for r in cost.cost_rollup(lines).collect()] == [("vm", 40.11), ("disk", 5.0)]
    months = {r.month: r for r in cost.budget_status(lines, 30, as_of="2026-09-10").collect()}
    september = months[date(2026, 9, 1)]
    assert september.forecast == pytest.approx(15.11 * 3)
    assert (september.over_50_actual, september.over_80_forecast, september.over_100_actual) == (True, True, False)
    assert not months[date(2026, 8, 1)].over_100_actual and months[date(2026, 8, 1)].over_80_forecast


def test_lifecycle_tiers(spark):
    rows = [("raw/a", datetime(2026, 9, 1)), ("raw/b", datetime(2026, 8, 2)), ("raw/c", datetime(2026, 8, 1)), ("raw/d", datetime(2026, 6, 2)), ("raw/e", datetime(2026, 6, 3)), ("cur/f", datetime(2020, 1, 1))]
    df = spark.createDataFrame(rows, "path string, modified timestamp")
    tiers = df.select("path", dates.lifecycle_tier(F.col("path"), F.col("modified"), "2026-09-01").alias("tier")).collect()
    assert [r.tier for r in tiers] == ["hot", "hot", "cool", "delete", "cool", "untouched"]


def test_day_filter_reaches_the_scan(spark, tmp_path):
    df = spark.createDataFrame([(datetime(2026, 9, 1, 5), 1), (datetime(2026, 9, 2), 2)], "ts timestamp, v int")
    df.write.parquet(str(tmp_path / "t"))
    day = dates.day_filter(spark.read.parquet(str(tmp_path / "t")), "ts", "2026-09-01")
    assert [r.v for r in day.collect()] == [1]
    plan = day._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(ts" in plan and "LessThan(ts" in plan
