"""Policy audit, cost and budget on the given tables.

Manifests are written from ``part`` as admission JSON and parsed back; the SQL
states the rules on the columns they were written from.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gatewright.operators import cost, governance
from gatewright.plans.registry import Tables, query

REGISTRY = "registry.example.com/"
KINDS = ("Deployment", "InferenceService", "StatefulSet")

# The facts a manifest is written from; the tag, kind and gaps vary with the part. Some fields have another type than the rules
# expect: a truth value written as text is none, a number is a limit, and a name that is a list is told as it is written.
FACTS_SQL = f"""(SELECT p_partkey,
  CASE p_size % 3 WHEN 0 THEN 'Deployment' WHEN 1 THEN 'InferenceService' ELSE 'StatefulSet' END AS kind,
  CASE WHEN p_size % 2 = 0 THEN 'models-prod' ELSE 'models' END AS namespace,
  CASE WHEN p_partkey % 5 = 0 THEN 'docker.io/' ELSE '{REGISTRY}' END || lower(p_type)
    || CASE WHEN p_partkey % 4 = 0 THEN ':latest' ELSE ':v1' END AS image,
  CASE WHEN p_partkey % 6 <> 0 THEN CASE WHEN p_partkey % 13 = 0 THEN '268435456' ELSE '256Mi' END END AS memory,
  CASE WHEN p_partkey % 7 < 4 AND p_partkey % 11 <> 0 THEN p_partkey % 7 < 3 END AS non_root,
  CASE WHEN p_partkey % 17 = 0 THEN '["api"]' ELSE 'api' END AS main_name,
  p_partkey % 3 = 0 AS has_init, p_partkey % 2 = 0 AS has_card, p_partkey % 9 <> 0 AS has_annotations FROM part)"""


def facts(t: Tables) -> DataFrame:
    key, size = F.col("p_partkey"), F.col("p_size")
    return t.part.select(
        "p_partkey",
        F.when(size % 3 == 0, KINDS[0]).when(size % 3 == 1, KINDS[1]).otherwise(KINDS[2]).alias("kind"),
        F.when(size % 2 == 0, "models-prod").otherwise("models").alias("namespace"),
        F.concat(
            F.when(key % 5 == 0, "docker.io/").otherwise(REGISTRY),
            F.lower("p_type"),
            F.when(key % 4 == 0, ":latest").otherwise(":v1"),
        ).alias("image"),
        F.when(key % 6 != 0, "256Mi").alias("memory"),
        F.when(key % 7 < 4, key % 7 < 3).alias("non_root"),
        (key % 3 == 0).alias("has_init"),
        (key % 2 == 0).alias("has_card"),
        (key % 9 != 0).alias("has_annotations"),
    )


def manifests(t: Tables) -> DataFrame:
    """Admission JSON text per part; the init container repeats the main one's image without a limit."""
    main = F.struct(
        F.lit("api").alias("name"),
        F.col("image"),
        F.struct(F.struct(F.col("memory")).alias("limits")).alias("resources"),
    )
    init = F.struct(F.lit("init").alias("name"), F.col("image"))
    run_id, card = F.lit(governance.REQUIRED_ANNOTATIONS[0]), F.lit(governance.REQUIRED_ANNOTATIONS[2])
    annotations = F.when(
        F.col("has_annotations"),
        F.when(F.col("has_card"), F.create_map(run_id, F.lit(""), card, F.lit("x"))).otherwise(F.create_map(run_id, F.lit("r"))),
    )
    pod = F.struct(
        F.struct(F.col("non_root").alias("runAsNonRoot")).alias("securityContext"),
        F.array(main).alias("containers"),
        F.when(F.col("has_init"), F.array(init)).alias("initContainers"),
    )
    document = F.struct(
        F.struct(
            F.struct(
                "kind",
                F.struct("namespace", annotations.alias("annotations")).alias("metadata"),
                F.struct(F.struct(pod.alias("spec")).alias("template")).alias("spec"),
            ).alias("object")
        ).alias("review")
    )
    text, key = F.to_json(document), F.col("p_partkey")
    text = F.when(key % 11 == 0, F.regexp_replace(text, '"runAsNonRoot":(true|false)', '"runAsNonRoot":"$1"')).otherwise(text)
    text = F.when(key % 13 == 0, F.replace(text, F.lit('"memory":"256Mi"'), F.lit('"memory":268435456'))).otherwise(text)
    text = F.when(key % 17 == 0, F.replace(text, F.lit('"name":"api"'), F.lit('"name":["api"]'))).otherwise(text)
    return facts(t).select("p_partkey", text.alias("manifest"))


def parsed(t: Tables) -> DataFrame:
    return governance.parse_manifests(manifests(t)).drop("manifest")


@query(
    f"""SELECT p_partkey, kind, namespace, non_root, image AS first_image, memory AS first_memory,
    (1 + has_init::INTEGER)::INTEGER AS containers FROM {FACTS_SQL}"""
)
def parse_manifests(t: Tables) -> DataFrame:
    pod = "object.spec.template.spec"
    return parsed(t).select(
        "p_partkey",
        "object.kind",
        "object.metadata.namespace",
        F.col(f"{pod}.securityContext.runAsNonRoot").alias("non_root"),
        F.col(f"{pod}.containers")[0]["image"].alias("first_image"),
        F.col(f"{pod}.containers")[0]["resources"]["limits"]["memory"].alias("first_memory"),
        F.size(governance.all_containers()).alias("containers"),
    )


CONTAINERS_SQL = f"""(SELECT p_partkey, kind, main_name AS container, image, memory AS memory_limit FROM {FACTS_SQL}
  UNION ALL SELECT p_partkey, kind, 'init', image, NULL FROM {FACTS_SQL} WHERE has_init)"""


@query(f"SELECT p_partkey, container, image, memory_limit FROM {CONTAINERS_SQL}")
def flatten_containers(t: Tables) -> DataFrame:
    return governance.flatten_containers(parsed(t))


def told(df: DataFrame, messages: Column) -> DataFrame:
    return df.select("p_partkey", F.explode(F.array_distinct(messages)).alias("message"))


def text_sql(text: str, *values: str) -> str:
    """SQL for a denial text with its placeholders filled."""
    return "'" + text.replace("%s", "{}").format(*[f"' || {v} || '" for v in values]) + "'"


REGISTRY_SQL = f"""SELECT DISTINCT p_partkey, {text_sql(governance.FOREIGN_IMAGE, 'image', f"'{REGISTRY.rstrip('/')}'")} AS message
  FROM {CONTAINERS_SQL} WHERE kind IN ('Deployment', 'InferenceService') AND NOT starts_with(image, '{REGISTRY}')"""
LATEST_SQL = f"""SELECT DISTINCT p_partkey, {text_sql(governance.MUTABLE_TAG, 'image')} AS message
  FROM {CONTAINERS_SQL} WHERE image LIKE '%:latest'"""
NEEDED = ", ".join(f"'{a}'" for a in governance.REQUIRED_ANNOTATIONS)
MISSING_SQL = f"""(SELECT p_partkey, kind, namespace, name FROM {FACTS_SQL}, (SELECT unnest([{NEEDED}]) AS name)
  WHERE NOT (has_annotations AND (name = '{governance.REQUIRED_ANNOTATIONS[0]}' OR (name = '{governance.REQUIRED_ANNOTATIONS[2]}' AND has_card))))"""
PROVENANCE_SQL = f"""SELECT p_partkey, {text_sql(governance.MISSING_ANNOTATION, 'name')} AS message
  FROM {MISSING_SQL} WHERE kind = 'InferenceService' AND namespace = 'models-prod'"""
MEMORY_SQL = f"""SELECT DISTINCT p_partkey, {text_sql(governance.NO_MEMORY_LIMIT, "coalesce(container, '<missing>')")} AS message
  FROM {CONTAINERS_SQL} WHERE memory_limit IS NULL"""
ROOT_SQL = f"""SELECT p_partkey, {text_sql(governance.MAY_RUN_AS_ROOT)} AS message
  FROM {FACTS_SQL} WHERE kind = 'Deployment' AND NOT coalesce(non_root, false)"""


@query(REGISTRY_SQL)
def deny_registry(t: Tables) -> DataFrame:
    return told(parsed(t), governance.deny_registry(REGISTRY))


@query(LATEST_SQL)
def deny_latest_tag(t: Tables) -> DataFrame:
    return told(parsed(t), governance.deny_latest_tag())


@query(PROVENANCE_SQL)
def deny_missing_provenance(t: Tables) -> DataFrame:
    return told(parsed(t), governance.deny_missing_provenance())


@query(MEMORY_SQL)
def deny_no_memory_limit(t: Tables) -> DataFrame:
    return told(parsed(t), governance.deny_no_memory_limit())


@query(ROOT_SQL)
def deny_root(t: Tables) -> DataFrame:
    return told(parsed(t), governance.deny_root())


@query(f"SELECT p_partkey, name AS missing FROM {MISSING_SQL}")
def missing_required_keys(t: Tables) -> DataFrame:
    gaps = governance.missing_required_keys(F.col("object.metadata.annotations"))
    return parsed(t).select("p_partkey", F.explode(gaps).alias("missing"))


@query(
    f"""WITH found AS ({' UNION ALL '.join([REGISTRY_SQL, LATEST_SQL, PROVENANCE_SQL, MEMORY_SQL, ROOT_SQL])})
    SELECT p_partkey, count(message)::INTEGER AS violations, count(message) = 0 AS allowed
    FROM part LEFT JOIN found USING (p_partkey) GROUP BY 1"""
)
def policy_audit(t: Tables) -> DataFrame:
    audited = governance.policy_audit(parsed(t), REGISTRY)
    return audited.select("p_partkey", F.size("messages").alias("violations"), "allowed")


# -------------------------------------------------------------------- cost --


def cost_lines(t: Tables) -> DataFrame:
    """Cost lines: the part type is the service, the ship date the usage date."""
    return t.lineitem.join(t.part, F.col("l_partkey") == F.col("p_partkey")).select(
        F.col("l_shipdate").cast("date").alias("usage_date"),
        F.col("p_type").alias("service"),
        F.col("l_extendedprice").cast(cost.MONEY).alias("cost"),
    )


@query(
    """SELECT p_type AS service, sum(l_extendedprice::DECIMAL(18, 4))::DECIMAL(28, 4) AS cost
    FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1"""
)
def cost_rollup(t: Tables) -> DataFrame:
    return cost.cost_rollup(cost_lines(t))


@query(
    """
SELECT month, actual, round(forecast, 4) AS forecast, spent > 20000000 AS over_50_actual,
  forecast > 32000000 AS over_80_forecast, spent > 40000000 AS over_100_actual
FROM (SELECT date_trunc('month', l_shipdate)::DATE AS month, sum(l_extendedprice::DECIMAL(18, 4))::DECIMAL(28, 4) AS actual,
    sum(l_extendedprice::DECIMAL(18, 4))::DOUBLE AS spent,
    sum(l_extendedprice::DECIMAL(18, 4))::DOUBLE * day(last_day(date_trunc('month', l_shipdate)::DATE))
      / CASE WHEN date_trunc('month', l_shipdate) = DATE '2001-07-01' THEN 20 ELSE day(last_day(date_trunc('month', l_shipdate)::DATE)) END AS forecast
  FROM lineitem WHERE l_shipdate <= TIMESTAMP '2001-07-20' GROUP BY date_trunc('month', l_shipdate))"""
)
def budget_status(t: Tables) -> DataFrame:
    lines = t.lineitem.select(F.col("l_shipdate").alias("usage_date"), F.col("l_extendedprice").alias("cost"))
    return cost.budget_status(lines, 40_000_000, as_of="2001-07-20").withColumn("forecast", F.round("forecast", 4))
