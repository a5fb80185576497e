"""The versioned dataset catalog as tables.

Tables: ``sources`` (one row per uri), ``datasets`` (one row per name),
``versions`` (dataset, version, ...), ``version_sources`` (dataset, version,
pos, source_id) and ``actions``, the log of quality verdicts and freezes with a
total order (``ts``, ``seq``). Lists of sources are kept as rows, so a version
with very many sources is never gathered into one record.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, WindowSpec
from pyspark.sql import functions as F

from gatewright.functions.chunks import (
    BURST_ROWS,
    CHUNK,
    LEAD,
    by_chunk,
    in_chunk,
    ordered_scan,
    rows_before,
    with_opening,
    with_order_chunk,
    without_leads,
)
from gatewright.functions.hashing import source_id
from gatewright.operators.build import dedup_first

DAY = 86_400
VERSION_KEY = ("dataset", "version")


def _meeting(rows: DataFrame, column: str, stored: DataFrame, buckets: int | None) -> tuple[DataFrame, DataFrame]:
    """Both sides of a join by ``column``. A side stored in ``buckets`` stays where it lies, the other is dealt to them."""
    return (rows, stored) if buckets is None else (rows.repartition(buckets, column), stored.hint("merge"))


def register_sources(new: DataFrame, existing: DataFrame, order: Sequence[str], buckets: int | None = None) -> DataFrame:
    """Ids for newly listed sources: a known uri keeps its id, an unknown one gets a new id.

    ``buckets`` says that ``existing`` is stored by uri in so many buckets; it is
    then not shuffled.

    Repeats of a uri within ``new`` collapse to the first in ``order``.
    ``created`` tells which rows must be appended to the ``sources`` table.
    A source without uri is a bad request: it gets no id and is not created.
    """
    named = F.coalesce(F.col("uri"), F.lit("")) != ""
    first = dedup_first(new, ["uri"], order)
    known = existing.select("uri", F.col("id").alias("known_id"))
    here, there = _meeting(first, "uri", known, buckets)
    return here.join(there, "uri", "left").select(
        F.when(named, F.coalesce("known_id", source_id(F.col("uri")))).alias("id"),
        *first.columns,
        (F.col("known_id").isNull() & named).alias("created"),
    )


def create_datasets(new: DataFrame, existing: DataFrame, order: Sequence[str], ensure: bool = False, buckets: int | None = None) -> DataFrame:
    """Outcome per requested dataset: ``created`` or, when the name is taken, ``conflict``.

    The first request for a name wins; later ones in the same batch conflict.
    With ``ensure`` a taken name counts as ``ok``. A missing or empty name is a
    ``bad_request``. ``buckets`` says that ``existing`` is stored by name in so
    many buckets; it is then not shuffled.
    """
    taken = "ok" if ensure else "conflict"
    names = existing.select("name", F.lit(True).alias("exists"))
    here, there = _meeting(dedup_first(new, ["name"], order).select("name", *order), "name", names, buckets)
    winners = (
        here.join(there, "name", "left")
        .select("name", *order, F.coalesce(~F.col("exists"), F.lit(True)).alias("free"))
    )
    # ``order`` belongs to the join key, so a name requested very often is spread over tasks.
    nameless = F.coalesce(F.col("name"), F.lit("")) == ""
    outcome = F.when(nameless, F.lit("bad_request")).when(F.col("free"), F.lit("created")).otherwise(F.lit(taken))
    return new.join(winners, ["name", *order], "left").select(*new.columns, outcome.alias("outcome"))


def validate_version_refs(
    requests: DataFrame,
    request_sources: DataFrame,
    datasets: DataFrame,
    sources: DataFrame,
    dataset_buckets: int | None = None,
    source_buckets: int | None = None,
) -> DataFrame:
    """``ok`` or ``not_found`` per version request (``request_id``, ``dataset``, ...).

    ``request_sources`` has one row per (request_id, source_id). Ids and names are
    made distinct before they meet the catalog, so one that very many requests
    cite is looked up once. Sides of the catalog that are stored in buckets, by
    name and by id, are not shuffled if their numbers of buckets are given.
    """
    cited, held = _meeting(request_sources.select("source_id").distinct(), "source_id", sources.select(F.col("id").alias("source_id")), source_buckets)
    unknown = cited.join(held, "source_id", "left_anti")
    broken = (
        request_sources.join(unknown, "source_id", "left_semi").select("request_id").distinct()
        .withColumn("broken", F.lit(True))
    )
    named, stored = _meeting(requests.select("dataset").distinct(), "dataset", datasets.select(F.col("name").alias("dataset")), dataset_buckets)
    known = named.join(stored, "dataset", "left_semi").withColumn("known", F.lit(True))
    ok = F.col("broken").isNull() & F.col("known").isNotNull()
    return (
        requests.join(broken, "request_id", "left")
        .join(known, "dataset", "left")
        .select(*requests.columns, F.when(ok, F.lit("ok")).otherwise(F.lit("not_found")).alias("outcome"))
    )


def assign_versions(
    requests: DataFrame, versions: DataFrame, chunk_seconds: int = 30 * DAY, burst_rows: int = BURST_ROWS
) -> DataFrame:
    """Number accepted requests per dataset, continuing after the versions already held.

    ``requests`` needs ``dataset``, ``requested_at`` and ``request_id``; the
    number never comes from the caller.
    """
    held = versions.groupBy("dataset").agg(F.max("version").alias("held"))
    # The count already held enters the scan as one earliest row per dataset.
    chunked = with_order_chunk(requests, ["dataset"], "requested_at", "request_id", chunk_seconds, burst_rows)
    numbered = chunked.withColumns({"__step": F.lit(1).cast("bigint"), "__held": F.lit(False)})
    base = held.select(
        "dataset",
        F.col("held").cast("bigint").alias("__step"),
        F.lit(True).alias("__held"),
    )
    stacked = numbered.unionByName(base, allowMissingColumns=True)
    # Held rows carry no time and no chunk: both orders put them first.
    scanned = ordered_scan(
        stacked, ["dataset"], ["requested_at", "request_id"], F.col(CHUNK), sum_upto={"__number": F.col("__step")}
    )
    return scanned.filter(~F.col("__held")).select(*requests.columns, F.col("__number").cast("int").alias("version"))


def fold_actions(
    actions: DataFrame, versions: DataFrame, chunk_seconds: int = DAY, burst_rows: int = BURST_ROWS
) -> DataFrame:
    """Outcome of every logged action, decided by the freeze gate.

    A freeze succeeds when the last valid verdict before it is ``passed``; the
    first success freezes the version. Afterwards verdicts are refused
    (``frozen``) and further freezes are ``ok`` without effect. A verdict other
    than passed/failed is a ``bad_request``; a version never created is
    ``not_found``. No verdict can be refused before the first success, so every
    earlier valid verdict counts and no replay is needed.

    What ``versions`` already holds (``quality``, ``frozen``) is the state the
    log starts from, so the log need only have the actions since then.
    """
    created = versions.select(
        *VERSION_KEY, F.lit(True).alias("__created"), stored_frozen(versions).alias("__stored_frozen"), stored_status(versions).alias("__stored")
    )
    is_quality, is_freeze = F.col("action") == "quality", F.col("action") == "freeze"
    exists = F.col("__created").isNotNull()
    valid = F.coalesce(is_quality & F.col("status").isin("passed", "failed"), F.lit(False))
    order = ["ts", "seq"]
    chunked = with_order_chunk(actions, VERSION_KEY, "ts", "seq", chunk_seconds, burst_rows)
    log = chunked.join(created, list(VERSION_KEY), "left").withColumns(
        {
            # A version frozen from the start takes no verdict at all.
            "__verdict": F.when(exists & valid & ~F.col("__stored_frozen"), F.col("status")),
            "__asks": exists & is_freeze,
        }
    )

    # A chunk closes with its last verdict and with whether it froze the version, either for
    # certain or only if the verdict standing at its start was "passed".
    alone = rows_before(in_chunk(VERSION_KEY, order, lead=False))
    prior = F.last("__verdict", ignorenulls=True).over(alone)
    core = by_chunk(log.select(*VERSION_KEY, CHUNK, *order, "__verdict", "__asks", "__stored"), VERSION_KEY)
    closing = (
        core.withColumn("__prior", prior)
        .groupBy(*VERSION_KEY, CHUNK)
        .agg(
            F.max_by("__verdict", F.when(F.col("__verdict").isNotNull(), F.struct(*order))).alias("__verdict"),
            F.max(F.col("__asks") & (F.col("__prior") == "passed")).alias("__opens"),
            F.max(F.col("__asks") & F.col("__prior").isNull()).alias("__may_open"),
            F.first("__stored").alias("__stored"),
        )
    )

    def opening(ends: DataFrame, along: WindowSpec) -> DataFrame:
        earlier = F.last("__verdict", ignorenulls=True).over(rows_before(along))
        carried = ends.withColumn("__verdict", F.coalesce(earlier, "__stored"))
        opens = F.coalesce("__opens", F.lit(False)) | (F.col("__may_open") & (F.col("__verdict") == "passed"))
        return carried.withColumn("__opens", opens).withColumn("__opens", F.max("__opens").over(rows_before(along)))

    window = rows_before(in_chunk(VERSION_KEY, order))
    rows = log.withColumn("__opens", F.lit(None).cast("boolean"))
    scanned = with_opening(rows, VERSION_KEY, closing, opening).withColumn(
        "prior_status", F.last("__verdict", ignorenulls=True).over(window)
    )
    opens = F.when(F.col(LEAD) == 0, F.col("__opens")).otherwise(
        F.col("__asks") & (F.coalesce("prior_status", F.lit("")) == "passed")
    )
    froze = F.coalesce(F.max("__opens").over(window), F.lit(False))
    scanned = scanned.withColumn("__opens", opens).withColumn("__frozen", froze | F.coalesce("__stored_frozen", F.lit(False)))
    frozen = F.col("__frozen")
    outcome = (
        F.when(is_quality & ~valid, "bad_request")
        .when(~exists, "not_found")
        .when(is_quality, F.when(frozen, "frozen").otherwise("ok"))
        .when(is_freeze, F.when(frozen | F.col("__opens"), "ok").otherwise("quality_not_passed"))
        .otherwise("bad_request")
    )
    folded = without_leads(scanned.withColumns({"outcome": outcome, "freezes": F.col("__opens") & ~frozen}))
    return folded.drop("__created", "__verdict", "__asks", "__opens", "__frozen", "__stored", "__stored_frozen")


def stored_frozen(versions: DataFrame) -> Column:
    return F.coalesce(F.col("frozen"), F.lit(False)) if "frozen" in versions.columns else F.lit(False)


def stored_status(versions: DataFrame) -> Column:
    return F.col("quality.status") if "quality" in versions.columns else F.lit(None).cast("string")


def apply_quality(actions: DataFrame, versions: DataFrame, chunk_seconds: int = DAY) -> DataFrame:
    """Outcomes of the quality verdicts in a log."""
    return fold_actions(actions, versions, chunk_seconds).filter(F.col("action") == "quality").drop("freezes", "prior_status")


def freeze_gate(actions: DataFrame, versions: DataFrame, chunk_seconds: int = DAY) -> DataFrame:
    """Outcomes of the freeze requests in a log."""
    return fold_actions(actions, versions, chunk_seconds).filter(F.col("action") == "freeze").drop("freezes")


def catalog_fold(actions: DataFrame, versions: DataFrame, chunk_seconds: int = DAY) -> DataFrame:
    """State per version after the log: last verdict that counted, frozen flag and time.

    Versions without an accepted action keep the state they have.
    """
    accepted = fold_actions(actions, versions, chunk_seconds).filter(F.col("outcome") == "ok")
    at = F.struct("ts", "seq")
    state = accepted.groupBy(*VERSION_KEY).agg(
        F.max_by(_verdict(actions, versions), F.when(F.col("action") == "quality", at)).alias("__quality"),
        F.min(F.when(F.col("freezes"), F.col("ts"))).alias("__frozen_at"),
    )
    held = versions.withColumns(
        {
            "__held_quality": F.col("quality") if "quality" in versions.columns else F.lit(None),
            "__held_at": F.col("frozen_at") if "frozen_at" in versions.columns else F.lit(None),
            "__held_frozen": stored_frozen(versions),
        }
    )
    joined = held.drop("quality", "frozen", "frozen_at").join(state, list(VERSION_KEY), "left")
    quality = F.coalesce("__quality", "__held_quality") if "quality" in versions.columns else F.col("__quality")
    return joined.withColumns(
        {
            "quality": quality,
            "frozen_at": F.coalesce("__held_at", "__frozen_at") if "frozen_at" in versions.columns else F.col("__frozen_at"),
            "frozen": F.col("__held_frozen") | F.col("__frozen_at").isNotNull(),
        }
    ).drop("__quality", "__frozen_at", "__held_quality", "__held_at", "__held_frozen")


def _verdict(actions: DataFrame, versions: DataFrame) -> Column:
    """A verdict as one struct, in the shape ``versions`` stores it where it does."""
    details = {c: F.col(c) for c in ("status", "report_uri", "failed_checks") if c in actions.columns}
    found = {**details, "recorded_at": F.col("ts")}
    if "quality" not in versions.columns:
        return F.struct(*[c.alias(n) for n, c in found.items()])
    shape = versions.schema["quality"].dataType
    return F.struct(*[found.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in shape.fields])


def freezable_versions(state: DataFrame) -> DataFrame:
    """Versions a freeze would accept now."""
    return state.filter(~F.col("frozen") & (F.col("quality.status") == "passed"))


def get_dataset(datasets: DataFrame, name: str) -> DataFrame:
    """The dataset row, or no row when it is unknown."""
    return datasets.filter(F.col("name") == name)


def get_version(versions: DataFrame, dataset: str, version: int) -> DataFrame:
    """The version row, or no row when it does not exist."""
    return versions.filter((F.col("dataset") == dataset) & (F.col("version") == version))


def list_sources(sources: DataFrame, limit: int = 0) -> DataFrame:
    """Sources by creation time and id; the first ``limit``, or all when it is not positive."""
    ordered = sources.orderBy("created_at", "id")
    return ordered.limit(limit) if limit > 0 else ordered


def lineage(
    versions: DataFrame,
    version_sources: DataFrame,
    datasets: DataFrame,
    sources: DataFrame,
    dataset: str | None = None,
    version: int | None = None,
) -> DataFrame:
    """Version, dataset and resolved sources: one row per source, in listed order (``pos``).

    Ids that resolve to nothing are dropped; a version left without any source
    keeps one row with null source columns.
    """
    if dataset is not None:
        versions, version_sources = (t.filter(F.col("dataset") == dataset) for t in (versions, version_sources))
    if version is not None:
        versions, version_sources = (t.filter(F.col("version") == version) for t in (versions, version_sources))
    resolved = version_sources.join(
        sources.select([F.col(c).alias("source_id" if c == "id" else f"source_{c}") for c in sources.columns]), "source_id"
    )
    owner = datasets.select([F.col(c).alias("dataset" if c == "name" else f"dataset_{c}") for c in datasets.columns])
    return versions.join(owner, "dataset").join(resolved, list(VERSION_KEY), "left")
