"""Documents dealt into shards of nearly equal bytes by Karmarkar-Karp differencing.

Documents with equal texts form a group that stays together; a group's weight is
the size of all its documents. Differencing holds partial partitions: one item in
one shard and the others empty, to begin with. It takes the two with the largest
spread (fullest minus emptiest shard), joins them with the fullest of one on the
emptiest of the other, and puts the result back, until one is left. Large
differences cancel early, and the last ones joined have next to none.

The items that are differenced are at most ``2 * ITEMS``, whatever the input: a
group that weighs at least the ``ITEMS``-th part of everything is an item of its own
(so a group that holds a third of all bytes is set against all the others), and so
is every group where there are no more than ``ITEMS``. The others are gathered into
``ITEMS`` bundles by a hash of the group. A shard gets some
680 bundles, whose random differences are what differencing cancels. No
text leaves the task that reads it, documents are never shuffled by text, and the
table of items that every task gets has a size fixed by ``ITEMS``.

Places in a shard: the documents (ids, sizes, checksums) are sorted by shard and id
over all tasks, and a task's first place comes from the rows of the tasks before it.

Law: ``bytes``. ``grown_shard`` is null. Defined cases: a null text has no bytes and
counts as equal to an empty one; its size is ``OVERHEAD`` alone. Rows with equal or
null ids are documents of their own, null ids first. Ties in spread are taken by the
heaviest shard, then in the order of the groups' hashes. With fewer groups than
shards some shards stay empty. Groups whose hash, size and checksum all agree are
kept together even if their texts differ. An empty table gives no rows. Further
columns are ignored.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gatewright.llm.common import staged, text_of

SHARDS = 24
OVERHEAD = 8
#: Groups differenced one by one, and bundles of the rest.
ITEMS = 16_384


def difference(weights: list[int], shards: int = SHARDS) -> list[int]:
    """A shard for every weight, by differencing. Shards are numbered from the heaviest."""
    # A partial partition: (-spread, -heaviest, number, [(weight, tree), ..] from heavy to light). A tree is an item or a pair of trees.
    rest = [(-w, -w, k, [(w, k)] + [(0, None)] * (shards - 1)) for k, w in enumerate(weights)]
    heapq.heapify(rest)
    number = len(rest)
    while len(rest) > 1:
        one, other = heapq.heappop(rest)[3], heapq.heappop(rest)[3]
        joined = [(a + b, x if y is None else y if x is None else (x, y)) for (a, x), (b, y) in zip(one, reversed(other))]
        joined.sort(key=lambda lane: -lane[0])
        heapq.heappush(rest, (joined[-1][0] - joined[0][0], -joined[0][0], number, joined))
        number += 1
    out = [0] * len(weights)
    for shard, (_, tree) in enumerate(rest[0][3] if rest else []):
        for item in _leaves(tree):
            out[item] = shard
    return out


def _leaves(tree) -> Iterator[int]:
    open_ = [] if tree is None else [tree]
    while open_:
        top = open_.pop()
        if isinstance(top, tuple):
            open_.extend(top)
        else:
            yield top


def measured(docs: DataFrame) -> DataFrame:
    """``doc_id, size, text_crc32, text_hash`` of every document."""
    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), text_of().alias("text")).select(
        "doc_id", (F.octet_length("text") + OVERHEAD).cast("bigint").alias("size"), F.crc32("text").alias("text_crc32"), F.xxhash64("text").alias("text_hash")
    )


GROUP = ["text_hash", "text_crc32", "size"]


def items_of(rows: DataFrame, items: int = ITEMS) -> tuple[DataFrame, DataFrame]:
    """The groups that are items of their own (``GROUP`` and ``weight``), and the bundles (``bundle, weight``) of the others: at most ``items`` each."""
    groups = staged(rows.groupBy(*GROUP).agg(F.sum("size").alias("weight")), "text-groups")
    total = groups.agg(F.count(F.lit(1)).alias("n"), F.sum("weight").alias("weight")).head()
    alone = F.lit(True) if total.n <= items else F.col("weight") * items >= F.lit(total.weight)
    bundles = groups.filter(~alone).groupBy(bundle_of(items).alias("bundle")).agg(F.sum("weight").alias("weight"))
    return groups.filter(alone), bundles


def bundle_of(items: int):
    return F.pmod(F.xxhash64(*GROUP), F.lit(items)).cast("int")


def shards_of_items(single: DataFrame, bundles: DataFrame, shards: int = SHARDS) -> DataFrame:
    """All items with their ``shard``, differenced together: ``2 * ITEMS`` rows at most. ``bundle`` is -1 for a group of its own."""

    def run(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values(["bundle", *GROUP], kind="stable")
        return frame.drop(columns=["weight", "all"]).assign(shard=difference(frame["weight"].tolist(), shards))

    nothing = [F.lit(0).cast("bigint").alias(c) for c in GROUP]
    both = single.select(F.lit(-1).alias("bundle"), *GROUP, "weight").union(bundles.select("bundle", *nothing, "weight"))
    return both.withColumn("all", F.lit(0)).groupBy("all").applyInPandas(run, "bundle INT, text_hash BIGINT, text_crc32 BIGINT, size BIGINT, shard INT")


def with_slots(rows: DataFrame) -> DataFrame:
    """Add ``slot``, the place of each row in its ``shard`` by ``doc_id``, gapless from 0."""
    tie = "__tie"
    # The tie lets equal ids, too, be spread over tasks.
    ordered = rows.withColumn(tie, F.monotonically_increasing_id()).repartitionByRange("shard", "doc_id", tie).sortWithinPartitions("shard", "doc_id", tie).drop(tie)
    # The upper bits of the number are the task, the lower ones the row's place in it.
    numbered = staged(ordered.withColumn("__row", F.monotonically_increasing_id()), "shard-order")
    task, place = F.shiftright("__row", 33), F.col("__row").bitwiseAND(F.lit((1 << 33) - 1))
    runs = numbered.groupBy(task.alias("task"), F.col("shard").alias("of")).agg(F.count(F.lit(1)).alias("n"), F.min(place).alias("first"))
    # A row per task and shard in it; a task holds few shards, as rows are sorted by them.
    before = F.coalesce(F.sum("n").over(Window.partitionBy("of").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    starts = runs.select("task", "of", (before - F.col("first")).alias("start"))
    return numbered.join(starts, (task == F.col("task")) & (F.col("shard") == F.col("of"))).withColumn("slot", F.col("start") + place)


def shard_documents(docs: DataFrame, shards: int = SHARDS, items: int = ITEMS) -> DataFrame:
    """Per document: ``doc_id, size, text_crc32, law, shard, slot, grown_shard``."""
    rows = staged(measured(docs), "document-sizes")
    placed = staged(shards_of_items(*items_of(rows, items), shards), "item-shards")
    single = placed.filter("bundle < 0").select(*[F.col(c).alias(f"__{c}") for c in GROUP], F.col("shard").alias("own"))
    bundles = placed.filter("bundle >= 0").select(F.col("bundle").alias("__bundle"), F.col("shard").alias("common"))
    same = [F.col(c) == F.col(f"__{c}") for c in GROUP]
    # Both tables have at most ``items`` rows.
    found = (
        rows.join(F.broadcast(single), same, "left")
        .join(F.broadcast(bundles), bundle_of(items) == F.col("__bundle"), "left")
        .select("doc_id", "size", "text_crc32", F.coalesce("own", "common").alias("shard"))
    )
    return with_slots(found).select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))
