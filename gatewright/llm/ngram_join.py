"""Documents whose sets of word shingles have a Jaccard similarity of at least a bound, and the groups they form.

A join in metric spaces, regions within regions:

1.  Outer regions. Documents lie at distance 1 from nearly every other document,
    so documents cannot serve as pivots of the whole space. One-shingle sets can.
    They are ranked (:class:`Rarity`, rare ones first); the first shingle of a
    document is its nearest pivot and gives its Voronoi region. If ``x`` and ``y``
    are linked, their intersection ``z`` differs from ``x`` by at most
    ``|x| - ceil(t |x|)`` shingles, so ``z``'s nearest pivot is among the first
    ``|x| - ceil(t |x|) + 1`` of ``x``, and likewise of ``y``. Replicating every
    document to the regions in this window makes all linked pairs meet, exactly.
2.  In a region, the document with the smallest id is the pivot and the distance
    of all others to it is computed. Its ball of the join's radius is one group;
    a region whose documents are all in one group is settled, whatever its size.
3.  Regions with several groups are cut into rings around the empty set: linked
    sets differ in size by a bounded factor, the width of a ring, so every document
    goes to its own ring and, as its window, to the next. In a ring that still has
    several groups, documents outside the largest one are compared with all others,
    in blocks. Short profiles that never lengthen a distance drop what cannot have a
    link there (:func:`possible`); the rest is joined recursively: documents as
    pivots, Voronoi cells around them, and a query goes to every cell that the
    triangle inequality does not exclude (:func:`metric_links`).

Groups are connected components over the links found. Equal sets are one point.
Distances are exact; the ranking only decides how much work there is. It comes
from a sketch of shingle counts over all documents, of fixed size.

Defined cases: a text with fewer words than a shingle is one shingle; null texts
and texts without words have an empty set and link with nothing. Rows with equal
ids are documents of their own that share an id; the smallest id names a group.
Long texts count with all their shingles. An empty table gives no rows; further
columns are ignored, and kept by :func:`drop_similar`.
Shingles are 64-bit hashes. Sets are named by 64-bit digests; should two sets
get one name, a second digest shows it and the join starts over with another key.
"""

from __future__ import annotations

import hashlib
import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gatewright.llm.common import staged, text_of
from gatewright.llm.components import Forest, connected_components
from gatewright.llm.shingles import mixed, shingle_set

WORDS = 4
PERCENT = 85
SKETCH_BITS = 24
SKETCH_BLOCKS = 64
FILTER_BITS = 24
FILTER_TASKS = 16
BLOCK = 640
BLOCK_SHINGLES = 1 << 20
GROUP_PARTS = 64
LEAF = 24
PIVOTS = 4


def set_name(shingles: np.ndarray, key: int) -> tuple[int, int]:
    digest = hashlib.blake2b(shingles.tobytes(), digest_size=16, key=key.to_bytes(4, "little")).digest()
    return int.from_bytes(digest[:8], "little", signed=True), int.from_bytes(digest[8:], "little", signed=True)


def cells_of(shingles: np.ndarray) -> np.ndarray:
    return (shingles >> np.uint64(64 - SKETCH_BITS)).astype(np.int64)


def named_sets(docs: DataFrame, words: int, key: int) -> DataFrame:
    """Rows ``doc_id, n, k, proof`` of all documents and, with ``block`` set, each task's part of the shingle counts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(1 << SKETCH_BITS, dtype=np.uint8)
        for batch in batches:
            rows = []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                shingles = shingle_set(text, words)
                # A task's count of a cell stops at 255, and a set counts once: a rank needs no exact counts.
                cells = cells_of(shingles)
                counts[cells] += counts[cells] < 255
                rows.append((doc_id, len(shingles), *set_name(shingles, key)))
            columns = [pa.array(c, pa.int64()) for c in zip(*rows)] if rows else [pa.array([], pa.int64())] * 4
            yield pa.RecordBatch.from_arrays([*columns, pa.nulls(len(rows), pa.int32()), pa.nulls(len(rows), pa.binary())], names)
        used = [b for b, part in enumerate(np.split(counts, SKETCH_BLOCKS)) if part.any()]
        packed = [zlib.compress(part.tobytes(), 1) for part in np.split(counts, SKETCH_BLOCKS) if part.any()]
        empty = pa.nulls(len(used), pa.int64())
        yield pa.RecordBatch.from_arrays([empty] * 4 + [pa.array(used, pa.int32()), pa.array(packed, pa.binary())], names)

    names = ["doc_id", "n", "k", "proof", "block", "counts"]
    schema = "doc_id BIGINT, n BIGINT, k BIGINT, proof BIGINT, block INT, counts BINARY"
    return docs.select("doc_id", text_of().alias("text")).mapInArrow(run, schema)


class Rarity:
    """Rank of shingles: those in little-used cells of the sketch first, then by hash."""

    def __init__(self, levels: np.ndarray):
        self.levels = levels

    @classmethod
    def of_counts(cls, parts: DataFrame) -> Rarity:
        """Sum the tasks' counts block by block; ``2 ** SKETCH_BITS`` bytes come back, whatever the input."""

        def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            sums: dict[int, np.ndarray] = {}
            for batch in batches:
                for block, packed in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                    part = np.frombuffer(zlib.decompress(packed), np.uint8).astype(np.uint64)
                    sums[block] = sums[block] + part if block in sums else part
            levels = [np.minimum(255, np.round(6 * np.log2(1.0 + s))).astype(np.uint8).tobytes() for s in sums.values()]
            yield pa.RecordBatch.from_arrays([pa.array(list(sums), pa.int32()), pa.array(levels, pa.binary())], ["block", "levels"])

        rows = parts.select("block", "counts").repartition(SKETCH_BLOCKS, "block").mapInArrow(add, "block INT, levels BINARY").toArrow()
        size = (1 << SKETCH_BITS) // SKETCH_BLOCKS
        levels = np.zeros(1 << SKETCH_BITS, dtype=np.uint8)
        for block, data in zip(rows["block"].to_pylist(), rows["levels"].to_pylist()):
            levels[block * size : (block + 1) * size] = np.frombuffer(data, np.uint8)
        return cls(levels)

    def first(self, shingles: np.ndarray, count: int) -> np.ndarray:
        rank = (self.levels[cells_of(shingles)].astype(np.uint64) << np.uint64(56)) | (mixed(shingles) >> np.uint64(8))
        return shingles[np.argsort(rank)[:count]]


def window_size(n: int, percent: int) -> int:
    """How many of the nearest pivots a set of ``n`` shingles must be replicated to."""
    return n - -(-percent * n // 100) + 1


def outer_regions(docs: DataFrame, rarity: Rarity, words: int, percent: int, key: int) -> DataFrame:
    """``s, k``: every set in the regions of its window."""
    shared = docs.sparkSession.sparkContext.broadcast(rarity.levels)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rank = Rarity(shared.value)
        for batch in batches:
            parts, names, sizes = [], [], []
            for text in batch.column(0).to_pylist():
                shingles = shingle_set(text, words)
                if len(shingles):
                    near = rank.first(shingles, window_size(len(shingles), percent))
                    parts.append(near)
                    names.append(set_name(shingles, key)[0])
                    sizes.append(len(near))
            pivots = np.concatenate(parts).view(np.int64) if parts else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(pivots), pa.array(np.repeat(np.array(names, np.int64), sizes))], ["s", "k"])

    return docs.select(text_of().alias("text")).mapInArrow(run, "s BIGINT, k BIGINT")


def id_places(ids: np.ndarray) -> np.ndarray:
    return (mixed(ids.view(np.uint64)) >> np.uint64(64 - FILTER_BITS)).astype(np.int64)


def id_filter(ids: DataFrame) -> np.ndarray:
    """A bit map of ``2 ** FILTER_BITS`` bits that has the bit of every id; others share a bit by chance."""

    def collect(batches: Iterator[pa.RecordBatch], read) -> Iterator[pa.RecordBatch]:
        bits = np.zeros(1 << FILTER_BITS, dtype=bool)
        for batch in batches:
            read(bits, batch.column(0))
        if bits.any():
            yield pa.RecordBatch.from_arrays([pa.array([zlib.compress(np.packbits(bits).tobytes(), 1)], pa.binary())], ["bits"])

    def mark(bits: np.ndarray, column: pa.Array) -> None:
        bits[id_places(column.drop_null().to_numpy())] = True

    def unite(bits: np.ndarray, column: pa.Array) -> None:
        for packed in column.to_pylist():
            bits |= np.unpackbits(np.frombuffer(zlib.decompress(packed), np.uint8)).astype(bool)

    marked = ids.mapInArrow(lambda batches: collect(batches, mark), "bits BINARY")
    united = marked.repartition(FILTER_TASKS).mapInArrow(lambda batches: collect(batches, unite), "bits BINARY").collect()
    bits = np.zeros(1 << FILTER_BITS, dtype=bool)
    for row in united:
        bits |= np.unpackbits(np.frombuffer(zlib.decompress(row.bits), np.uint8)).astype(bool)
    return np.packbits(bits)


def profile(shingles: np.ndarray) -> bytes:
    """The set's size, and how many shingles fall into each of about ``size / 8`` equal ranges of hashes (a byte each, 255 for more)."""
    bits = max(0, len(shingles).bit_length() - 4)
    ranges = (shingles >> np.uint64(64 - bits)).astype(np.int64) if bits else np.zeros(len(shingles), np.int64)
    return len(shingles).to_bytes(8, "little") + np.minimum(np.bincount(ranges, minlength=1 << bits), 255).astype(np.uint8).tobytes()


def read_profile(data: bytes) -> tuple[int, np.ndarray]:
    """Size and counts; a count that stopped at 255 bounds nothing."""
    counts = np.frombuffer(data, np.uint8, offset=8).astype(np.int64)
    counts[counts == 255] = 1 << 40
    return int.from_bytes(data[:8], "little"), counts


def sets_of(docs: DataFrame, wanted: DataFrame, words: int, key: int, form=np.ndarray.tobytes) -> DataFrame:
    """``k, shingles`` of the wanted sets (``k, rep``) in the given form, each read from a document with id ``rep``.

    A bit map of the wanted ids, of fixed size, spares most other documents the
    way through the shuffle; the join after it is exact.
    """
    shared = docs.sparkSession.sparkContext.broadcast(id_filter(wanted.select("rep")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = np.unpackbits(shared.value)
        for batch in batches:
            ids = batch.column(0)
            maybe = bits[id_places(ids.fill_null(0).to_numpy())].astype(bool) | ids.is_null().to_numpy(zero_copy_only=False)
            sets = [shingle_set(t, words) for t, asked in zip(batch.column(1).to_pylist(), maybe.tolist()) if asked]
            names = pa.array([set_name(s, key)[0] for s in sets], pa.int64())
            yield pa.RecordBatch.from_arrays([names, pa.array([form(s) for s in sets], pa.binary())], ["k", "shingles"])

    found = docs.select("doc_id", text_of().alias("text")).mapInArrow(run, "k BIGINT, shingles BINARY")
    # Rows may share an id, and texts may share a set.
    return found.join(wanted.select("k"), "k", "left_semi").groupBy("k").agg(F.first("shingles").alias("shingles"))


class LocalSets:
    """Sets of one block over a vocabulary of its own, so that one set meets many in one pass."""

    def __init__(self, sets: list[np.ndarray]):
        self.sizes = np.array([len(s) for s in sets], dtype=np.int64)
        ids, self.ids = np.unique(np.concatenate(sets), return_inverse=True)
        self.starts = np.concatenate([[0], np.cumsum(self.sizes)])
        self.mark = np.zeros(len(ids), dtype=np.int64)

    def shared(self, one: int, others: np.ndarray) -> np.ndarray:
        """Shingles that ``one`` has in common with each of ``others``."""
        own = self.ids[self.starts[one] : self.starts[one + 1]]
        self.mark[own] = 1
        parts = [self.mark[self.ids[self.starts[k] : self.starts[k + 1]]].sum() for k in others] if len(others) < 8 else None
        if parts is None:
            sizes = self.sizes[others]
            ends = np.cumsum(sizes)
            at = np.arange(ends[-1]) + np.repeat(self.starts[others] - (ends - sizes), sizes)
            parts = np.add.reduceat(self.mark[self.ids[at]], ends - sizes)
        self.mark[own] = 0
        return np.asarray(parts, dtype=np.int64)

    def linked(self, one: int, others: np.ndarray, percent: int) -> tuple[np.ndarray, np.ndarray]:
        """Whether ``one`` is linked with each of ``others``, and their distances."""
        common = self.shared(one, others)
        union = self.sizes[one] + self.sizes[others] - common
        return 100 * common >= percent * union, 1 - common / union


def metric_links(
    sets: LocalSets, queries: np.ndarray, members: np.ndarray, percent: int, groups: np.ndarray | None = None
) -> Iterator[tuple[int, int]]:
    """Linked pairs of a query and a member.

    With ``groups`` (a number per set, changed on the way) pairs within a group are
    left out and a link makes two groups one, so that only links that connect are found.

    More than ``LEAF`` members are dealt to the Voronoi cells of a few of them. A query
    goes on to a cell unless the triangle inequality shows that no member there can be
    within the radius: by the cell's own radius, or by the query's nearest pivot.
    """
    radius = 1 - percent / 100 + 1e-9
    if not len(queries) or not len(members):
        return
    if groups is not None and (groups[queries] == groups[queries[0]]).all() and (groups[members] == groups[queries[0]]).all():
        return
    if len(members) > LEAF:
        pivots = members[np.linspace(0, len(members) - 1, PIVOTS).astype(int)]
        distance = np.stack([sets.linked(p, members, percent)[1] for p in pivots])
        nearest = np.argmin(distance, axis=0)
        cells = [members[nearest == c] for c in range(PIVOTS)]
        if max(map(len, cells)) < len(members):
            asked = np.stack([sets.linked(p, queries, percent)[1] for p in pivots])
            closest = asked.min(axis=0)
            for c, cell in enumerate(cells):
                if len(cell):
                    reach = distance[c, nearest == c].max() + radius
                    into = (asked[c] <= reach) & (asked[c] <= closest + 2 * radius)
                    yield from metric_links(sets, queries[into], cell, percent, groups)
            return
    for q in queries.tolist():
        others = members[members != q] if groups is None else members[groups[members] != groups[q]]
        if len(others):
            linked, _ = sets.linked(q, others, percent)
            for m in others[linked].tolist():
                if groups is not None:
                    if groups[m] == groups[q]:
                        continue
                    groups[groups == groups[m]] = groups[q]
                yield q, m


def blocks_of(groups: DataFrame) -> DataFrame:
    """``g, mb, qb, asks, k``: the rows of each group (``g, k, query, n``) dealt to blocks.

    Each query is to be compared with every row of its group (queries are members
    too); every group has one. A block has about ``BLOCK`` members and ``BLOCK``
    queries, fewer if they have more than ``BLOCK_SHINGLES`` together, so that a
    large group is the work of many tasks, and long sets fit into one. Rows look
    their group's shape up by group and a part of it, so that no group is dealt
    to one task; groups of one block, nearly all, need no look-up.
    """
    def blocks(rows: Column, shingles: Column) -> Column:
        return F.ceil(F.greatest(rows / BLOCK, shingles / BLOCK_SHINGLES)).cast("int")

    asked = F.col("query").cast("int")
    sizes = groups.groupBy("g").agg(
        blocks(F.count(F.lit(1)), F.sum("n")).alias("m_blocks"), blocks(F.sum(asked), F.sum(asked * F.col("n"))).alias("q_blocks")
    )
    part = F.pmod(F.xxhash64("k", F.lit(1)), F.lit(GROUP_PARTS)).cast("int")
    large = sizes.filter("m_blocks > 1 OR q_blocks > 1").withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(GROUP_PARTS - 1))))
    sized = groups.withColumn("part", part).join(large, ["g", "part"], "left").fillna(1, ["m_blocks", "q_blocks"])
    at = F.pmod(F.xxhash64("k"), F.lit(1 << 20))
    as_member = F.transform(F.sequence(F.lit(0), F.col("q_blocks") - 1), lambda q: F.struct((at % F.col("m_blocks")).cast("int").alias("mb"), q.alias("qb"), F.lit(False).alias("asks")))
    as_query = F.transform(F.sequence(F.lit(0), F.col("m_blocks") - 1), lambda m: F.struct(m.alias("mb"), (at % F.col("q_blocks")).cast("int").alias("qb"), F.lit(True).alias("asks")))
    places = F.when(F.col("query"), F.concat(as_member, as_query)).otherwise(as_member)
    return sized.select("g", "k", F.explode(places).alias("p")).select("g", "p.mb", "p.qb", "p.asks", "k")


def _by_block(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple, list[tuple[bool, int, bytes]]]]:
    """Blocks of sorted rows ``g, mb, qb, asks, k, shingles``; one is in memory at a time."""
    now, held = None, []
    for batch in batches:
        for g, mb, qb, asks, k, data in zip(*[c.to_pylist() for c in batch.columns]):
            if (g, mb, qb) != now:
                if held:
                    yield now, held
                now, held = (g, mb, qb), []
            held.append((asks, k, data))
    if held:
        yield now, held


def _with_sets(blocks: DataFrame, sets: DataFrame) -> DataFrame:
    rows = blocks.join(sets, "k").select("g", "mb", "qb", "asks", "k", "shingles")
    return rows.repartition("g", "mb", "qb").sortWithinPartitions("g", "mb", "qb")


def possible(blocks: DataFrame, profiles: DataFrame, percent: int) -> DataFrame:
    """The rows of blocks that may have a link in their block, by their profiles.

    Two sets share at most the sum of the smaller counts of each range: a map into
    a space of few dimensions that never lengthens a distance, so no link is lost.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block, rows in _by_block(batches):
            profiles = [read_profile(data) for *_, data in rows]
            width = min(len(c) for _, c in profiles)
            table = np.stack([c.reshape(width, -1).sum(axis=1) for _, c in profiles])
            sizes, names = np.array([n for n, _ in profiles]), np.array([k for _, k, _ in rows], dtype=np.int64)
            asks = np.array([a for a, *_ in rows])
            members, keep = np.flatnonzero(~asks), np.zeros(len(rows), dtype=bool)
            for q in np.flatnonzero(asks).tolist():
                most = np.minimum(table[members], table[q]).sum(axis=1)
                near = members[(100 * most >= percent * (sizes[members] + sizes[q] - most)) & (names[members] != names[q])]
                if len(near):
                    keep[near] = keep[q] = True
            kept = np.flatnonzero(keep)
            if len(kept):
                fixed = [pa.array([v] * len(kept), t) for v, t in zip(block, (pa.int64(), pa.int32(), pa.int32()))]
                yield pa.RecordBatch.from_arrays([*fixed, pa.array(asks[kept]), pa.array(names[kept])], ["g", "mb", "qb", "asks", "k"])

    return _with_sets(blocks, profiles).mapInArrow(run, "g BIGINT, mb INT, qb INT, asks BOOLEAN, k BIGINT")


def block_links(blocks: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """``a, b`` edges that connect what is linked in each block."""

    def join(rows: list[tuple[bool, int, bytes]], forest: Forest) -> None:
        place: dict[int, int] = {}
        local = []
        for _, k, data in rows:
            if k not in place:
                place[k] = len(place)
                local.append(np.frombuffer(data, np.uint64))
        names = list(place)
        members = np.array(sorted({place[k] for asks, k, _ in rows if not asks}), dtype=np.int64)
        queries = np.array(sorted({place[k] for asks, k, _ in rows if asks}), dtype=np.int64)
        if len(members) and len(queries):
            sets = LocalSets(local)
            known = np.unique([forest.root(k) for k in names], return_inverse=True)[1]
            for q, m in metric_links(sets, queries, members, percent, known):
                forest.join(names[q], names[m])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # One forest per task: what an earlier block linked is not compared again. It grows with the links found in the task only.
        forest = Forest()
        for _, rows in _by_block(batches):
            join(rows, forest)
        edges = forest.edges()
        yield pa.RecordBatch.from_arrays([pa.array([a for a, _ in edges], pa.int64()), pa.array([b for _, b in edges], pa.int64())], ["a", "b"])

    return _with_sets(blocks, sets).mapInArrow(run, "a BIGINT, b BIGINT")


def similar_groups(docs: DataFrame, words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """Per row: ``doc_id, n_shingles, component_id``. Links are pairs with ``100 * |x & y| >= percent * |x | y|``."""
    for key in range(1, 100):
        named = staged(named_sets(docs, words, key), "shingle-sets")
        rows = named.filter("block IS NULL").select("doc_id", "n", "k", "proof")
        groups = rows.filter("n > 0").groupBy("k").agg(
            F.min("doc_id").alias("rep"), F.first("n").alias("n"), F.min("proof").alias("p1"), F.max("proof").alias("p2")
        )
        distinct = staged(groups, "shingle-names")
        if distinct.filter("p1 <> p2").isEmpty():
            break
    rarity = Rarity.of_counts(named.filter("block IS NOT NULL"))

    placed = outer_regions(docs, rarity, words, percent, key)
    pivots = placed.groupBy("s").agg(F.min("k").alias("pivot"), F.max("k").alias("last")).filter("pivot < last").drop("last")
    regions = staged(placed.join(pivots.hint("merge"), "s").select("s", "k", "pivot").distinct(), "shingle-regions")

    stars = regions.filter("k <> pivot").select("k", "pivot").distinct()
    size = distinct.select(F.col("k").alias("sk"), F.col("n").alias("sn"))
    stars = stars.join(size, F.col("k") == F.col("sk")).drop("sk").withColumnRenamed("sn", "n")
    stars = stars.join(size, F.col("pivot") == F.col("sk")).filter(F.least("n", "sn") * 100 >= percent * F.greatest("n", "sn")).select("k", "pivot", "n", "sn")
    stars = staged(stars, "shingle-stars")
    # Every set that is compared at all is in a region of several.
    profiles = staged(sets_of(docs, distinct.join(regions.select("k").distinct(), "k").select("k", "rep"), words, key, profile), "shingle-profiles")

    def links(groups: DataFrame) -> DataFrame:
        """Blocks are thinned by profiles first, so few sets travel."""
        blocks = staged(possible(blocks_of(groups), profiles, percent), "shingle-blocks")
        sets = sets_of(docs, distinct.join(blocks.select("k").distinct(), "k").select("k", "rep"), words, key)
        return staged(block_links(blocks, sets, percent), "shingle-links")

    hubs = stars.select(F.col("pivot").alias("g"), F.col("pivot").alias("k"), F.lit(True).alias("query"), F.col("sn").alias("n")).distinct()
    first = links(stars.select(F.col("pivot").alias("g"), "k", F.lit(False).alias("query"), "n").unionByName(hubs))

    known = staged(connected_components(first), "shingle-balls").select(F.col("node").alias("k"), F.col("component").alias("ball"))
    # All pairs with the region's own pivot are done.
    inside = regions.filter("k <> pivot").join(known, "k", "left").select("s", F.col("k").alias("member"), F.coalesce("ball", "k").alias("ball"))
    several = inside.groupBy("s").agg(F.min("ball").alias("b1"), F.max("ball").alias("b2")).filter("b1 < b2").select("s")
    ring = F.floor(F.log("sn") / F.lit(math.log(100 / min(percent, 99.9999)) * (1 + 1e-9))).cast("bigint")
    sized = inside.join(several, "s").join(size, F.col("member") == F.col("sk"))
    rings = sized.select(F.explode(F.array(ring, ring + 1)).alias("ring"), "s", F.col("member").alias("k"), "ball", F.col("sn").alias("n"))
    rings = staged(rings.select(F.xxhash64("s", "ring").alias("g"), "k", "ball", "n"), "shingle-rings")
    balls = rings.groupBy("g", "ball").agg(F.count(F.lit(1)).alias("m"))
    largest = balls.groupBy("g").agg(F.max(F.struct("m", "ball")).alias("top"), F.sum("m").alias("all"), F.count(F.lit(1)).alias("balls"))
    unsettled = largest.filter("balls > 1").select("g", F.col("top.ball").alias("main"), "all")
    left = staged(rings.join(unsettled, "g").select("g", "k", (F.col("ball") != F.col("main")).alias("query"), "n", "all"), "shingle-unsettled")
    # Small rings with the same documents are one.
    small = left.filter(F.col("all") <= BLOCK).groupBy("g").agg(F.array_sort(F.collect_list(F.struct("k", "query", "n"))).alias("them"))
    small = small.groupBy("them").agg(F.min("g").alias("g")).select("g", F.explode("them").alias("it")).select("g", "it.k", "it.query", "it.n")
    second = links(small.unionByName(left.filter(F.col("all") > BLOCK).select("g", "k", "query", "n")))

    linked = connected_components(first.unionByName(second))
    members = staged(linked.join(distinct.select(F.col("k").alias("node"), "rep"), "node"), "shingle-components")
    names = members.groupBy("component").agg(F.min("rep").alias("component_id"))
    named_k = members.select("node", "component").join(names, "component").select(F.col("node").alias("in"), "component_id")
    final = distinct.join(named_k, F.col("k") == F.col("in"), "left").select(F.col("k").alias("set_k"), F.coalesce("component_id", "rep").alias("component_id"))
    found = rows.filter("n > 0").join(final.hint("merge"), F.col("k") == F.col("set_k")).select("doc_id", F.col("n").alias("n_shingles"), "component_id")
    return found.unionByName(rows.filter("n = 0").select("doc_id", F.col("n").alias("n_shingles"), F.col("doc_id").alias("component_id")))


def drop_similar(docs: DataFrame, words: int = 5, percent: int = 80) -> DataFrame:
    """The rows of ``docs`` whose id names their group: one document of each. Rows without id, and all rows of a kept id, stay."""
    kept = similar_groups(docs, words, percent).filter(F.col("doc_id") == F.col("component_id")).select(F.col("doc_id").alias("kept_id")).distinct()
    return docs.join(kept, (docs["doc_id"] == kept["kept_id"]), "left_semi").unionByName(docs.filter(docs["doc_id"].isNull()))
