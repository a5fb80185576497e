"""Near-duplicate vectors by product quantisation.

Coarse centroids cut the space into inverted lists. A vector lies in the list of
its nearest centroid, with the residual coded by one small codebook per subspace.
Every vector is also a query: it probes its own list and every other list that a
linked vector may lie in, scores the codes there by asymmetric table lookups, and
recomputes the exact cosine of what scores near the threshold.

Which lists suffice: a vector ``x`` at distance ``r`` from query ``q`` can have
the nearest centroid ``c`` instead of ``q``'s ``c1`` only if
``d(q,c)**2 - d(q,c1)**2 <= 2 * (q - x).(c - c1)``, at most ``2 * r * |c - c1|``.
For a difference without a preferred direction the right side has a standard
deviation of ``2 * r * |c - c1| / sqrt(dimension)``; probes reach ``PROBE_SIGMAS``
of them (or the bound, if that is smaller).

Equal vectors are compared once. Lists are cut into blocks of members and of
queries, so a crowded list is many tasks' work; what a block finds leaves it as
link counts and a spanning forest, not as pairs. Centroids and codebooks are
fitted on about ``SAMPLE`` vectors, all vectors are indexed and queried.

Vectors of each dimension that occurs are searched on their own, with a quantiser
of their own: those of different dimensions have no cosine.

Defined cases: null, zero or non-finite vectors and vectors with a null component
link with nothing and are components of their own. An empty table gives no rows. Rows with equal ids are separate vectors in the counts. The
smallest id of a component names it; a vector with null id keeps a null name
if it is alone. Other columns are ignored.
"""

from __future__ import annotations

import functools
import hashlib
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gatewright.llm.common import hash_sample, staged
from gatewright.llm.components import Forest, connected_components

THRESHOLD = 0.95
SAMPLE = 20_000
LIST_SIZE = 512
MAX_LISTS = 4096
SUBSPACES = 16
CODES = 256
PROBE_SIGMAS = 4.0
CODE_SLACK = 0.15
MEMBER_BLOCK = 2048
QUERY_BLOCK = 4096
QUERY_STEP = 256


def kmeans(x: np.ndarray, k: int, steps: int = 10, seed: int = 0) -> np.ndarray:
    """Centroids by Lloyd's method from a seeded choice of points."""
    rng = np.random.default_rng(seed)
    centroids = x[rng.choice(len(x), min(k, len(x)), replace=False)].copy()
    for _ in range(steps):
        nearest = np.argmax(x @ centroids.T - 0.5 * (centroids**2).sum(axis=1), axis=1)
        sums = np.zeros_like(centroids)
        np.add.at(sums, nearest, x)
        counts = np.bincount(nearest, minlength=len(centroids))
        filled = counts > 0
        centroids[filled] = sums[filled] / counts[filled, None]
    return centroids


@dataclass
class Quantiser:
    """Coarse centroids and residual codebooks (subspace, code, component)."""

    centroids: np.ndarray
    codebooks: np.ndarray
    bounds: list[tuple[int, int]]

    @classmethod
    def fit(cls, sample: np.ndarray, lists: int, subspaces: int = SUBSPACES, codes: int = CODES, seed: int = 0) -> Quantiser:
        centroids = kmeans(sample, lists, seed=seed)
        residual = sample - centroids[cls._nearest(sample, centroids)]
        edges = np.linspace(0, sample.shape[1], min(subspaces, sample.shape[1]) + 1).astype(int)
        bounds = list(zip(edges[:-1].tolist(), edges[1:].tolist()))
        small = residual[:: max(1, len(residual) // 8192)]
        width = max(b - a for a, b in bounds)
        books = np.zeros((len(bounds), codes, width))
        for k, (a, b) in enumerate(bounds):
            book = kmeans(small[:, a:b], codes, steps=8, seed=seed + k + 1)
            books[k, : len(book), : b - a] = book
            books[k, len(book) :, : b - a] = book[:1]
        return cls(centroids, books, bounds)

    @staticmethod
    def _nearest(x: np.ndarray, centroids: np.ndarray) -> np.ndarray:
        return np.argmax(x @ centroids.T - 0.5 * (centroids**2).sum(axis=1), axis=1)

    def encode(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        lists = self._nearest(x, self.centroids)
        residual = x - self.centroids[lists]
        codes = np.empty((len(x), len(self.bounds)), dtype=np.uint8)
        for k, (a, b) in enumerate(self.bounds):
            book = self.codebooks[k][:, : b - a]
            codes[:, k] = np.argmax(residual[:, a:b] @ book.T - 0.5 * (book**2).sum(axis=1), axis=1)
        return lists, codes

    def probes(self, x: np.ndarray, radius: float, sigmas: float = PROBE_SIGMAS) -> tuple[np.ndarray, np.ndarray]:
        """Rows and lists of all sufficient probes."""
        squares = (self.centroids**2).sum(axis=1)
        distance = squares - 2 * x @ self.centroids.T
        nearest = np.argmin(distance, axis=1)
        gap = distance - distance[np.arange(len(x)), nearest][:, None]
        between = np.sqrt(np.maximum(0, squares[:, None] + squares - 2 * self.centroids @ self.centroids.T))
        reach = 2 * radius * between[nearest] * min(1.0, sigmas / math.sqrt(x.shape[1]))
        return np.nonzero(gap <= reach + 1e-12)

    def tables(self, queries: np.ndarray) -> np.ndarray:
        """Dot products of each query's parts with all codes: (query, subspace, code)."""
        return np.stack([queries[:, a:b] @ self.codebooks[k][:, : b - a].T for k, (a, b) in enumerate(self.bounds)], axis=1)


def rows_of(column: pa.Array) -> list[np.ndarray | None]:
    """Vectors of a list column as doubles, nulls inside as NaN."""
    values, offsets = column.values.to_numpy(zero_copy_only=False).astype(np.float64), column.offsets.to_numpy()
    valid = column.is_valid().to_numpy(zero_copy_only=False)
    return [values[a:b] if ok else None for a, b, ok in zip(offsets[:-1], offsets[1:], valid)]


def _checked(vectors: DataFrame) -> DataFrame:
    """``vec_id, dim, key, unit``: digest and unit vector (double, as bytes); key and unit are null for vectors that link with nothing."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            dims, keys, units = [], [], []
            for v in rows_of(batch.column(1)):
                norm = 0.0
                if v is not None and len(v) and np.isfinite(v).all():
                    top = np.abs(v).max()
                    norm = top * np.sqrt(((v / top) ** 2).sum()) if top else 0.0
                fine = 0 < norm < np.inf
                dims.append(len(v) if fine else None)
                keys.append(hashlib.sha256((v + 0.0).tobytes()).digest() if fine else None)
                units.append((v / norm).tobytes() if fine else None)
            columns = [batch.column(0), pa.array(dims, pa.int32()), pa.array(keys, pa.binary()), pa.array(units, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, ["vec_id", "dim", "key", "unit"])

    rows = vectors.select("vec_id", F.col("embedding").cast("array<double>").alias("embedding"))
    return rows.mapInArrow(run, "vec_id BIGINT, dim INT, key BINARY, unit BINARY")


def stack(units: list[bytes], dim: int) -> np.ndarray:
    return np.frombuffer(b"".join(units), dtype=np.float64).reshape(-1, dim)


def fit_quantiser(distinct: DataFrame, dim: int, total: int, sample: int = SAMPLE, list_size: int = LIST_SIZE) -> Quantiser:
    """A quantiser from about ``sample`` vectors, taken by a hash of their digest."""
    rows = hash_sample(distinct, ["key"], sample).select("unit").toArrow()
    lists = max(1, min(MAX_LISTS, total // list_size, sample // 8))
    return Quantiser.fit(stack([bytes(u) for u in rows["unit"].to_pylist()], dim), lists)


def search(distinct: DataFrame, quantiser: Quantiser, dim: int, threshold: float = THRESHOLD) -> tuple[DataFrame, DataFrame]:
    """Links among distinct vectors (``rep, n, unit``): ``rep, links`` (in copies) and ``a, b`` edges of spanning forests."""
    radius = math.sqrt(max(0.0, 2 - 2 * threshold))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            reps, copies, units = batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2).to_pylist()
            if not reps:
                continue
            x = stack(units, dim)
            lists, codes = quantiser.encode(x)
            rows, probed = quantiser.probes(x, radius)
            member = {"list": lists.astype(np.int32), "query": np.zeros(len(reps), bool), "rep": reps, "n": copies, "unit": units, "codes": [c.tobytes() for c in codes]}
            asked = {"list": probed.astype(np.int32), "query": np.ones(len(rows), bool), "rep": [reps[k] for k in rows], "n": [copies[k] for k in rows], "unit": [units[k] for k in rows], "codes": [b""] * len(rows)}
            for part in (member, asked):
                yield pa.RecordBatch.from_pydict(part, schema=kinds)

    kinds = pa.schema([("list", pa.int32()), ("query", pa.bool_()), ("rep", pa.int64()), ("n", pa.int64()), ("unit", pa.binary()), ("codes", pa.binary())])
    placed = staged(distinct.select("rep", "n", "unit").mapInArrow(place, "list INT, query BOOLEAN, rep BIGINT, n BIGINT, unit BINARY, codes BINARY"), "pq-placed")
    # One row per list: how many blocks its members and its queries make.
    sizes = placed.groupBy("list").agg(F.sum(F.when(F.col("query"), 0).otherwise(1)).alias("members"), F.sum(F.col("query").cast("int")).alias("queries"))
    shape = sizes.select(
        "list", F.ceil(F.col("members") / MEMBER_BLOCK).cast("int").alias("m_blocks"), F.ceil(F.col("queries") / QUERY_BLOCK).cast("int").alias("q_blocks")
    ).filter("m_blocks > 0 AND q_blocks > 0")
    at = F.pmod(F.xxhash64("rep"), F.when(F.col("query"), F.col("q_blocks")).otherwise(F.col("m_blocks"))).cast("int")
    others = F.sequence(F.lit(0), F.when(F.col("query"), F.col("m_blocks")).otherwise(F.col("q_blocks")) - 1)
    blocks = (
        placed.join(F.broadcast(shape), "list")  # at most MAX_LISTS rows
        .withColumn("own", at)
        .withColumn("other", F.explode(others))
        .withColumn("m_block", F.when(F.col("query"), F.col("other")).otherwise(F.col("own")))
        .withColumn("q_block", F.when(F.col("query"), F.col("own")).otherwise(F.col("other")))
        .select("list", "m_block", "q_block", "query", "rep", "n", "unit", "codes")
    )

    def compare(frame: pd.DataFrame) -> pd.DataFrame:
        members, queries = frame[~frame["query"]], frame[frame["query"]]
        empty = pd.DataFrame({"rep": pd.Series(dtype="int64"), "links": pd.Series(dtype="int64"), "other": pd.Series(dtype="int64")})
        if members.empty or queries.empty:
            return empty
        x, q = stack(members["unit"].tolist(), dim), stack(queries["unit"].tolist(), dim)
        codes = np.frombuffer(b"".join(members["codes"]), np.uint8).reshape(len(members), -1)
        names, copies, asked = members["rep"].to_numpy(), members["n"].to_numpy(), queries["rep"].to_numpy()
        coarse = q @ quantiser.centroids[int(frame["list"].iloc[0])]
        forest, rows = Forest(), []
        for start in range(0, len(q), QUERY_STEP):
            part = q[start : start + QUERY_STEP]
            tables = quantiser.tables(part)
            score = np.repeat(coarse[start : start + QUERY_STEP, None], len(x), axis=1)
            for k in range(codes.shape[1]):
                score += tables[:, k, codes[:, k]]
            near_q, near_x = np.nonzero(score >= threshold - CODE_SLACK)
            exact = np.einsum("ij,ij->i", part[near_q], x[near_x]) if len(near_q) else np.zeros(0)
            linked = (exact >= threshold) & (asked[start + near_q] != names[near_x])
            near_q, near_x = near_q[linked], near_x[linked]
            sums = np.bincount(near_q, weights=copies[near_x], minlength=len(part)).astype(np.int64)
            for k in np.flatnonzero(sums):
                rows.append((int(asked[start + k]), int(sums[k]), None))
            for a, b in zip(asked[start + near_q].tolist(), names[near_x].tolist()):
                forest.join(a, b)
        rows += [(a, 0, b) for a, b in forest.edges()]
        return pd.DataFrame(rows, columns=["rep", "links", "other"]).astype({"other": "Int64"}) if rows else empty

    found = staged(blocks.groupBy("list", "m_block", "q_block").applyInPandas(compare, "rep BIGINT, links BIGINT, other BIGINT"), "pq-links")
    links = found.filter("other IS NULL").groupBy("rep").agg(F.sum("links").alias("links"))
    return links, found.filter("other IS NOT NULL").select(F.col("rep").alias("a"), F.col("other").alias("b"))


def _of_dimension(rows: DataFrame, dim: int, threshold: float) -> DataFrame:
    """:func:`near_duplicates` of the valid rows of one dimension, with a quantiser of their own."""
    distinct = staged(
        rows.groupBy("key").agg(F.min("vec_id").alias("least"), F.count(F.lit(1)).alias("n"), F.first("unit").alias("unit"))
        .withColumn("rep", F.coalesce("least", F.lit(-(2**62)) - F.monotonically_increasing_id())),
        "pq-distinct",
    )
    links, edges = search(distinct, fit_quantiser(distinct, dim, distinct.count()), dim, threshold)
    component = connected_components(edges)
    named = (
        distinct.select("key", "rep", "least", "n")
        .join(links, "rep", "left")
        .join(component.select(F.col("node").alias("rep"), "component"), "rep", "left")
        .select(
            F.col("key").alias("found"),
            (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("n_links"),
            F.coalesce("component", "least").alias("component_id"),
        )
    )
    joined = rows.join(named.hint("merge"), F.col("key") == F.col("found"))
    return joined.select("vec_id", "n_links", "component_id", F.col("vec_id").eqNullSafe(F.col("component_id")).alias("kept"))


def near_duplicates(vectors: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """Per row: ``vec_id, n_links, component_id, kept``."""
    rows = staged(_checked(vectors), "pq-vectors")
    # Vectors of different dimensions have no cosine: each dimension is a search of its own.
    dims = [r.dim for r in rows.filter("dim IS NOT NULL").select("dim").distinct().orderBy("dim").collect()]
    alone = rows.filter("dim IS NULL").select("vec_id", F.lit(0).cast("bigint").alias("n_links"), F.col("vec_id").alias("component_id"), F.lit(True).alias("kept"))
    found = [_of_dimension(rows.filter(F.col("dim") == d), d, threshold) for d in dims]
    return functools.reduce(DataFrame.unionByName, found, alone)
