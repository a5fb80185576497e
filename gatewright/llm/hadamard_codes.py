"""Compact codes of vectors by product quantisation in whole numbers, nearest entries found through the Walsh-Hadamard transform.

Components become whole numbers, ``floor(SCALE * x)``. A vector is cut into
``PARTS`` consecutive parts, each coded by the nearest entry of its position's
codebook. Parts and entries are padded with zeros to a power of two, ``width``,
and transformed; the transform keeps squared distances up to the factor
``width``. Its coefficients are ordered by sequency (number of sign changes), the
first ones holding the slow changes and usually most of a distance. Squared
differences are added up in that order, for the entries still in question only: an
entry is out once its sum, which never falls, exceeds the whole distance of the
entry that was nearest by the first coefficient. All of it is exact: 64-bit
integers where a bound shows that they suffice, Python's integers elsewhere.

A codebook starts as the parts of the ``ENTRIES`` smallest ids. Each of ``ROUNDS``
rounds is one pass over the table: every task adds up its parts per entry, the sums
(limbs of ``LIMB`` bits, so that no total overflows) are added by Spark, and the
driver gets one row per entry and component, whatever the table's size.

Defined cases: null vectors and vectors with a null or non-finite component are
dropped. Vectors of another length have codebooks of their own. A length that
``PARTS`` does not divide is padded with zeros at the end; a vector without
components has the code of zeros. With fewer vectors than entries, a codebook has
as many entries as vectors. Null ids come last, equal ids in the order of their
vectors; ties between entries go to the lower one. Repeated rows stay. Errors beyond
64 bits, and their label's total, are null. An empty table gives no rows. Further
columns are ignored.
"""

from __future__ import annotations

import functools
import hashlib
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gatewright.llm.common import staged

SCALE_BITS = 12
PARTS = 8
ENTRIES = 16
ROUNDS = 6
LIMB = 32
#: Rows transformed at once.
STEP = 4096
#: Labels with more than this share of the rows get their totals by a broadcast of at most its inverse rows.
HOT_SHARE = 1 / 1000
LONG = 2**63 - 1


@functools.cache
def sequency_order(width: int) -> np.ndarray:
    """The rows of the natural Hadamard matrix of a power of two, by their number of sign changes."""
    row = np.arange(width)
    changes = row ^ (row >> 1)  # sign changes of Walsh functions count in Gray code
    bits = width.bit_length() - 1
    reverse = np.zeros(width, np.int64)
    for k in range(bits):
        reverse |= ((changes >> k) & 1) << (bits - 1 - k)
    return reverse


def walsh_hadamard(parts: np.ndarray) -> np.ndarray:
    """The transform of rows, zero-padded to a power of two, coefficients in sequency order."""
    width = 1 << max(0, parts.shape[1] - 1).bit_length()
    x = np.zeros((len(parts), width), parts.dtype)
    x[:, : parts.shape[1]] = parts
    half = 1
    while half < width:
        pairs = x.reshape(len(x), -1, 2, half)
        x = np.stack([pairs[:, :, 0] + pairs[:, :, 1], pairs[:, :, 0] - pairs[:, :, 1]], axis=2).reshape(len(x), width)
        half *= 2
    return x[:, sequency_order(width)]


def largest(x: np.ndarray) -> int:
    return int(max(abs(x.max()), abs(x.min()))) if x.size else 0


def nearest(parts: np.ndarray, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Index and squared distance of each part's nearest entry (whole numbers in both), the lower index on a tie."""
    width = 1 << max(0, parts.shape[1] - 1).bit_length()
    if (width * (largest(parts) + largest(entries))) ** 2 * width > LONG:
        parts, entries = parts.astype(object), entries.astype(object)
    x, e = walsh_hadamard(parts), walsh_hadamard(entries)
    rows = np.arange(len(x))
    seed = np.abs(x[:, :1] - e[:, 0]).argmin(axis=1)
    bound = ((x - e[seed]) ** 2).sum(axis=1)
    row, entry = np.repeat(rows, len(e)), np.tile(np.arange(len(e)), len(x))
    total = np.zeros(len(row), x.dtype)
    for k in range(width):
        total = total + (x[row, k] - e[entry, k]) ** 2
        stays = (total <= bound[row]).astype(bool)
        row, entry, total = row[stays], entry[stays], total[stays]
    # What is left are all entries at most as far as the first guess, by row and entry.
    first = np.searchsorted(row, rows)
    least = np.minimum.reduceat(total, first) if len(rows) else total
    hits = np.flatnonzero((total == least[row]).astype(bool))
    best = hits[np.searchsorted(row[hits], rows)]
    return entry[best], total[best] // width


def whole_numbers(x: np.ndarray) -> np.ndarray:
    """``floor(2**SCALE_BITS * x)`` of doubles, as 64-bit integers if all fit well within."""
    if not x.size or np.abs(x).max() < 2.0**36:
        return np.floor(x * 2.0**SCALE_BITS).astype(np.int64)
    # From 2**53 on a double is a whole number itself; scaling it as a double could overflow.
    values = [int(v) << SCALE_BITS if abs(v) >= 2.0**53 else math.floor(v * 2.0**SCALE_BITS) for v in x.ravel().tolist()]
    return np.array(values, object).reshape(x.shape)


def part_length(dimension: int, parts: int = PARTS) -> int:
    return -(-dimension // parts)


def by_part(x: np.ndarray, parts: int = PARTS) -> np.ndarray:
    """Vectors as (vector, part, position), zeros at the end where the length does not divide."""
    length = part_length(x.shape[1], parts)
    out = np.zeros((len(x), parts * length), x.dtype)
    out[:, : x.shape[1]] = x
    return out.reshape(len(x), parts, length)


@dataclass
class Codebooks:
    """The entries of one vector length: (part, entry, position), whole numbers."""

    entries: np.ndarray

    def assign(self, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Entry and squared distance of every part: (vector, part) each."""
        parts = by_part(vectors, len(self.entries))
        if not parts.shape[2]:
            zero = np.zeros(parts.shape[:2], np.int64)
            return zero, zero
        found = [nearest(parts[:, p], self.entries[p]) for p in range(parts.shape[1])]
        return np.stack([f[0] for f in found], axis=1), np.stack([f[1] for f in found], axis=1)

    def digest(self) -> str:
        return hashlib.sha256(",".join(str(int(v)) for v in self.entries.ravel()).encode()).hexdigest()


def valid_vectors(batch: pa.RecordBatch, column: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Rows of a batch and their vectors as doubles, by length; vectors that are null or hold null or non-finite components are left out."""
    lists = batch.column(column)
    there = lists.is_valid().to_numpy(zero_copy_only=False)
    offsets = lists.offsets.to_numpy().astype(np.int64)
    values = lists.values.to_numpy(zero_copy_only=False).astype(np.float64)
    lengths = np.diff(offsets)
    for length in np.unique(lengths[there]).tolist():
        rows = np.flatnonzero(there & (lengths == length))
        for at in range(0, len(rows), STEP):
            some = rows[at : at + STEP]
            vectors = values[offsets[some][:, None] + np.arange(length)] if length else np.zeros((len(some), 0))
            fine = np.isfinite(vectors).all(axis=1)
            yield some[fine], vectors[fine]


def as_doubles(vectors: DataFrame) -> DataFrame:
    return vectors.select(F.col("vec_id").cast("bigint").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding"), F.col("label"))


def first_codebooks(vectors: DataFrame, entries: int = ENTRIES, parts: int = PARTS) -> dict[int, Codebooks]:
    """Per vector length, the parts of the vectors with the smallest ids."""
    fine = ~F.exists("embedding", lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
    order = Window.partitionBy("dimension").orderBy(F.asc_nulls_last("vec_id"), "embedding")
    # Every task keeps its own smallest rows before any are shuffled.
    rows = (
        as_doubles(vectors)
        .filter(F.col("embedding").isNotNull() & fine)
        .select(F.size("embedding").alias("dimension"), "vec_id", "embedding")
        .withColumn("rank", F.row_number().over(order))
        .filter(F.col("rank") <= entries)
        .orderBy("dimension", "rank")
        .collect()
    )
    found: dict[int, list[list[float]]] = {}
    for r in rows:
        found.setdefault(r.dimension, []).append(r.embedding)
    return {d: Codebooks(by_part(whole_numbers(np.array(x, np.float64).reshape(len(x), d)), parts).transpose(1, 0, 2)) for d, x in found.items()}


def limbs(total: int) -> Iterator[tuple[int, int]]:
    """A whole number in signed limbs: (limb, value) of those that are not zero."""
    sign, rest, k = (-1 if total < 0 else 1), abs(total), 0
    while rest:
        rest, limb = divmod(rest, 1 << LIMB)
        if limb:
            yield k, sign * limb
        k += 1


def improved(vectors: DataFrame, books: dict[int, Codebooks]) -> dict[int, Codebooks]:
    """One round: every entry becomes the floor of the mean of the parts it is nearest to; unused entries stay."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = {d: np.zeros(b.entries.shape, object) for d, b in books.items()}
        counts = {d: np.zeros(b.entries.shape[:2], np.int64) for d, b in books.items()}
        for batch in batches:
            for _, doubles in valid_vectors(batch, 0):
                d = doubles.shape[1]
                if not len(doubles) or not d:
                    continue
                numbers = whole_numbers(doubles)
                entry, _ = books[d].assign(numbers)
                parts = by_part(numbers, len(books[d].entries))
                for p in range(parts.shape[1]):
                    for e in np.unique(entry[:, p]).tolist():
                        mine = parts[entry[:, p] == e, p]
                        sums[d][p, e] += mine.sum(axis=0).astype(object)  # STEP values below 2**48 each, or Python's integers
                        counts[d][p, e] += len(mine)
        rows = []
        for d in books:
            for p, e in zip(*np.nonzero(counts[d])):
                rows.append((d, int(p), int(e), -1, 0, int(counts[d][p, e])))
                rows.extend((d, int(p), int(e), at, limb, value) for at, total in enumerate(sums[d][p, e]) for limb, value in limbs(int(total)))
        names = ["dimension", "part", "entry", "position", "limb", "value"]
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in (zip(*rows) if rows else [[]] * 6)], names)

    kinds = "dimension BIGINT, part BIGINT, entry BIGINT, position BIGINT, limb BIGINT, value BIGINT"
    partial = as_doubles(vectors).select("embedding").mapInArrow(add, kinds)
    totals: dict[tuple[int, int, int, int], int] = {}
    # A row per component and limb of the codebooks.
    for r in partial.groupBy("dimension", "part", "entry", "position", "limb").agg(F.sum("value").alias("value")).collect():
        key = r.dimension, r.part, r.entry, r.position
        totals[key] = totals.get(key, 0) + (r.value << (LIMB * r.limb))
    out = {}
    for d, book in books.items():
        entries = book.entries.astype(object)
        for (dim, p, e, at), count in totals.items():
            if dim == d and at == -1:
                for k in range(entries.shape[2]):
                    entries[p, e, k] = totals.get((d, p, e, k), 0) // count
        out[d] = Codebooks(entries.astype(np.int64) if largest(entries) < 2**62 else entries)
    return out


def fit(vectors: DataFrame, entries: int = ENTRIES, parts: int = PARTS, rounds: int = ROUNDS) -> dict[int, Codebooks]:
    """Codebooks per vector length."""
    books = first_codebooks(vectors, entries, parts)
    for _ in range(rounds if books else 0):
        books = improved(vectors, books)
    return books


def encode(vectors: DataFrame, books: dict[int, Codebooks]) -> DataFrame:
    """``vec_id, label, code, error, codebooks_sha256`` of every valid row of the lengths in ``books``."""
    digests = {d: b.digest() for d, b in books.items()}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, doubles in valid_vectors(batch, 1):
                if not len(rows):
                    continue
                book = books[doubles.shape[1]]
                entry, distance = book.assign(whole_numbers(doubles))
                errors = distance.astype(object).sum(axis=1).tolist()
                columns = [
                    batch.column(0).take(pa.array(rows)),
                    batch.column(2).take(pa.array(rows)),
                    pa.array(["".join(f"{e:02x}" for e in row) for row in entry.tolist()], pa.string()),
                    pa.array([e if e <= LONG else None for e in errors], pa.int64()),
                    pa.array([digests[doubles.shape[1]]] * len(rows), pa.string()),
                ]
                yield pa.RecordBatch.from_arrays(columns, ["vec_id", "label", "code", "error", "codebooks_sha256"])

    label = vectors.schema["label"].dataType.simpleString()
    return as_doubles(vectors).mapInArrow(run, f"vec_id BIGINT, label {label}, code STRING, error BIGINT, codebooks_sha256 STRING")


def with_label_error(coded: DataFrame, hot_share: float = HOT_SHARE) -> DataFrame:
    """Add ``label_error``, the errors of a label's rows added up. ``coded`` should be a written table.

    Labels with more than ``hot_share`` of the rows, at most its inverse many, are
    looked up by broadcast; the rest is joined by label, where none is large.
    """
    whole = F.count("error") == F.count(F.lit(1))
    totals = staged(coded.groupBy("label").agg(F.count(F.lit(1)).alias("n"), F.when(whole, F.try_sum("error")).alias("label_error")), "label-errors")
    rows = totals.agg(F.sum("n")).head()[0] or 0
    hot = totals.filter(F.col("n") > hot_share * rows).select(F.col("label").alias("of"), "label_error")
    cold = totals.filter(F.col("n") <= hot_share * rows).select(F.col("label").alias("of"), "label_error")
    same = F.col("label").eqNullSafe(F.col("of"))
    return coded.join(F.broadcast(hot), same).unionByName(coded.join(F.broadcast(hot.select("of")), same, "left_anti").join(cold, same)).drop("of")


def compress(vectors: DataFrame) -> DataFrame:
    """``vec_id, code, error, label_error, codebooks_sha256`` of every valid vector."""
    coded = staged(encode(vectors, fit(vectors)), "vector-codes")
    return with_label_error(coded).select("vec_id", "code", "error", "label_error", "codebooks_sha256")
