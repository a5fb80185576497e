"""Alignment of two tokenizers' tokens by merge-path partitioning, and how often token pairs go together in the corpus.

The ends of a text's tokens under A and under B are two ascending lists. Their
merge is a path through the grid of both lists, and the point where the path
crosses a diagonal (``a`` ends of A taken, ``b`` of B, ``a + b`` given) is found
by binary search. Diagonals ``PIECE`` apart cut the merging of a whole batch,
however its documents and words are made, into independent pieces of equal work.
All pieces advance together, one step at a time; each emits the overlaps of an A
and a B token that it passes, and whether both end there. Pieces are then
stitched: a group goes on over a boundary until both tokens end, so the number of
common ends in the pieces before numbers a piece's groups.

The first pass over the documents writes one row per slice of documents (about
``SLICE_BYTES`` of text): per document its figures and its distinct linked id
pairs with their number of links, and per slice its distinct pairs with the number
of documents that hold them. Those are added up over the corpus by pair, every A
id's highest count is marked, and each slice fetches the counts of its own pairs.
No table of the corpus is sent to every task, and a pair that occurs in every
document is one row per slice.

Defined cases: null and empty texts, and texts whose tokens do not spell
blank + text (such as those with U+2581), have no tokens: zeros and ''. Rows with
equal or null ids are documents of their own. Ties for an A id's highest count all
count as best. A long text is a slice of its own. A large group's links are counted
by its distinct ids, so their number does not matter. An empty table gives no rows.
Further columns are ignored.
"""

from __future__ import annotations

import functools
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gatewright.llm.byte_batch import ByteBatch, cut_units, ragged, slices, sums_by_run
from gatewright.llm.common import staged, tokenizer_file

#: Steps of a piece of the merge.
PIECE = 64
#: Pairs of a group beyond which its ids are counted before they are paired.
LARGE_GROUP = 1024
#: Text aligned at once, and text of a slice.
ALIGN_BYTES = 2 << 20
SLICE_BYTES = 8 << 20
WORD_MARK = "▁"
#: A slice as one row: figures per document, its held pairs (packed) and the slice's distinct pairs.
SLICES = (
    "slice BIGINT, doc_id ARRAY<BIGINT>, n_a ARRAY<BIGINT>, n_b ARRAY<BIGINT>, n_groups ARRAY<BIGINT>, n_links ARRAY<BIGINT>, "
    "groups_sha256 ARRAY<STRING>, n_held ARRAY<BIGINT>, held BINARY, links BINARY, pair ARRAY<BIGINT>, pair_docs ARRAY<BIGINT>"
)
RESULT = "doc_id BIGINT, n_a BIGINT, n_b BIGINT, n_groups BIGINT, n_links BIGINT, n_best BIGINT, count_sum BIGINT, groups_sha256 STRING"


def crossings(a: np.ndarray, b: np.ndarray, diagonals: np.ndarray) -> np.ndarray:
    """How many values of ``a`` the merge of two ascending lists takes before each diagonal; ``a`` goes first where values are equal."""
    low, high = np.maximum(0, diagonals - len(b)), np.minimum(diagonals, len(a))
    while True:
        open_ = low < high
        if not open_.any():
            return low
        middle = (low + high) // 2
        left, right = np.minimum(middle, len(a) - 1), np.clip(diagonals - 1 - middle, 0, max(0, len(b) - 1))
        taken = open_ & (a[left] <= b[right])
        low = np.where(taken, middle + 1, low)
        high = np.where(open_ & ~taken, middle, high)


def groups_of(a: np.ndarray, b: np.ndarray, piece: int = PIECE) -> tuple[np.ndarray, np.ndarray]:
    """The group of every A and of every B token, from the ascending ends of both, the last of which are equal."""
    total = len(a) + len(b)
    diagonals = np.arange(0, total, piece)
    i = crossings(a, b, diagonals)
    j = diagonals - i
    # Where the step before each piece ended. Between two equal ends there is nothing to overlap.
    passed = np.maximum(np.where(i > 0, a[i - 1], 0), np.where(j > 0, b[j - 1], 0))
    never = np.full(piece, np.iinfo(np.int64).max)
    ends_a, ends_b = np.concatenate([a, never]), np.concatenate([b, never])
    closed = np.zeros(len(diagonals), np.int32)
    piece_a, group_a = np.zeros(len(a), np.int32), np.zeros(len(a), np.int64)
    piece_b, group_b = np.zeros(len(b), np.int32), np.zeros(len(b), np.int64)
    for step in range(piece):
        at_a, at_b = ends_a[i], ends_b[j]
        end = np.minimum(at_a, at_b)
        overlap = end > passed
        overlap[diagonals + step >= total] = False  # the last piece may be shorter
        seen = np.flatnonzero(overlap)
        of_a, of_b, group = i[seen], j[seen], closed[seen]
        piece_a[of_a], group_a[of_a] = seen, group
        piece_b[of_b], group_b[of_b] = seen, group
        closed[seen] += at_a[seen] == at_b[seen]
        takes_a = at_a <= at_b
        i, j, passed = i + takes_a, j + ~takes_a, end
    before = np.cumsum(closed, dtype=np.int64) - closed
    return group_a + before[piece_a], group_b + before[piece_b]


def summed(keys: np.ndarray, weights: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys in order and the sum of each one's weights (1 if none are given)."""
    if weights is None:
        keys = np.sort(keys)
    else:
        order = np.argsort(keys, kind="stable")
        keys, weights = keys[order], weights[order]
    first = np.flatnonzero(np.append(True, keys[1:] != keys[:-1])) if len(keys) else np.zeros(0, np.int64)
    if weights is None:
        return keys[first], np.diff(first, append=len(keys))
    return keys[first], np.add.reduceat(weights, first) if len(first) else weights


class Spelling:
    """The bytes of every token of a vocabulary, and the decimal digits of its ids."""

    def __init__(self, tokens: list[bytes]):
        self.length = np.array([len(t) for t in tokens], np.int64)
        self.start = np.cumsum(self.length) - self.length
        self.data = np.frombuffer(b"".join(tokens), np.uint8)
        self.digits = np.array([list(str(i).encode().rjust(len(str(len(tokens))), b"\0")) for i in range(len(tokens))], np.uint8)

    def spells(self, ids: np.ndarray, counts: np.ndarray, data: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """For each unit (its ids, its bytes) whether the ids' bytes are the unit's."""
        length = sums_by_run(self.length[ids], counts)
        good = length == sizes
        ids, data = ids[np.repeat(good, counts)], data[np.repeat(good, sizes)]
        wrong = self.data[ragged(self.start[ids], self.length[ids])] != data
        good[good] = sums_by_run(wrong, sizes[good]) == 0
        return good


class Pieces:
    """Ids of units by a sentencepiece model."""

    def __init__(self, file: str):
        import sentencepiece

        self.library = lib = sentencepiece.SentencePieceProcessor(model_file=file)
        names = [lib.id_to_piece(i) for i in range(lib.get_piece_size())]
        #: Whether no piece crosses a line feed, or the place before a run of blanks: only then texts may be cut there.
        self.cuts = not any("\n" in n or WORD_MARK in n.lstrip(WORD_MARK) for n in names)
        self.feed = len(lib.encode("\n"))

    def token_bytes(self) -> list[bytes]:
        lib = self.library
        return [
            bytes([int(name[3:5], 16)]) if lib.is_byte(i) else name.replace(WORD_MARK, " ").encode()
            for i, name in enumerate(map(lib.id_to_piece, range(lib.get_piece_size())))
        ]

    def units(self, units: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of distinct units and how many each has. The library puts a blank in front, which is a unit's first character or else goes again."""
        texts = units.to_pylist()
        blank = [t.startswith(" ") for t in texts]
        # A unit after a line feed gets one in front, so that the blank is not its own.
        ids = self.library.encode([t[1:] if b else "\n" + t for t, b in zip(texts, blank)], num_threads=1)
        ids = [i if b else i[self.feed :] for i, b in zip(ids, blank)]
        counts = np.fromiter(map(len, ids), np.int64, len(ids))
        return np.fromiter((i for x in ids for i in x), np.int64, int(counts.sum())), counts


class Aligner:
    def __init__(self, file_a: str, file_b: str, piece: int = PIECE, large_group: int = LARGE_GROUP):
        self.a, self.b = ByteBatch(file_a, special_as_text=True), Pieces(file_b)
        self.spelling_a, self.spelling_b = Spelling(self.a.token_bytes()), Spelling(self.b.token_bytes())
        self.width = len(self.spelling_b.length)
        self.piece, self.large_group = piece, large_group

    def tokens(self, texts: pa.Array) -> tuple[tuple[np.ndarray, np.ndarray], tuple[np.ndarray, np.ndarray]]:
        """Ids of A and B of all texts, one text after the other, and each text's number of them: none where they do not spell blank + text."""
        there = pc.not_equal(pc.fill_null(texts, ""), "").to_numpy(zero_copy_only=False)
        whole = None if self.b.cuts else np.ones(len(texts), bool)
        units, at, places = cut_units(pc.fill_null(texts, ""), " ", whole)
        sides = self.a.units(units), self.b.units(units)
        sizes = pc.binary_length(units).to_numpy(zero_copy_only=False).astype(np.int64)
        data = np.frombuffer(b"".join(u.encode() for u in units.to_pylist()), np.uint8)
        good = self.spelling_a.spells(*sides[0], data, sizes) & self.spelling_b.spells(*sides[1], data, sizes)
        kept = there & (sums_by_run(~good[at], places) == 0)
        at, places = at[np.repeat(kept, places)], np.where(kept, places, 0)
        out = []
        for ids, counts in sides:
            starts = np.cumsum(counts) - counts
            out.append((ids[ragged(starts[at], counts[at])].astype(np.int64), sums_by_run(counts[at], places)))
        return out[0], out[1]

    def align(self, texts: pa.Array) -> dict[str, np.ndarray | list[str]]:
        """Per text its figures; per text and distinct pair (``id of A * width + id of B``) the links."""
        (a, n_a), (b, n_b) = self.tokens(texts)
        group_a, group_b = groups_of(np.cumsum(self.spelling_a.length[a]), np.cumsum(self.spelling_b.length[b]), self.piece)
        in_a, in_b = np.bincount(group_a), np.bincount(group_b)
        last = np.cumsum(n_a)
        upto = np.where(last > 0, group_a[last - 1] + 1, 0) if len(a) else np.zeros(len(last), np.int64)
        n_groups = np.diff(upto, prepend=0)
        links = in_a * in_b
        doc_of = np.repeat(np.arange(len(n_a)), n_groups)
        doc, pair, count = self._pairs(a, b, group_a, in_a, in_b, doc_of)
        return {
            "n_a": n_a, "n_b": n_b, "n_groups": n_groups, "n_links": sums_by_run(links, n_groups), "groups_sha256": self._digests(a, b, group_a, group_b, in_a, in_b, n_a, n_b),
            "n_held": np.bincount(doc, minlength=len(n_a)), "held": pair, "links": count,
        }

    def _pairs(self, a, b, group_a, in_a, in_b, doc_of):
        """Document, pair and links of every distinct pair of a document, in this order."""
        area = len(self.spelling_a.length) * self.width
        large = np.flatnonzero(in_a * in_b > self.large_group)
        partners = in_b.copy()
        partners[large] = 0
        first_b = np.cumsum(in_b) - in_b
        times = partners[group_a]
        keys = np.repeat(doc_of[group_a] * area + a * self.width, times) + b[ragged(first_b[group_a], times)]
        keys, counts = summed(keys)
        if len(large):
            first_a = np.cumsum(in_a) - in_a
            parts = [(keys, counts)]
            for g in large.tolist():
                (of_a, much_a), (of_b, much_b) = (np.unique(x[f[g] : f[g] + n[g]], return_counts=True) for x, f, n in ((a, first_a, in_a), (b, first_b, in_b)))
                parts.append(((doc_of[g] * area + of_a[:, None] * self.width + of_b).ravel(), (much_a[:, None] * much_b).ravel()))
            keys, counts = summed(*(np.concatenate(x) for x in zip(*parts)))
        return keys // area, keys % area, counts

    def _digests(self, a, b, group_a, group_b, in_a, in_b, n_a, n_b) -> list[str]:
        """SHA-256 of every text's groups, ids of A and B side by side."""
        upto_a, before_b = np.cumsum(in_a), np.cumsum(in_b) - in_b
        rows = len(a) + len(b)
        wide = max(self.spelling_a.digits.shape[1], self.spelling_b.digits.shape[1]) + 1
        written = np.zeros((rows, wide), np.uint8)
        for ids, group, others, digits, closing in ((a, group_a, before_b, self.spelling_a.digits, b"|"), (b, group_b, upto_a, self.spelling_b.digits, b";")):
            at = np.arange(len(ids)) + others[group] if len(ids) else np.zeros(0, np.int64)
            written[at, wide - 1 - digits.shape[1] : wide - 1] = digits[ids]
            written[at, wide - 1] = np.where(np.append(group[1:] != group[:-1], True)[: len(ids)], closing[0], ord(","))
        shown = written != 0
        text = written[shown].tobytes()
        ends = np.cumsum(sums_by_run(shown.sum(axis=1), n_a + n_b))
        starts = np.append(0, ends[:-1])
        return [hashlib.sha256(text[s : e - 1]).hexdigest() if e > s else "" for s, e in zip(starts.tolist(), ends.tolist())]


@functools.lru_cache(maxsize=2)
def aligner(file_a: str, file_b: str) -> Aligner:
    """One instance per pair of files and Python worker."""
    return Aligner(file_a, file_b)


def pack_numbers(values: np.ndarray) -> bytes:
    return pa.compress(np.ascontiguousarray(values, "<i8").tobytes(), codec="zstd", asbytes=True)


def unpack_numbers(data: bytes, count: int) -> np.ndarray:
    return np.frombuffer(pa.decompress(data, decompressed_size=8 * count, codec="zstd", asbytes=True), "<i8") if count else np.zeros(0, np.int64)


class Gathered:
    """Aligned documents of one slice until it is written."""

    def __init__(self):
        self.columns: dict[str, list] = {}
        self.bytes = 0

    def add(self, ids: pa.Array, found: dict[str, np.ndarray | list[str]], size: int) -> None:
        for name, values in {"doc_id": ids, **found}.items():
            self.columns.setdefault(name, []).append(values)
        self.bytes += size

    def row(self, number: int) -> pa.RecordBatch:
        joined = {k: pa.concat_arrays([x if isinstance(x, pa.Array) else pa.array(x) for x in v]) for k, v in self.columns.items()}
        held, links = joined.pop("held").to_numpy(), joined.pop("links").to_numpy()
        pair, place = np.unique(held, return_inverse=True)
        out = {k: pa.ListArray.from_arrays(pa.array([0, len(v)], pa.int32()), v) for k, v in joined.items()}
        out |= {"slice": pa.array([number]), "held": pa.array([pack_numbers(place)]), "links": pa.array([pack_numbers(links)])}
        for name, values in (("pair", pair), ("pair_docs", np.bincount(place, minlength=len(pair)))):
            out[name] = pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), pa.array(values, pa.int64()))
        return pa.RecordBatch.from_arrays([out[n] for n in COLUMNS], COLUMNS)


COLUMNS = [c.split()[0] for c in SLICES.split(", ")]


def align_slices(docs: DataFrame, file_a: str, file_b: str, slice_bytes: int = SLICE_BYTES) -> DataFrame:
    """One row per slice of documents: the columns of ``SLICES``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        number, gathered, both = TaskContext.get().partitionId() << 32, Gathered(), aligner(file_a, file_b)
        for batch in batches:
            for part in slices(batch, 1, ALIGN_BYTES):
                gathered.add(part.column(0), both.align(part.column(1)), part.column(1).nbytes)
                if gathered.bytes >= slice_bytes:
                    yield gathered.row(number)
                    number, gathered = number + 1, Gathered()
        if gathered.columns:
            yield gathered.row(number)

    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").mapInArrow(run, SLICES)


def pair_counts(slices_: DataFrame, width: int) -> DataFrame:
    """``pair, n, best``: in how many documents of the corpus a pair is linked, and whether no other pair of its A id is in more."""
    counts = slices_.select(F.explode(F.arrays_zip("pair", "pair_docs")).alias("p")).groupBy(F.col("p.pair").alias("pair")).agg(F.sum("p.pair_docs").alias("n"))
    # At most as many rows per id of A as B has ids.
    highest = F.max("n").over(Window.partitionBy(F.expr(f"pair div {width}")))
    return counts.select("pair", "n", (F.col("n") == highest).alias("best"))


def align_documents(docs: DataFrame, file_a: str | None = None, file_b: str | None = None, slice_bytes: int = SLICE_BYTES) -> DataFrame:
    """Per document: the columns of ``RESULT``."""
    file_a, file_b = file_a or tokenizer_file("byte_bpe_50k.json"), file_b or tokenizer_file("piece_bpe_32k.model")
    aligned = staged(align_slices(docs, file_a, file_b, slice_bytes), "aligned-slices")
    counts = pair_counts(aligned, Pieces(file_b).library.get_piece_size())
    wanted = aligned.select("slice", F.posexplode("pair").alias("at", "wanted"))
    fetched = (
        wanted.join(counts, F.col("wanted") == F.col("pair"))
        .groupBy("slice")
        .agg(F.collect_list(F.struct("at", "n", "best")).alias("counts"))  # a slice's own pairs
        .select(F.col("slice").alias("of"), "counts")
    )
    both = aligned.drop("pair", "pair_docs").join(fetched, F.col("slice") == F.col("of"), "left")

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                row = {name: batch.column(name)[k] for name in batch.schema.names}
                held = row["n_held"].values.to_numpy()
                total = int(held.sum())
                n_best = count_sum = np.zeros(len(held), np.int64)
                if total:
                    fetched = row["counts"].values
                    at, n, best = (fetched.field(c).to_numpy(zero_copy_only=False) for c in ("at", "n", "best"))
                    count, top = np.zeros(len(at), np.int64), np.zeros(len(at), bool)
                    count[at], top[at] = n, best
                    place, links = unpack_numbers(row["held"].as_py(), total), unpack_numbers(row["links"].as_py(), total)
                    n_best, count_sum = sums_by_run(links * top[place], held), sums_by_run(links * count[place], held)
                values = {"n_best": pa.array(n_best), "count_sum": pa.array(count_sum)}
                names = [c.split()[0] for c in RESULT.split(", ")]
                yield pa.RecordBatch.from_arrays([values[c] if c in values else row[c].values for c in names], names)

    names = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "n_held", "held", "links", "counts"]
    return both.select(names).mapInArrow(finish, RESULT)
