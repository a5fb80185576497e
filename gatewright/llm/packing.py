"""Packing of tokenised documents into sequences of a fixed capacity.

Documents are cut into full pieces and one rest. Pieces are dealt at random
into groups of about ``group_pieces``; each group is packed on its own by
first-fit decreasing, which finds the leftmost open sequence with room by
descending a tournament tree of the free capacities. A group's size is a
parameter, so memory per task does not depend on the input, and neither a long
document nor a repeated id makes a large group: the deal is by piece, not by
document. Token ids never travel; a piece carries its checksum, and
:func:`sequences` brings the ids of packed pieces back where they are wanted.

Defined cases: a null text is an empty one; an empty document is one piece that
holds its end id. Rows with equal or null ids are packed as separate documents.
Of equal sizes, the piece with the smaller (document id, start) comes first.
An empty table gives no pieces. Further columns of the input are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gatewright.llm.byte_batch import byte_batch, slices
from gatewright.llm.common import staged, text_of, tokenizer_file

CAPACITY = 2048
END_ID = 1
GROUP_PIECES = 8192
PIECES = "doc_id BIGINT, start BIGINT, length BIGINT, ids_crc32 BIGINT, doc_tokens BIGINT"
PACKED = f"{PIECES}, sequence_id BIGINT, offset BIGINT"
GROUP = "__group"


def first_fit_decreasing(sizes: list[int], capacity: int) -> list[tuple[int, int]]:
    """Bin and offset of every size, given in decreasing order; bins are numbered in the order they open.

    ``tree[1]`` is the largest free capacity. Bins that are not open yet count as
    entirely free, so the leftmost fit opens a new bin only when no open one has room.
    """
    leaves = 1
    while leaves < len(sizes):
        leaves *= 2
    tree = [capacity] * (2 * leaves)
    placed = []
    for size in sizes:
        if not 0 < size <= capacity:
            raise ValueError(f"a piece of {size} does not fit {capacity}")
        node = 1
        while node < leaves:
            node *= 2
            if tree[node] < size:
                node += 1
        placed.append((node - leaves, capacity - tree[node]))
        tree[node] -= size
        node //= 2
        while node:
            left, right = tree[2 * node], tree[2 * node + 1]
            tree[node] = left if left > right else right
            node //= 2
    return placed


def cut_documents(docs: DataFrame, tokenizer: str | None = None, capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """The pieces of every document: full ones from its start, then the rest. The end id is the document's last."""
    file = tokenizer or tokenizer_file("byte_bpe_50k.json")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = byte_batch(file)
        for batch in batches:
            for part in slices(batch, 1):
                ids, counts = encoder.documents(part.column(1), end_id)
                data, out, first = memoryview(ids), [], 0
                for doc_id, total in zip(part.column(0).to_pylist(), counts.tolist()):
                    for at in range(0, total, capacity):
                        length = min(capacity, total - at)
                        out.append((doc_id, at, length, zlib.crc32(data[first + at : first + at + length]), total))
                    first += total
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out)], names)

    names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"]
    return docs.select("doc_id", text_of().alias("text")).mapInArrow(cut, PIECES)


def pack(pieces: DataFrame, capacity: int = CAPACITY, group_pieces: int = GROUP_PIECES, seed: int = 7) -> DataFrame:
    """Add ``sequence_id`` and ``offset`` to pieces that have ``doc_id``, ``start`` and ``length``.

    ``pieces`` should be a written table: it is counted first, and the random
    deal must not change when a task is run again.
    """
    groups = max(1, -(-pieces.count() // group_pieces))

    def fill(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values(["length", "doc_id", "start"], ascending=[False, True, True], kind="stable")
        placed = first_fit_decreasing(frame["length"].tolist(), capacity)
        first = int(frame[GROUP].iloc[0]) << 32
        out = frame.drop(columns=GROUP)
        out["sequence_id"] = [first + b for b, _ in placed]
        out["offset"] = [at for _, at in placed]
        return out

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in pieces.schema.fields)
    # The deal is written down: on a rerun the group of a row must not depend on the task that reads it.
    dealt = staged(pieces.withColumn(GROUP, F.floor(F.rand(seed) * groups).cast("long")), "pieces-dealt")
    return dealt.groupBy(GROUP).applyInPandas(fill, f"{schema}, sequence_id BIGINT, offset BIGINT")


def pack_documents(docs: DataFrame, tokenizer: str | None = None, capacity: int = CAPACITY, end_id: int = END_ID, group_pieces: int = GROUP_PIECES) -> DataFrame:
    """Every piece of ``docs`` with its place: the columns of ``PACKED``."""
    pieces = staged(cut_documents(docs, tokenizer, capacity, end_id), "pieces")
    return pack(pieces, capacity, group_pieces)


def sequences(docs: DataFrame, packed: DataFrame, tokenizer: str | None = None, end_id: int = END_ID) -> DataFrame:
    """The packed pieces with their ``ids``, for documents with unique ids: read them by ``sequence_id``, ``offset``."""
    file = tokenizer or tokenizer_file("byte_bpe_50k.json")

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = byte_batch(file)
        for batch in batches:
            for part in slices(batch, 1):
                ids, counts = encoder.documents(part.column(1), end_id)
                lists = pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(counts)), pa.int32()), pa.array(ids, pa.int64()))
                yield pa.RecordBatch.from_arrays([part.column(0), lists], ["doc_id", "doc_ids"])

    whole = docs.select("doc_id", text_of().alias("text")).mapInArrow(encode, "doc_id BIGINT, doc_ids ARRAY<BIGINT>")
    return packed.join(whole, "doc_id").select(
        "sequence_id", "offset", "doc_id", "start", F.expr("slice(doc_ids, cast(start + 1 AS int), cast(length AS int))").alias("ids")
    )
