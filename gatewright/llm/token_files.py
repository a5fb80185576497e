"""Token ids in files coded by a static range asymmetric numeral system (rANS).

All files of a folder share one table of token frequencies, counted over the
whole corpus and scaled to ``2**TABLE_BITS``. A file holds independent blocks.
In a block the tokens are dealt to interleaved lanes, each a coder of its own,
so one numpy step codes a token of every lane. Checkpoints keep the lanes'
states and the place in the words, so decoding can start in the middle; CRC-32
sums guard the coded words and the decoded ids.

Block: ``<IHHIII`` tokens, lanes, checkpoints, words, CRC of the ids (little-endian
unsigned 32 bit), CRC of the rest; per checkpoint ``<II`` step and word plus the
lanes' states (unsigned 64 bit); the words (unsigned 32 bit). File: blocks, footer
(JSON, deflated), ``<I`` its length, ``MAGIC``.

Documents are ordered by ``doc_id``, nulls first, equal ids in the order of the
input. A null text is an empty one and holds only its end id. An empty table
gives no files. A text may be as long as memory allows for one row. Further columns
are ignored.
"""

from __future__ import annotations

import json
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from gatewright.llm.byte_batch import byte_batch, slices
from gatewright.llm.common import staged, text_of, tokenizer_file
from gatewright.llm.files import reading, shared_uri, writing

END_ID = 2
MAGIC = b"TOKRANS1"
TABLE_BITS = 20
STATE_LOW = 1 << 31
WORD_BITS = 32
LANES = 512
BLOCK_TOKENS = 1 << 17
CHECKPOINT_STEPS = 128
COUNT_TASKS = 16
HEADER = struct.Struct("<IHHIII")
MARK = struct.Struct("<II")
FILES = "part BIGINT, uri STRING, n_docs BIGINT, n_tokens BIGINT"


class FrequencyTable:
    """Scaled frequencies of all token ids; ids that never occur have none and cannot be coded."""

    def __init__(self, frequencies: np.ndarray):
        if frequencies.sum() != 1 << TABLE_BITS:
            raise ValueError("frequencies must sum up to the table's size")
        self.frequency = frequencies.astype(np.uint64)
        self.start = np.concatenate([[0], np.cumsum(frequencies)[:-1]]).astype(np.uint64)
        self.symbol = np.repeat(np.arange(len(frequencies), dtype=np.uint32), frequencies)

    @classmethod
    def of_counts(cls, counts: np.ndarray) -> FrequencyTable:
        """Scale counts so that every token that occurs keeps a share of at least one slot."""
        size, seen = 1 << TABLE_BITS, counts > 0
        if seen.sum() > size:
            raise ValueError("more distinct tokens than table slots")
        scaled = np.zeros(len(counts), dtype=np.int64)
        if not seen.any():
            scaled[0] = size
            return cls(scaled)
        free = size - int(seen.sum())
        share = counts[seen].astype(np.float64) / counts.sum() * free
        whole = np.floor(share).astype(np.int64)
        spare = free - int(whole.sum())
        whole[np.argsort(whole - share, kind="stable")[:spare]] += 1
        scaled[seen] = whole + 1
        return cls(scaled)


def encode_block(ids: np.ndarray, table: FrequencyTable) -> bytes:
    steps = -(-len(ids) // LANES)
    state = np.full(LANES, STATE_LOW, dtype=np.uint64)
    words: list[np.ndarray] = []
    marks: list[tuple[int, int, bytes]] = []
    written, half, bits = 0, np.uint64(WORD_BITS), np.uint64(TABLE_BITS)
    for step in range(steps - 1, -1, -1):
        symbols = ids[step * LANES : (step + 1) * LANES]
        f, c = table.frequency[symbols], table.start[symbols]
        x = state[: len(symbols)]
        full = x >= (f << np.uint64(31 + WORD_BITS - TABLE_BITS))
        low = x[full]
        words.append(low.astype(np.uint32))
        written += len(low)
        x[full] = low >> half
        quotient = x // f
        state[: len(symbols)] = (quotient << bits) + (x - quotient * f) + c
        if step % CHECKPOINT_STEPS == 0:
            marks.append((step, written, state.tobytes()))
    # Decoding goes forward, so places count from the other end.
    body = b"".join(MARK.pack(step, written - place) + states for step, place, states in reversed(marks))
    body += np.concatenate(words[::-1] or [np.zeros(0, np.uint32)]).astype("<u4").tobytes()
    return HEADER.pack(len(ids), LANES, len(marks), written, zlib.crc32(ids.astype("<u4").tobytes()), zlib.crc32(body)) + body


def body_size(header: bytes) -> int:
    _, lanes, marks, words, _, _ = HEADER.unpack(header)
    return marks * (MARK.size + 8 * lanes) + 4 * words


def decode_block(header: bytes, body: bytes, table: FrequencyTable, first: int = 0, count: int | None = None) -> np.ndarray:
    """The ids of a block from ``first`` on, starting at the last checkpoint before it. Raises if a checksum differs."""
    total, lanes, n_marks, _, ids_crc, body_crc = HEADER.unpack(header)
    if zlib.crc32(body) != body_crc:
        raise ValueError("a coded block is damaged")
    last = total if count is None else min(total, first + count)
    if first >= last:
        return np.zeros(0, np.uint32)
    size = MARK.size + 8 * lanes
    words = np.frombuffer(body, "<u4", offset=n_marks * size).astype(np.uint64)
    mark = min(n_marks - 1, first // lanes // CHECKPOINT_STEPS)
    step, place = MARK.unpack_from(body, mark * size)
    state = np.frombuffer(body, "<u8", lanes, mark * size + MARK.size).astype(np.uint64)
    begin, slots = step * lanes, np.uint64((1 << TABLE_BITS) - 1)
    out = np.empty(last - begin, dtype=np.uint32)
    bits, half, low = np.uint64(TABLE_BITS), np.uint64(WORD_BITS), np.uint64(STATE_LOW)
    for at in range(begin, last, lanes):
        width = min(lanes, total - at)
        x = state[:width]
        slot = x & slots
        symbols = table.symbol[slot]
        out[at - begin : at - begin + width] = symbols[: last - at]
        x = table.frequency[symbols] * (x >> bits) + slot - table.start[symbols]
        empty = np.flatnonzero(x < low)
        x[empty] = (x[empty] << half) | words[place : place + len(empty)]
        place += len(empty)
        state[:width] = x
    out = out[first - begin :]
    if len(out) == total and zlib.crc32(out.astype("<u4").tobytes()) != ids_crc:
        raise ValueError("decoded ids differ from the coded ones")
    return out


def write_file(uri: str, pieces: Iterator[np.ndarray], doc_ids: list, lengths: list[int], table: FrequencyTable) -> None:
    """Code a stream of ids block by block; memory holds one block and the list of documents."""
    with writing(uri) as out:
        blocks, held, size = [], [], 0

        def flush(final: bool) -> None:
            nonlocal held, size
            ids = np.concatenate(held) if held else np.zeros(0, np.uint32)
            while len(ids) >= BLOCK_TOKENS or (final and len(ids)):
                blocks.append([out.tell(), min(len(ids), BLOCK_TOKENS)])
                out.write(encode_block(ids[:BLOCK_TOKENS], table))
                ids = ids[BLOCK_TOKENS:]
            held, size = [ids], len(ids)

        for piece in pieces:
            held.append(piece)
            size += len(piece)
            if size >= BLOCK_TOKENS:
                flush(False)
        flush(True)
        footer = zlib.compress(json.dumps({"blocks": blocks, "doc_ids": doc_ids, "lengths": lengths}).encode())
        out.write(footer + struct.pack("<I", len(footer)) + MAGIC)


class TokenFile:
    """Random access to a written file."""

    def __init__(self, uri: str, table: FrequencyTable):
        self.file, self.table = reading(uri), table
        end = self.file.size()
        self.file.seek(end - 12)
        length, magic = struct.unpack("<I8s", self.file.read(12))
        if magic != MAGIC:
            raise ValueError(f"{uri} is not a token file")
        self.file.seek(end - 12 - length)
        footer = json.loads(zlib.decompress(self.file.read(length)))
        self.blocks, self.doc_ids, self.lengths = footer["blocks"], footer["doc_ids"], footer["lengths"]

    def block(self, index: int, first: int = 0, count: int | None = None) -> np.ndarray:
        self.file.seek(self.blocks[index][0])
        header = self.file.read(HEADER.size)
        return decode_block(header, self.file.read(body_size(header)), self.table, first, count)

    def ids(self, first: int, count: int) -> np.ndarray:
        """``count`` ids from the file's id number ``first`` on."""
        found, at = [np.zeros(0, np.uint32)], 0
        for index, (_, size) in enumerate(self.blocks):
            if at + size > first and at < first + count:
                begin = max(0, first - at)
                found.append(self.block(index, begin, min(at + size, first + count) - at - begin))
            at += size
        return np.concatenate(found)

    def documents(self) -> Iterator[tuple[int | None, np.ndarray]]:
        """All documents in order, one block in memory at a time."""
        held, index = np.zeros(0, np.uint32), 0
        for doc_id, length in zip(self.doc_ids, self.lengths):
            parts = [held]
            have = len(held)
            while have < length:
                parts.append(self.block(index))
                have += len(parts[-1])
                index += 1
            held = np.concatenate(parts) if len(parts) > 1 else held
            yield doc_id, held[:length]
            held = held[length:]


def _spread(files: DataFrame) -> DataFrame:
    """One file per task."""
    return files.repartition(max(1, files.count()))


def summed_counts(parts: DataFrame, end_id: int) -> np.ndarray:
    """Counts of all ids: ``COUNT_TASKS`` tasks add up what they read, the driver adds their sums (one number per id each)."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(0, np.int64)
        for batch in batches:
            for packed in batch.column(0).to_pylist():
                part = np.frombuffer(zlib.decompress(packed), np.int64)
                total = part + total if len(total) else part
        if len(total):
            yield pa.RecordBatch.from_pydict({"counts": [zlib.compress(total.tobytes(), 1)]}, schema=pa.schema([("counts", pa.binary())]))

    sums = [np.frombuffer(zlib.decompress(r.counts), np.int64) for r in parts.repartition(COUNT_TASKS).mapInArrow(add, "counts BINARY").collect()]
    return sum(sums, np.zeros(max([end_id + 1, *map(len, sums)]), np.int64))


def write_ids(docs: DataFrame, folder: str, tokenizer: str | None = None, end_id: int = END_ID) -> tuple[DataFrame, FrequencyTable]:
    """Tokenise ``docs`` and write them to files below ``folder`` in ascending ``doc_id``.

    Returns the files (one row each, a written table) and the shared frequency table.
    Every partition of the sorted documents first goes to one plain id file with its
    token counts; once all counts are summed (one row per id of the vocabulary), each
    plain file is coded to its final one.
    """
    spark, file = docs.sparkSession, tokenizer or tokenizer_file("byte_bpe_50k.json")

    def tokenise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, encoder = TaskContext.get().partitionId(), byte_batch(file)
        vocabulary = max(encoder.vocabulary, end_id + 1)
        counts, doc_ids, lengths = np.zeros(vocabulary, np.int64), [], []
        uri = f"{folder}/plain/{part:06d}.ids"
        with writing(uri) as raw, pa.CompressedOutputStream(raw, "zstd") as out:
            for batch in batches:
                for some in slices(batch, 1):
                    ids, sizes = encoder.documents(some.column(1), end_id)
                    counts += np.bincount(ids, minlength=vocabulary)
                    out.write(ids.astype("<u2" if vocabulary <= 1 << 16 else "<u4").tobytes())
                    doc_ids.extend(some.column(0).to_pylist())
                    lengths.extend(sizes.tolist())
        if doc_ids:
            yield pa.RecordBatch.from_pydict(
                {"part": [part], "uri": [uri], "n_docs": [len(doc_ids)], "n_tokens": [sum(lengths)], "counts": [zlib.compress(counts.tobytes(), 1)], "doc_ids": [doc_ids], "lengths": [lengths]},
                schema=pa.schema([("part", pa.int64()), ("uri", pa.string()), ("n_docs", pa.int64()), ("n_tokens", pa.int64()), ("counts", pa.binary()), ("doc_ids", pa.list_(pa.int64())), ("lengths", pa.list_(pa.int64()))]),
            )

    row = "__row"
    ordered = (
        docs.select("doc_id", text_of().alias("text"), F.monotonically_increasing_id().alias(row))
        .repartitionByRange("doc_id", row)
        .sortWithinPartitions("doc_id", row)
        .select("doc_id", "text")
    )
    plain = staged(ordered.mapInArrow(tokenise, f"{FILES}, counts BINARY, doc_ids ARRAY<BIGINT>, lengths ARRAY<BIGINT>"), "plain-ids")
    counts = summed_counts(plain.select("counts"), end_id)
    shared = FrequencyTable.of_counts(counts)
    frequencies = shared.frequency.astype(np.int64)
    wide = tokenizer_width(file, end_id)

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = FrequencyTable(frequencies)
        for batch in batches:
            for r in batch.to_pylist():

                def pieces(uri: str = r["uri"]) -> Iterator[np.ndarray]:
                    with pa.CompressedInputStream(reading(uri), "zstd") as stream:
                        rest = b""
                        while data := stream.read(BLOCK_TOKENS * wide):
                            data = rest + data
                            whole = len(data) // wide * wide
                            rest = data[whole:]
                            yield np.frombuffer(data[:whole], f"<u{wide}").astype(np.uint32)

                uri = f"{folder}/{r['part']:06d}.rans"
                write_file(uri, pieces(), r["doc_ids"], r["lengths"], table)
                yield pa.RecordBatch.from_pydict({"part": [r["part"]], "uri": [uri], "n_docs": [r["n_docs"]], "n_tokens": [r["n_tokens"]]})

    written = _spread(plain.drop("counts")).mapInArrow(code, FILES)
    return staged(written, "token-files"), shared


def tokenizer_width(file: str, end_id: int = END_ID) -> int:
    """Bytes of an id in the plain files."""
    return 2 if max(byte_batch(file).vocabulary, end_id + 1) <= 1 << 16 else 4


def read_documents(files: DataFrame, table: FrequencyTable) -> DataFrame:
    """Per document, from the files alone: ``doc_id, start, n_tokens, ids_crc32``."""
    before = F.sum("n_tokens").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    placed = staged(files.select("uri", F.coalesce(before, F.lit(0)).cast("bigint").alias("first")), "token-file-starts")  # a row per file
    frequencies = table.frequency.astype(np.int64)

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shared = FrequencyTable(frequencies)
        for batch in batches:
            for uri, start in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                rows = []
                for doc_id, ids in TokenFile(uri, shared).documents():
                    rows.append((doc_id, start, len(ids), zlib.crc32(ids.astype("<u4").tobytes())))
                    start += len(ids)
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows)], ["doc_id", "start", "n_tokens", "ids_crc32"])

    return _spread(placed).mapInArrow(decode, "doc_id BIGINT, start BIGINT, n_tokens BIGINT, ids_crc32 BIGINT")


def round_trip(spark: SparkSession, docs: DataFrame, tokenizer: str | None = None, end_id: int = END_ID) -> DataFrame:
    files, table = write_ids(docs, shared_uri(spark, "token-files"), tokenizer, end_id)
    return read_documents(files, table)
