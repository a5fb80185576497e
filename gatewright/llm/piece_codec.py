"""SentencePiece encoding (merge type) by a prefix table, and decoding.

For every prefix of a piece of text the last token of its encoding is unique.
The table of these tokens is filled from left to right: an automaton of the
vocabulary names all tokens that end at a place, and a token is the right one
if the pair of it and the last token before it stays a pair when the two are
merged on their own. The ids are then read backwards through the table. Time is
linear in the length, whatever the text, and equals the merging of the library.

Texts are cut where no token of the vocabulary can cross (between two
characters that stand side by side in no token), so a bounded cache of words
serves most of a text. Decoding is the library's.

Defined cases: null and empty texts have no ids; white space, the word mark
itself and characters outside the vocabulary (their UTF-8 bytes become byte
tokens) are encoded as the library does. Repeated rows and ids are kept as rows.
Long texts take linear time. An empty table gives no rows; further columns are
ignored.
"""

from __future__ import annotations

import functools
import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from gatewright.llm.common import text_of, tokenizer_file

MARK = "▁"
RUNS = re.compile(f"{MARK}+[^{MARK}]*|[^{MARK}]+")
LONG_UNIT = 64


class PieceCodec:
    def __init__(self, file: str, cache_units: int = 400_000):
        import ahocorasick
        import sentencepiece

        self.library = sentencepiece.SentencePieceProcessor(model_file=file)
        lib, size = self.library, self.library.get_piece_size()
        special = {i for i in range(size) if lib.is_control(i) or lib.is_unknown(i) or lib.is_byte(i) or lib.is_unused(i)}
        self.pieces = {lib.id_to_piece(i): i for i in range(size) if i not in special}
        self.score = {p: lib.get_score(i) for p, i in self.pieces.items()}
        self.bytes = [lib.piece_to_id(f"<0x{b:02X}>") for b in range(256)]
        self.name = {i: p for p, i in self.pieces.items()}
        self.neighbours = {p[k : k + 2] for p in self.pieces for k in range(len(p) - 1)}
        self.characters = {c for pair in self.neighbours for c in pair} | {p for p in self.pieces if len(p) == 1}
        self.automaton = ahocorasick.Automaton()
        for piece, i in self.pieces.items():
            self.automaton.add_word(piece, (len(piece), i))
        for char in self.characters - self.pieces.keys():
            self.automaton.add_word(char, (1, -ord(char)))  # only ever a part of tokens
            self.name[-ord(char)] = char
        self.automaton.make_automaton()
        self.compatible: dict[tuple[int, int], bool] = {}
        self.cache_units = cache_units
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}

    def merged(self, text: str) -> list[str]:
        """The merge rule itself: join the neighbours whose token scores best, the leftmost of equals. For short texts."""
        parts = list(text)
        while True:
            best, at = None, -1
            for k in range(len(parts) - 1):
                score = self.score.get(parts[k] + parts[k + 1])
                if score is not None and (best is None or score > best):
                    best, at = score, k
            if best is None:
                return parts
            parts[at : at + 2] = [parts[at] + parts[at + 1]]

    def stays_pair(self, left: int, right: int) -> bool:
        """Whether ``left`` followed by ``right`` encodes to just these two (``left`` 0: whether ``right`` alone stays)."""
        known = self.compatible.get((left, right))
        if known is None:
            pair = [self.name[left], self.name[right]] if left else [self.name[right]]
            known = self.merged("".join(pair)) == pair
            if len(self.compatible) >= self.cache_units:
                self.compatible.clear()
            self.compatible[left, right] = known
        return known

    def prefix_table(self, text: str) -> tuple[list[int], list[int]]:
        """Last token of every prefix, and its length. All characters of ``text`` occur in the vocabulary."""
        last, length = [0] * (len(text) + 1), [0] * (len(text) + 1)
        known, compatible = self.compatible.get, self.stays_pair
        for end, (size, token) in self.automaton.iter(text):
            end += 1
            if not length[end]:
                before = last[end - size]
                fits = known((before, token))
                if fits or fits is None and compatible(before, token):
                    last[end], length[end] = token, size
        return last, length

    def _word(self, text: str) -> bytes:
        if len(text) == 1 and text not in self.characters:
            return np.array([self.bytes[b] for b in text.encode()], "<u4").tobytes()
        last, length = self.prefix_table(text)
        ids, at = [], len(text)
        while at:
            token = last[at]
            ids.extend([token] if token >= 0 else [self.bytes[b] for b in reversed(chr(-token).encode())])
            at -= length[at]
        return np.array(ids[::-1], "<u4").tobytes()

    def _words(self, unit: str) -> Iterator[str]:
        """``unit`` cut where no token crosses."""
        start = 0
        for k in range(1, len(unit)):
            if unit[k - 1 : k + 1] not in self.neighbours:
                yield unit[start:k]
                start = k
        yield unit[start:]

    def _keep(self, key: str, value: bytes) -> bytes:
        if len(key) <= LONG_UNIT:
            if len(self.young) >= self.cache_units:
                self.old, self.young = self.young, {}
            self.young[key] = value
        return value

    def _unit(self, unit: str) -> bytes:
        value = self.young.get(unit)
        if value is None:
            value = self.old.get(unit)
            if value is None:
                words = list(self._words(unit)) if len(unit) > 1 else [unit]
                value = self._word(unit) if len(words) == 1 else b"".join(self._unit(w) for w in words)
            self._keep(unit, value)
        return value

    def ids(self, text: str) -> np.ndarray:
        if not text:
            return np.zeros(0, "<u4")
        marked = MARK + text.replace(" ", MARK)
        if MARK + MARK in marked or "\0" in marked:
            units = RUNS.findall(marked)
        else:
            units = marked.replace("\n", "\0\n\0").replace(MARK, "\0" + MARK).split("\0")
            units = units if "" not in units else list(filter(None, units))
        values = list(map(self.young.get, units))
        if None in values:
            values = [self._unit(u) if v is None else v for u, v in zip(units, values)]
        return np.frombuffer(b"".join(values), "<u4")

    def decode(self, ids: list[int]) -> str:
        return self.library.decode(ids)


@functools.lru_cache(maxsize=4)
def piece_codec(file: str) -> PieceCodec:
    """One instance per file and Python worker."""
    return PieceCodec(file)


def encode_pieces(docs: DataFrame, model: str | None = None) -> DataFrame:
    """``doc_id, ids, decoded`` of every row."""
    file = model or tokenizer_file("piece_bpe_32k.model")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = piece_codec(file)
        for batch in batches:
            ids = [codec.ids(t).tolist() for t in batch.column(1).to_pylist()]
            decoded = [codec.decode(i) if i else "" for i in ids]
            columns = [batch.column(0), pa.array(ids, pa.list_(pa.int32())), pa.array(decoded, pa.string())]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "ids", "decoded"])

    return docs.select("doc_id", text_of().alias("text")).mapInArrow(run, "doc_id BIGINT, ids ARRAY<INT>, decoded STRING")


def piece_digests(docs: DataFrame, model: str | None = None) -> DataFrame:
    """``doc_id, n_tokens, ids_sha256, decoded_sha256``: the digests of :func:`encode_pieces`, made where the ids are."""
    file = model or tokenizer_file("piece_bpe_32k.model")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = piece_codec(file)
        decimal = [str(i) for i in range(codec.library.get_piece_size())].__getitem__
        for batch in batches:
            rows = []
            for text in batch.column(1).to_pylist():
                ids = codec.ids(text).tolist()
                joined = ",".join(map(decimal, ids))
                decoded = codec.decode(ids) if ids else ""
                rows.append((len(ids), hashlib.sha256(joined.encode()).hexdigest(), hashlib.sha256(decoded.encode()).hexdigest()))
            counts, first, second = zip(*rows) if rows else ((), (), ())
            columns = [batch.column(0), pa.array(counts, pa.int64()), pa.array(first, pa.string()), pa.array(second, pa.string())]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    schema = "doc_id BIGINT, n_tokens BIGINT, ids_sha256 STRING, decoded_sha256 STRING"
    return docs.select("doc_id", text_of().alias("text")).mapInArrow(run, schema)
