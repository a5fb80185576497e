"""Ids of many texts at once by a byte-level BPE file: every distinct unit of a batch is encoded once.

The file's pre-tokenizer never joins what stands before a blank with what follows
it, so a text may be cut in front of any blank, and on both sides of any line feed,
that has a non-blank on either side: the ids of the units, one after the other, are
the ids of the text. The file's special strings, such as ``<|endoftext|>``, have
their own ids wherever they stand in a text, as the library has it. Cutting, and
finding the distinct units of a batch, is Arrow's work; the distinct units are
encoded together and their ids are gathered by unit. Nothing is kept between batches, so
memory is bounded by the batch: callers slice texts with :func:`slices`.

Units of plain characters go, one per line, through one call of a BPE encoder
that uses the file's own merges; units with other white space, special strings or
characters beyond ``PLAIN`` go through the file's library, as does everything of
a file whose merges are not in the order of its ids.
"""

from __future__ import annotations

import functools
import json
import os
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

CUT = re.compile(r"(?<=\S)(?=[ \n]\S)|(?<=\S\n)(?=\S)")
#: White space other than blank and line feed, and the mark used for cutting.
OTHER_SPACE = [chr(c) for c in range(0x10000) if chr(c).isspace() and chr(c) not in " \n"] + ["\0", "\u180e"]
#: A unit of printable characters of the Latin blocks, perhaps after one blank.
PLAIN = "^ ?[!-~¡-¬®-ɏ]+$"
#: White space that makes a text be cut by :data:`CUT` instead of at every blank and line feed.
BESIDE = "  |\n | \n|\n\n|^[ \n]|[ \n]$|[" + "".join(re.escape(c) if c.isprintable() else f"\\x{{{ord(c):x}}}" for c in OTHER_SPACE) + "]"
SLICE_BYTES = 2 << 20
LIBRARY_CHARACTERS = 1 << 17
TEXT = functools.partial(pa.scalar, type=pa.large_string())
#: The pre-tokenizer of byte-level files.
WORDS = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


def bytes_of_letters() -> dict[str, int]:
    """The byte that each letter of a byte-level vocabulary stands for."""
    printable = {*range(33, 127), *range(161, 173), *range(174, 256)}  # stand for themselves, the others for the characters from 256 on
    others = [b for b in range(256) if b not in printable]
    return {chr(b) if b in printable else chr(256 + others.index(b)): b for b in range(256)}


def slices(batch: pa.RecordBatch, column: int, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """``batch`` in runs of rows whose texts have about ``limit`` bytes together; a longer text is a run of its own."""
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    ends = np.cumsum(sizes)
    start = 0
    while start < len(ends):
        before = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, before + limit, "right")))
        yield batch.slice(start, stop - start)
        start = stop


def ragged(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The positions ``starts[k] .. starts[k] + lengths[k] - 1`` of all runs, one after the other."""
    ends = np.cumsum(lengths)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(starts - (ends - lengths), lengths)


def sums_by_run(values: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Sum of ``values`` over consecutive runs of the given lengths, empty ones included."""
    total = np.concatenate([[0], np.cumsum(values)])
    ends = np.cumsum(lengths)
    return total[ends] - total[ends - lengths]


def cut_units(texts: pa.Array, lead: str = "", whole: np.ndarray | None = None) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """Distinct units of ``texts`` (no nulls), the unit at every place, and how many places each text has.

    ``lead`` is put in front of every text. Texts marked in ``whole`` are one unit.
    """
    texts = texts.cast(pa.large_string())
    beside = pc.match_substring_regex(texts, BESIDE).to_numpy(zero_copy_only=False)
    odd = beside if whole is None else beside | whole
    clean = texts.filter(pa.array(~odd))
    marked = pc.replace_substring(pc.replace_substring(clean, " ", "\0 "), "\n", "\0\n\0")
    if lead:
        marked = pc.binary_join_element_wise(TEXT(lead), marked, TEXT(""))
    parts = pc.split_pattern(marked, "\0")
    counts = np.zeros(len(texts), np.int64)
    counts[~odd] = pc.list_value_length(parts).to_numpy(zero_copy_only=False)
    rows = np.flatnonzero(odd)
    rest: list[str] = []
    for k in rows.tolist():
        text = lead + texts[k].as_py()
        units = [text] if whole is not None and whole[k] else CUT.split(text)
        counts[k] = len(units)
        rest.extend(units)
    coded = pa.chunked_array([parts.flatten(), pa.array(rest, pa.large_string())]).combine_chunks().dictionary_encode()
    at = coded.indices.to_numpy(zero_copy_only=False)
    if len(rows):
        # Clean texts come first in ``at``, the others after them: bring the runs into the order of the texts.
        order = np.concatenate([np.flatnonzero(~odd), rows])
        first = np.zeros(len(texts), np.int64)
        first[order] = np.cumsum(counts[order]) - counts[order]
        at = at[ragged(first, counts)]
    return coded.dictionary, at, counts


class ByteBatch:
    """Encodes texts in batches. ``special_as_text`` reads the file's special strings as plain text."""

    def __init__(self, file: str, special_as_text: bool = False):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(file)
        self.tokenizer.encode_special_tokens = special_as_text
        added = [] if special_as_text else list(self.tokenizer.get_added_tokens_decoder().values())
        self.special = [t.content for t in added]
        self.uncut = [t.content for t in added if t.lstrip or t.rstrip or t.single_word or t.normalized or any(c.isspace() or c == "\0" for c in t.content)]
        self.vocabulary = self.tokenizer.get_vocab_size()
        self.plain = self._plain_encoder(file)

    @staticmethod
    def _plain_encoder(file: str):
        """An encoder by the file's merges, if its ids are in their order and nothing but the usual pre-tokenizer comes before them."""
        with open(file, encoding="utf-8") as f:
            said = json.load(f)
        model, before = said["model"], said["pre_tokenizer"] or {}
        byte_of = bytes_of_letters()
        vocab = model["vocab"]
        merged = [vocab.get(m.replace(" ", "") if isinstance(m, str) else "".join(m)) for m in model.get("merges", ())]
        usual = (
            model.get("type") == "BPE" and said["normalizer"] is None and said["post_processor"] is None
            and before.get("type") == "ByteLevel" and before.get("use_regex") and not before.get("add_prefix_space")
            and not model.get("dropout") and not model.get("ignore_merges") and all(c in byte_of for t in vocab for c in t)
            and None not in merged and merged == sorted(merged) and len(set(merged)) == len(merged) == len(vocab) - 256
        )
        if not usual:
            return None
        import tiktoken

        ranks = {bytes(byte_of[c] for c in t): i for t, i in vocab.items()}
        return tiktoken.Encoding("file", pat_str=WORDS, mergeable_ranks=ranks, special_tokens={})

    def token_bytes(self) -> list[bytes]:
        """The bytes of every id; special strings stand for themselves."""
        byte_of, out = bytes_of_letters(), [b""] * self.vocabulary
        for token, i in self.tokenizer.get_vocab(with_added_tokens=False).items():
            out[i] = bytes(byte_of[c] for c in token)
        for i, t in self.tokenizer.get_added_tokens_decoder().items():
            out[i] = t.content.encode()
        return out

    def units(self, units: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of distinct units one after the other, and how many each has."""
        plain = np.zeros(len(units), bool)
        if self.plain is not None:
            plain = pc.match_substring_regex(units, PLAIN).to_numpy(zero_copy_only=False).copy()
            for s in self.special:
                plain &= ~pc.match_substring(units, s).to_numpy(zero_copy_only=False)
        lines = pc.binary_join_element_wise(units.filter(pa.array(plain)), TEXT("\n"), TEXT(""))
        first, first_counts = np.zeros(0, np.uint32), np.zeros(0, np.int64)
        if len(lines):
            text = pc.binary_join(pa.LargeListArray.from_arrays(pa.array([0, len(lines)], pa.int64()), lines), TEXT(""))[0].as_py()
            ids = np.array(self.plain.encode_ordinary(text), np.uint32)
            ends = np.flatnonzero(ids == self.plain.encode_single_token("\n"))
            if len(ends) != len(lines):
                raise AssertionError("a line feed was joined with a plain unit")
            first_counts = np.diff(ends, prepend=-1) - 1
            first = np.delete(ids, ends)
        if plain.all():
            return first, first_counts
        odd = list(self._library(units.filter(pa.array(~plain)).to_pylist()))
        counts = np.zeros(len(units), np.int64)
        counts[plain], counts[~plain] = first_counts, [len(i) for i in odd]
        starts = np.zeros(len(units), np.int64)
        both = np.concatenate([first, *odd])
        order = np.concatenate([np.flatnonzero(plain), np.flatnonzero(~plain)])
        starts[order] = np.cumsum(counts[order]) - counts[order]
        return both[ragged(starts, counts)], counts

    def _library(self, units: list[str]) -> Iterator[np.ndarray]:
        """Ids of units by the file's library, a few at a time: what it returns is many times as large as its ids."""
        some, size = [], 0
        for k, unit in enumerate(units):
            some.append(unit)
            size += len(unit)
            if size >= LIBRARY_CHARACTERS or k == len(units) - 1:
                for found in self.tokenizer.encode_batch(some, add_special_tokens=False):
                    yield np.array(found.ids, np.uint32)
                some, size = [], 0

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids (unsigned 32-bit) of all texts one after the other, and how many each text has."""
        whole = None
        for s in self.uncut:
            found = pc.match_substring(texts, s).to_numpy(zero_copy_only=False)
            whole = found if whole is None else whole | found
        units, at, places = cut_units(texts, whole=whole)
        ids, counts = self.units(units)
        starts = np.cumsum(counts) - counts
        return ids[ragged(starts[at], counts[at])], sums_by_run(counts[at], places)


    def documents(self, texts: pa.Array, end_id: int) -> tuple[np.ndarray, np.ndarray]:
        """:meth:`encode` with an end id after every text's ids."""
        ids, counts = self.encode(texts)
        return np.insert(ids, np.cumsum(counts), end_id).astype("<u4"), counts + 1


@functools.lru_cache(maxsize=2)
def byte_batch(file: str, special_as_text: bool = False) -> ByteBatch:
    """One instance per file and Python worker."""
    return ByteBatch(file, special_as_text)
