"""Personal data found by fixed patterns and by a semi-Markov conditional random field.

The base patterns (``pii_spans``) miss what is written a little differently:
``ann (at) host [dot] org``, ``0049 170 ...``, a card number in dots. A
semi-Markov field adds such spans. Its segments are whole candidate spans, so
their features look at the span at once: digits, group sizes, check digit,
separators, neighbours. Dynamic programming over the atoms of a window, with
entities of at most ``MAX_ATOMS`` atoms, chooses boundaries and types together.

It learns from the base spans of a bounded sample of windows and from the same
windows with their spans rewritten in such other ways (:func:`rewritten`) or
spoiled, so that they are none any more (:func:`spoiled`). Windows are runs of
words that hold a digit or an at sign, and the neighbours of a bracketed "at" or
"dot"; elsewhere no candidate is possible, so scoring windows alone is exact.

Added spans are called ``crf_email`` and so on; one that overlaps a base span is
left out. A null text is an empty one and has none; rows with equal or null ids
are judged one by one; a sample without any base span adds nothing. Texts of any
length are read whole. Of equally good segmentations the first one found counts. An
empty table gives no rows; further columns are ignored, and kept by
:func:`mask_documents`.
"""

from __future__ import annotations

import hashlib
import math
import re
import zlib
from collections import defaultdict
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gatewright.llm.common import hash_sample, text_of
from gatewright.llm.pii_spans import KINDS, base_spans, luhn, small_number

TRAIN_WINDOWS = 400
TRAIN_DOCUMENTS = 4000
EPOCHS = 5
RATE = 0.3
DECAY = 1e-4
MAX_ATOMS = 24
MAX_WINDOW = 400
OUTSIDE = "outside"

BLANK = " \t"
ANCHOR = re.compile(r"[0-9@]|[\[({](?:at|dot)[\])}]", re.IGNORECASE)
WORD_AFTER = re.compile(r"[ \t]*+[^ \t\r\n]+")
EDGE = re.compile(r"[ \t\r\n]|$")
ATOM = re.compile(r"[\[({](?:at|dot)[\])}]|\[\.\]|[A-Za-z]+|[0-9]+|[ \t]+|.", re.IGNORECASE | re.DOTALL)
AT = frozenset({"@", "[at]", "(at)", "{at}"})
DOT = frozenset({".", "[.]", "[dot]", "(dot)", "{dot}"})
NUMBER_MARKS = frozenset(" ().-/")
NAME_MARKS = frozenset("._%+-")


def windows(text: str) -> Iterator[tuple[int, int]]:
    """Runs of words on one line that hold an anchor, joined across blanks and words of marks only."""
    begin = end = -1
    at, anchor = 0, ANCHOR.search(text)
    while anchor:
        place = anchor.start()
        start = max(text.rfind(c, at, place) for c in " \t\r\n") + 1 or at
        stop = EDGE.search(text, place).start()
        if text[place] in "[({":
            before = text[at:start].rstrip(BLANK)
            start = max(before.rfind(c) for c in " \t\r\n") + 1 + at
            after = WORD_AFTER.match(text, stop)
            stop = after.end() if after else stop
        if begin >= 0 and not text[end:start].strip(" \t().-/[]"):
            end = stop
        else:
            if begin >= 0:
                yield begin, end
            begin, end = start, stop
        at = stop
        anchor = ANCHOR.search(text, stop)
    if begin >= 0:
        yield begin, end


def worth_a_look(window: str) -> bool:
    """Whether any candidate can lie in a window."""
    if "@" in window or "at" in window.lower():
        return True
    return sum(map(str.isdigit, window)) >= 4


def size_class(n: int) -> str:
    return str(n) if n < 8 else f"{n.bit_length()}b"


def side(char: str) -> str:
    if not char:
        return "none"
    return "blank" if char.isspace() else "digit" if char.isdigit() else "letter" if char.isalpha() else "mark"


def candidates(window: str, before: str = "", after: str = "") -> tuple[list[tuple[int, int]], dict[int, list[tuple[int, str, list[str]]]]]:
    """Atoms of a window, and per atom the segments that end with it: first atom, kind, features of the whole span."""
    atoms = [m.span() for m in ATOM.finditer(window)]
    words = [window[a:b].lower() for a, b in atoms]
    ending: dict[int, list[tuple[int, str, list[str]]]] = defaultdict(list)
    for i, first in enumerate(words):
        if not (first.isalnum() or first in ("+", "(")) or not first.isascii():
            continue
        digits, parts, marks, ats, dots_after, numeric, named = 0, [], [], 0, 0, True, True
        for j in range(i, min(len(words), i + MAX_ATOMS)):
            word = words[j]
            if word.isdigit() and word.isascii():
                digits += len(word)
                parts.append(word)
            elif word in AT:
                ats, numeric = ats + 1, False
                marks.append(word)
            elif word in DOT:
                dots_after += ats > 0
                marks.append(word)
            elif word.isalpha() and word.isascii():
                numeric = False
            else:
                blank = word.strip(BLANK) == ""
                plus = word == "+" and j == i
                numeric = numeric and (blank or plus or word in NUMBER_MARKS) and len(word) == 1
                named = named and (blank and any(m in marks for m in AT | DOT - {"."}) or blank and j + 1 < len(words) and words[j + 1] in AT - {"@"} or word in NAME_MARKS)
                marks.append(word)
            if not (numeric or named) or ats > 1 or digits > 19 and numeric:
                break
            if not (word.isalnum() and word.isascii()):
                continue
            left = side(window[atoms[i][0] - 1] if i else before)
            right = side(window[atoms[j][1]] if j + 1 < len(words) else after)
            common = [f"left {left}", f"right {right}", f"sides {left} {right}", f"atoms {size_class(j - i + 1)}"]
            if named and ats and dots_after:
                ending[j].append((i, "email", [*common, f"last {size_class(len(word))} {word.isalpha()}", f"dots {size_class(dots_after)}", f"first {first.isalnum()}"]))
            if numeric and parts:
                separators = "".join(sorted(set(marks)))
                lead = "plus" if first == "+" else "00" if first.startswith("00") else "paren" if first == "(" else "digit"
                if len(parts) == 4 and len(marks) == 3 and set(marks) <= DOT:
                    fine = all(map(small_number, parts))
                    ending[j].append((i, "ip", [*common, f"fine {fine}", f"longest {max(map(len, parts))}"]))
                shape = [*common, f"digits {digits}", f"lead {lead}", f"lead {lead} digits {digits}", f"groups {size_class(len(parts))}", f"several {len(set(marks)) > 2}"]
                if 12 <= digits <= 19 and first != "+" and "(" not in separators:
                    ending[j].append((i, "card", [*shape, f"check {luhn(''.join(parts))}"]))
                if 7 <= digits <= 15:
                    ending[j].append((i, "phone", [*shape, f"check {luhn(''.join(parts))}" if digits >= 12 else "check none"]))
    return atoms, ending


class SemiMarkovField:
    """Weights of (kind, feature) and of (kind before, kind). A segment outside is one atom long and scores its transition only."""

    def __init__(self, weights: dict[tuple[str, str], float] | None = None):
        self.weights = weights or {}

    def _score(self, kind: str, features: list[str]) -> float:
        get = self.weights.get
        return get((kind, "bias"), 0.0) + sum(get((kind, f), 0.0) for f in features)

    def _step(self, before: str, kind: str) -> float:
        return self.weights.get((kind, f"after {before}"), 0.0) if kind != OUTSIDE else 0.0

    def best(self, window: str, before: str = "", after: str = "") -> list[tuple[int, int, str]]:
        """The best segmentation's entities, as places in the window."""
        atoms, ending = candidates(window, before, after)
        if not ending:
            return []
        best: list[dict[str, tuple[float, int, str]]] = [{OUTSIDE: (0.0, 0, OUTSIDE)}]
        for end in range(len(atoms)):
            here: dict[str, tuple[float, int, str]] = {}
            value, previous = max((v[0], k) for k, v in best[end].items())
            here[OUTSIDE] = (value, end, previous)
            for start, kind, features in ending.get(end, ()):
                own = self._score(kind, features)
                for previous, (value, _, _) in best[start].items():
                    total = value + own + self._step(previous, kind)
                    if kind not in here or total > here[kind][0]:
                        here[kind] = (total, start, previous)
            best.append(here)
        place, kind, found = len(atoms), max(best[-1], key=lambda k: best[-1][k][0]), []
        while place:
            _, start, previous = best[place][kind]
            if kind != OUTSIDE:
                found.append((atoms[start][0], atoms[place - 1][1], kind))
            place, kind = start, previous
        return found[::-1]

    def _expectations(self, atoms, ending) -> dict[tuple[str, str], float]:
        """Expected feature counts under the field, by forward and backward sums over all segmentations."""
        n, kinds = len(atoms), (OUTSIDE, *KINDS)

        def add(x: float, y: float) -> float:
            if x < y:
                x, y = y, x
            return x if y == -math.inf else x + math.log1p(math.exp(y - x))

        own = {(end, k): self._score(kind, features) for end, found in ending.items() for k, (_, kind, features) in enumerate(found)}
        forward = [dict.fromkeys(kinds, -math.inf) for _ in range(n + 1)]
        backward = [dict.fromkeys(kinds, -math.inf) for _ in range(n + 1)]
        forward[0][OUTSIDE] = 0.0
        for end in range(n):
            for value in forward[end].values():
                forward[end + 1][OUTSIDE] = add(forward[end + 1][OUTSIDE], value)
            for k, (start, kind, _) in enumerate(ending.get(end, ())):
                for previous, value in forward[start].items():
                    if value > -math.inf:
                        forward[end + 1][kind] = add(forward[end + 1][kind], value + own[end, k] + self._step(previous, kind))
        backward[n] = dict.fromkeys(kinds, 0.0)
        total = -math.inf
        for value in forward[n].values():
            total = add(total, value)
        expected: dict[tuple[str, str], float] = defaultdict(float)
        for end in range(n - 1, -1, -1):
            for previous in kinds:
                backward[end][previous] = add(backward[end][previous], backward[end + 1][OUTSIDE])
            for k, (start, kind, features) in enumerate(ending.get(end, ())):
                inner = own[end, k] + backward[end + 1][kind]
                mass = 0.0
                for previous in kinds:
                    step = inner + self._step(previous, kind)
                    backward[start][previous] = add(backward[start][previous], step)
                    if forward[start][previous] > -math.inf:
                        p = math.exp(forward[start][previous] + step - total)
                        expected[kind, f"after {previous}"] += p
                        mass += p
                expected[kind, "bias"] += mass
                for f in features:
                    expected[kind, f] += mass
        return expected

    def fit(self, examples: list[tuple[str, list[tuple[int, int, str]]]], epochs: int = EPOCHS) -> SemiMarkovField:
        """Maximise the conditional likelihood of the examples' segmentations by adaptive gradient steps."""
        prepared = []
        for window, spans in examples:
            atoms, ending = candidates(window)
            starts, ends = {a: k for k, (a, _) in enumerate(atoms)}, {b: k for k, (_, b) in enumerate(atoms)}
            gold: dict[tuple[str, str], float] = defaultdict(float)
            previous_end, previous, known = 0, OUTSIDE, True
            for a, b, kind in spans:
                segment = next((s for s in ending.get(ends.get(b, -1), ()) if s[0] == starts.get(a) and s[1] == kind), None)
                if segment is None:
                    known = False
                    break
                gold[kind, "after " + (previous if previous_end == a else OUTSIDE)] += 1
                for f in ["bias", *segment[2]]:
                    gold[kind, f] += 1
                previous_end, previous = b, kind
            if known and ending:
                prepared.append((atoms, ending, gold))
        squares: dict[tuple[str, str], float] = defaultdict(lambda: 1e-6)
        for _ in range(epochs):
            for atoms, ending, gold in prepared:
                expected = self._expectations(atoms, ending)
                for key in expected.keys() | gold.keys():
                    gradient = gold.get(key, 0.0) - expected.get(key, 0.0) - DECAY * self.weights.get(key, 0.0)
                    if abs(gradient) > 1e-9:
                        squares[key] += gradient * gradient
                        self.weights[key] = self.weights.get(key, 0.0) + RATE * gradient / math.sqrt(squares[key])
        return self


def rewritten(window: str, spans: list[tuple[int, int, str]]) -> tuple[str, list[tuple[int, int, str]]]:
    """The window with every span written in another usual way, chosen by a checksum, and the new places."""
    out, places, done = "", [], 0
    for a, b, kind in spans:
        span, pick = window[a:b], zlib.crc32(window[a:b].encode())
        if kind == "email":
            name, _, host = span.partition("@")
            at = ["[at]", "(at)", " (at) ", " [at] "][pick % 4]
            span = name + at + (host.replace(".", ["[dot]", "(dot)"][pick // 8 % 2]) if pick // 4 % 2 else host)
        elif kind == "ip":
            span = span.replace(".", ["[.]", "(dot)"][pick % 2])
        elif kind == "phone":
            span = "00" + span[1:]
        else:
            digits = span.replace(" ", "").replace("-", "")
            span = [".", "/"][pick % 2].join(digits[k : k + 4] for k in range(0, len(digits), 4))
        out += window[done:a]
        places.append((len(out), len(out) + len(span), kind))
        out, done = out + span, b
    return out + window[done:], places


def spoiled(window: str, spans: list[tuple[int, int, str]]) -> str:
    """The window with every span changed so that it is no personal data."""
    out, done = "", 0
    for a, b, kind in spans:
        span = window[a:b]
        if kind == "email":
            span = span.replace("@", "/")
        elif kind == "ip":
            span = "9" + span[1:].replace(".", ".9", 1) + "99"
        elif kind == "card":
            span = span[:-1] + str((int(span[-1]) + 1 + zlib.crc32(span.encode()) % 8) % 10)
        else:
            digits = [c for c in span if c.isdigit()]
            span = " ".join(digits) if zlib.crc32(span.encode()) % 2 else "".join(digits)
        out, done = out + window[done:a] + span, b
    return out + window[done:]


def apart(spans: list[tuple[int, int, str]]) -> list[tuple[int, int, str]]:
    """Spans that do not overlap: kinds as listed first, then the leftmost."""
    kept: list[tuple[int, int, str]] = []
    for s in sorted(spans, key=lambda s: (KINDS.index(s[2]), s[0])):
        if all(s[1] <= k[0] or k[1] <= s[0] for k in kept):
            kept.append(s)
    return sorted(kept)


def fit_field(docs: DataFrame, train_documents: int = TRAIN_DOCUMENTS, train_windows: int = TRAIN_WINDOWS) -> SemiMarkovField:
    """A field fitted on at most ``train_windows`` windows of about ``train_documents`` texts, taken by hash.

    Half of the windows hold a base span, as far as there are so many. Each is at most ``MAX_WINDOW`` long,
    so what reaches the driver is bounded by the parameters.
    """

    def examples(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for text in batch.column(0).to_pylist():
                spans = base_spans(text)
                for a, b in windows(text):
                    if b - a <= MAX_WINDOW and worth_a_look(text[a:b]):
                        own = apart([(s - a, e - a, k) for s, e, k in spans if a <= s and e <= b])
                        rows.append((text[a:b], ",".join(f"{k}:{s}:{e}" for s, e, k in own)))
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.string()) for c in zip(*rows)] if rows else [pa.array([], pa.string())] * 2, ["win", "spans"])

    told = docs.select("doc_id", text_of().alias("text")).filter(F.col("text").rlike("@|[0-9]{2}"))
    sample = hash_sample(told, ["doc_id", "text"], train_documents).select("text")
    found = sample.mapInArrow(examples, "win STRING, spans STRING").distinct()
    order = F.xxhash64("win")
    rows = [r for has in (F.col("spans") != "", F.col("spans") == "") for r in found.filter(has).orderBy(order, "win", "spans").limit(train_windows // 2).collect()]
    train = []
    for r in sorted(rows, key=lambda r: zlib.crc32(r.win.encode())):
        spans = [(int(s), int(e), k) for k, s, e in (x.split(":") for x in r.spans.split(",") if x)]
        train.append((r.win, spans))
        if spans:
            train.append(rewritten(r.win, spans))
            train.append((spoiled(r.win, spans), []))
    return SemiMarkovField().fit(train) if any(s for _, s in train) else SemiMarkovField({(k, "bias"): -9.0 for k in KINDS})


def all_spans(text: str, field: SemiMarkovField) -> tuple[list[tuple[int, int, str]], list[tuple[int, int, str]]]:
    """Base spans, and those with the field's additions; both by start, then kind."""
    base = base_spans(text)
    added = []
    for a, b in windows(text):
        if worth_a_look(text[a:b]):
            for s, e, kind in field.best(text[a:b], text[a - 1 : a], text[b : b + 1]):
                if all(a + e <= x[0] or x[1] <= a + s for x in base):
                    added.append((a + s, a + e, f"crf_{kind}"))
    order = (*KINDS, *[f"crf_{k}" for k in KINDS])
    return base, sorted([*base, *added], key=lambda s: (s[0], order.index(s[2])))


def find_spans(docs: DataFrame, field: SemiMarkovField | None = None) -> DataFrame:
    """Per row: ``doc_id``, base counts, digest of the base spans and all spans as ``kind:start:end``, comma-joined."""
    weights = (field or fit_field(docs)).weights
    schema = "doc_id BIGINT, n_email BIGINT, n_ip BIGINT, n_card BIGINT, n_phone BIGINT, base_sha256 STRING, spans STRING"
    names = ["doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fitted = SemiMarkovField(weights)
        for batch in batches:
            counts: list[list[int]] = [[] for _ in KINDS]
            digests, written = [], []
            for text in batch.column(1).to_pylist():
                base, spans = all_spans(text, fitted)
                for k, kind in enumerate(KINDS):
                    counts[k].append(sum(s[2] == kind for s in base))
                digests.append(hashlib.sha256(",".join(f"{k}:{a}:{b}" for a, b, k in base).encode()).hexdigest())
                written.append(",".join(f"{k}:{a}:{b}" for a, b, k in spans))
            columns = [batch.column(0), *[pa.array(c, pa.int64()) for c in counts], pa.array(digests, pa.string()), pa.array(written, pa.string())]
            yield pa.RecordBatch.from_arrays(columns, names)

    return docs.select("doc_id", text_of().alias("text")).mapInArrow(run, schema)


def masked(text: str, spans: list[tuple[int, int, str]]) -> str:
    """The text with spans replaced by their kind in angle brackets; of overlapping spans the first names the whole stretch."""
    out, done, upto = [], 0, 0
    for a, b, kind in sorted(spans):
        if a >= upto:
            out += [text[done:a], f"<{kind.removeprefix('crf_')}>"]
        upto = done = max(upto, b)
    return "".join(out) + text[done:]


def mask_documents(docs: DataFrame, field: SemiMarkovField | None = None) -> DataFrame:
    """``docs`` with all spans masked in ``text``; null texts stay null, other columns as they are."""
    weights = (field or fit_field(docs)).weights
    place = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fitted = SemiMarkovField(weights)
        for batch in batches:
            texts = [t if t is None else masked(t, all_spans(t, fitted)[1]) for t in batch.column(place).to_pylist()]
            yield batch.set_column(place, batch.schema.field(place).name, pa.array(texts, batch.schema.field(place).type))

    return docs.mapInArrow(run, docs.schema)
