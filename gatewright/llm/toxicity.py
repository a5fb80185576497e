"""Toxicity scores of restored texts.

Insults are often written to escape word lists: ``1d10t``, ``i d i o t``,
``idiooot``. A noisy-channel model restores them. Every suspicious stretch of a
text becomes a lattice: a character may stand for itself, for a letter it looks
like, or for nothing (a separator, a repetition), each at a cost. The Viterbi
path under a character model of the corpus is the restored word. Texts with
their restored words are then scored by a logistic model over a lexicon.

The character model counts n-grams of all documents (``ALPHABET`` symbols to the
``ORDER``, so its size is fixed while its counts grow with the corpus). The
lexicon and its weights come from about ``TRAIN_ROWS`` labelled rows, taken by
hash. Its entries are words and beginnings of words (``stem*``), chosen by how
differently the classes use them and by how many contexts they appear in, since
copies of one document say nothing more than it.

Defined cases: null and empty texts hold no word and score the model's prior.
Rows with equal ids are scored one by one; several labels of an id count as
toxic if one does; rows with a null id are scored, never learned from. Without
labels of both classes every score is 0. Texts of any length are scored whole.
Of equally likely ways to the same last letters the first one counts, of equally
likely words the last in the alphabet, of entries with equal statistics the longer. An empty table gives no scores, and a
model without weights. Further columns, whatever their names, are ignored, and
kept by :func:`drop_toxic`.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gatewright.llm.common import hash_sample, staged, text_of

ORDER = 4
LETTERS = "abcdefghijklmnopqrstuvwxyz"
BOUNDARY, OTHER = 0, 27
ALPHABET = 28
TRAIN_ROWS = 20_000
CANDIDATES = 2_000
LEXICON = 300
MIN_CONTEXTS = 8
MIN_CHI_SQUARE = 20.0
CONTEXTS_PER_ROW = 0.5
STEM_LENGTHS = range(3, 9)
FOLDS, HELD_OUT = 5, 0
#: Letters that a character is used for.
LOOKS_LIKE = {"0": "o", "1": "il", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b", "9": "g", "@": "a", "$": "s", "!": "i", "|": "il", "+": "t"}
SEPARATORS = " ._*-"
COST_SAME, COST_LOOK, COST_REPEAT, COST_SEPARATOR, COST_WORD = 0.05, 0.7, 0.7, 0.3, 0.6

_LOOKS = re.escape("".join(LOOKS_LIKE))
MIXED = re.compile(rf"(?<![A-Za-z{_LOOKS}])(?:[A-Za-z]++[{_LOOKS}]|[{_LOOKS}]++[A-Za-z])[A-Za-z{_LOOKS}]*+(?![0-9])")
REPEATED = re.compile(r"([A-Za-z])\1")
LONG_RUN = re.compile(r"(.)\1{2,}", re.DOTALL)
SPACED = re.compile(rf"(?<![A-Za-z0-9])[A-Za-z{_LOOKS}](?:[ ._*\-]++[A-Za-z{_LOOKS}]){{2,}}(?![A-Za-z0-9])")
#: A word written out letter by letter may follow one of these as a word of its own.
LEADING = re.compile(rf"[AaIi{_LOOKS}][ ._*\-]+(?=.+[ ._*\-])")
WORD = re.compile(r"[^\W\d_]+")
REMEMBERED = 64


def codes(text: str) -> np.ndarray:
    """Symbols of the character model: 1 to 26 for letters (case ignored), 27 for other letters, 0 for all else."""
    points = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), "<u4")
    low = np.minimum(points, 0x250)
    return SYMBOLS[low]


def _symbols() -> np.ndarray:
    table = np.zeros(0x251, dtype=np.int32)
    for point in range(0x250):
        char = chr(point)
        table[point] = LETTERS.find(char) + 1 if char in LETTERS else OTHER if char.isalpha() else BOUNDARY
    table[0x250] = OTHER
    return table


SYMBOLS = _symbols()


def ngram_counts(docs: DataFrame) -> DataFrame:
    """``gram, n``: counts of the n-grams of symbols over all texts, summed per task before the shuffle."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(ALPHABET**ORDER, dtype=np.int64)
        for batch in batches:
            for text in batch.column(0).to_pylist():
                symbols = np.concatenate([np.zeros(ORDER - 1, np.int32), codes(text), np.zeros(1, np.int32)])
                grams = symbols[: -ORDER + 1].astype(np.int64)
                for k in range(1, ORDER):
                    grams = grams * ALPHABET + symbols[k : len(symbols) - ORDER + 1 + k]
                found, n = np.unique(grams, return_counts=True)
                total[found] += n
        seen = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(seen), pa.array(total[seen])], ["gram", "n"])

    return docs.select(text_of().alias("text")).mapInArrow(count, "gram BIGINT, n BIGINT").groupBy("gram").agg(F.sum("n").alias("n"))


def character_model(docs: DataFrame) -> np.ndarray:
    """Log probabilities of a symbol after ``ORDER - 1`` others, interpolated with the shorter histories."""
    found = ngram_counts(docs).toArrow()  # at most ALPHABET ** ORDER rows
    counts = np.zeros(ALPHABET**ORDER, dtype=np.float64)
    if found.num_rows:
        counts[found["gram"].to_numpy()] = found["n"].to_numpy()
    counts = counts.reshape((ALPHABET,) * ORDER)
    model = np.full((ALPHABET,), 1 / ALPHABET)
    for length in range(1, ORDER + 1):
        grams = counts.sum(axis=tuple(range(ORDER - length))) if length < ORDER else counts
        history = grams.sum(axis=-1, keepdims=True)
        weight = history / (history + 20.0)
        model = weight * grams / np.maximum(history, 1) + (1 - weight) * model
    return np.log(model).astype(np.float32).ravel()


def lattice(stretch: str, words: bool = False) -> list[list[tuple[str, float]]]:
    """Per character what it may stand for ('' for nothing, with ``words`` ' ' for the end of a word) and at which cost."""
    out, low = [], stretch.lower()
    spaced = any(c in SEPARATORS for c in low)
    for k, char in enumerate(low):
        options, before = [], low[k - 1] if k else ""
        if char in LETTERS:
            options.append((char, COST_SAME))
        options += [(c, COST_LOOK) for c in LOOKS_LIKE.get(char, "")]
        if char in SEPARATORS and spaced:
            options.append(("", COST_SEPARATOR))
            if words and before and before not in SEPARATORS:
                options.append((" ", COST_WORD))
        elif char == before and char in LETTERS:
            options.append(("", COST_REPEAT))
        out.append(options or [("", COST_LOOK)])
    return out


def decode(stretch: str, model: np.ndarray, words: bool = False) -> str:
    """The most likely word (with ``words``: words) behind a stretch: Viterbi over the lattice, a state being the last ``ORDER - 1`` symbols."""
    size = ALPHABET ** (ORDER - 1)
    best: dict[int, tuple[float, tuple]] = {0: (0.0, ())}
    for options in lattice(stretch, words):
        after: dict[int, tuple[float, tuple]] = {}
        for state, (score, word) in best.items():
            for char, cost in options:
                if char:
                    gram = state * ALPHABET + (BOUNDARY if char == " " else ord(char) - 96)
                    total, to, now = score - cost + float(model[gram]), gram % size, (word, char)
                else:
                    total, to, now = score - cost, state, word
                if to not in after or total > after[to][0]:
                    after[to] = (total, now)
        best = after
    return max((score + float(model[state * ALPHABET]), _written(word)) for state, (score, word) in best.items())[1]


def _written(word: tuple) -> str:
    chars = []
    while word:
        word, char = word
        chars.append(char)
    return "".join(reversed(chars))


def suspicious(text: str) -> list[str]:
    """Stretches that may be disguised words, each once: look-alikes inside words, repeated letters, spaced letters."""
    found = {m.group() for m in MIXED.finditer(text)}
    end, m = 0, REPEATED.search(text)
    while m:
        start, last, end = m.start(), end, m.end()
        while start > last and text[start - 1].isalpha():
            start -= 1
        while end < len(text) and text[end].isalpha():
            end += 1
        found.add(text[start:end])
        m = REPEATED.search(text, end)
    found.update(m.group() for m in SPACED.finditer(text))
    return [s.rstrip("!|+") for s in found]


def decoded_words(stretch: str, model: np.ndarray) -> list[str]:
    """What a stretch may stand for: one word, and if it is spaced also the words it falls into and what follows a leading 'a' or 'I'."""
    if not any(c in SEPARATORS for c in stretch):
        return [decode(stretch, model)]
    found = {decode(stretch, model), *decode(stretch, model, True).split(" ")}
    leading = LEADING.match(stretch)
    if leading:
        found.add(decode(stretch[leading.end() :], model))
    return sorted(found)


def restored_words(text: str, model: np.ndarray, known: dict[str, list[str]]) -> list[str]:
    """Decoded words of a text's suspicious stretches; ``known`` remembers stretches and is bounded by the caller."""
    out = []
    for stretch in suspicious(text):
        words = known.get(stretch)
        if words is None:
            # Three of a kind say all that more of them do.
            words = decoded_words(LONG_RUN.sub(r"\1\1\1", stretch), model) if stretch else []
            if len(stretch) <= REMEMBERED:
                known[stretch] = words
        out += filter(None, words)
    if len(known) > 100_000:
        known.clear()
    return out


def entries(words: list[str]) -> set[str]:
    """Words and their beginnings, as the lexicon writes them."""
    own = set(words)
    return own.union(w[:k] + "*" for w in own for k in STEM_LENGTHS if k <= len(w))


@dataclass
class ToxicityModel:
    """Character model, prior and weights of the lexicon. ``weights`` is empty if there was nothing to learn."""

    characters: np.ndarray
    prior: float = -math.inf
    weights: dict[str, float] = field(default_factory=dict)

    def scorer(self):
        """A function from text to score, for one task."""
        import ahocorasick

        automaton, known = ahocorasick.Automaton(), {}
        for entry in self.weights:
            automaton.add_word(entry.rstrip("*"), len(entry.rstrip("*")))
        if self.weights:
            automaton.make_automaton()

        def score(text: str) -> float:
            if not self.weights:
                return 1 / (1 + math.exp(-self.prior)) if self.prior > -700 else 0.0
            low, hits = text.lower(), set()
            for end, size in automaton.iter(low):
                start = end + 1 - size
                if not (start and low[start - 1].isalpha()):
                    word = low[start : end + 1]
                    hits.add(word + "*")
                    if not low[end + 1 : end + 2].isalpha():
                        hits.add(word)
            hits |= entries(restored_words(text, self.characters, known))
            total = self.prior + sum(self.weights[h] for h in sorted(hits) if h in self.weights)
            return 1 / (1 + math.exp(-max(-700.0, min(700.0, total))))

        return score


def held_out():
    return F.crc32(F.col("doc_id").cast("string")) % FOLDS == HELD_OUT


def training_rows(docs: DataFrame, labels: DataFrame, limit: int = TRAIN_ROWS) -> DataFrame:
    """About ``limit`` labelled texts outside the held-out fold, taken by a hash of the id: ``text, toxic``."""
    told = labels.select("doc_id", "toxic").dropna().filter(~held_out()).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    # The bound of the broadcast side is the limit.
    sample = hash_sample(told, ["doc_id"], limit)
    return docs.select("doc_id", text_of().alias("text")).join(F.broadcast(sample), "doc_id").select("text", "toxic").distinct()


def fit(docs: DataFrame, labels: DataFrame, train_rows: int = TRAIN_ROWS) -> ToxicityModel:
    characters = character_model(docs)
    train = staged(training_rows(docs, labels, train_rows), "toxicity-train")
    sizes = {bool(r.toxic): r["count"] for r in train.groupBy((F.col("toxic") > 0).alias("toxic")).count().collect()}
    if len(sizes) < 2:
        return ToxicityModel(characters)

    def with_words(schema, found):
        """A table made from each text's words (with the word before it) and its label."""

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            known: dict[str, list[str]] = {}
            for batch in batches:
                for rows in found(
                    (WORD.findall(t.lower()), restored_words(t, characters, known), y) for t, y in zip(*[c.to_pylist() for c in batch.columns])
                ):
                    yield pa.RecordBatch.from_pydict(rows)

        return train.mapInArrow(run, schema)

    def count_words(texts):
        counts: Counter = Counter()
        for words, decoded, y in texts:
            counts.update((w, y > 0) for w in entries([*words, *decoded]))
        if counts:
            yield {"word": [w for w, _ in counts], "toxic": [y for _, y in counts], "n": list(counts.values())}

    used = with_words("word STRING, toxic BOOLEAN, n BIGINT", count_words).groupBy("word").agg(
        F.sum(F.when(F.col("toxic"), F.col("n")).otherwise(0)).alias("t"), F.sum(F.when(F.col("toxic"), 0).otherwise(F.col("n"))).alias("c")
    )
    n_toxic, n_clean = sizes[True], sizes[False]
    total, c, t = n_toxic + n_clean, F.col("c"), F.col("t")
    chi = total * F.pow(t * (n_clean - c) - c * (n_toxic - t), 2) / ((t + c) * (total - t - c) * float(n_toxic) * float(n_clean) + 1e-9)
    told = used.filter((t + c >= MIN_CONTEXTS) & (t * n_clean > c * n_toxic)).withColumn("chi", chi).filter(F.col("chi") >= MIN_CHI_SQUARE)
    # The best first; of equals the longest, a whole word before a stem.
    order = [F.desc("chi"), F.desc(F.length(F.rtrim(F.lit("*"), F.col("word")))), "word"]
    candidates: dict[str, int] = {}
    for r in told.orderBy(*order).limit(CANDIDATES).collect():
        stem = r.word.rstrip("*")
        if not any(stem.startswith(k.rstrip("*")) or k.startswith(stem) for k in candidates):
            candidates[r.word] = r.t

    def contexts(texts):
        out: set[tuple[str, str]] = set()
        for words, decoded, y in texts:
            if y > 0:
                out.update((e, before) for before, w in zip(["", *words], words) for e in entries([w]) if e in candidates)
                out.update((e, "") for e in entries(decoded) if e in candidates)
        if out:
            yield {"word": [w for w, _ in out], "before": [b for _, b in out]}

    seen = with_words("word STRING, before STRING", contexts).distinct().groupBy("word").count().collect()
    wide = {r.word: r["count"] for r in seen}
    lexicon = [w for w, n in candidates.items() if wide.get(w, 0) >= max(MIN_CONTEXTS, CONTEXTS_PER_ROW * n)][:LEXICON]
    place = {w: k for k, w in enumerate(lexicon)}

    def rows_of(texts):
        rows = [(sorted({place[e] for e in entries([*words, *decoded]) if e in place}), int(y > 0)) for words, decoded, y in texts]
        yield {"hits": pa.array([h for h, _ in rows], pa.list_(pa.int32())), "y": pa.array([y for _, y in rows], pa.int32())}

    # Equal rows are counted, so the driver gets at most the sample's rows.
    table = with_words("hits ARRAY<INT>, y INT", rows_of).groupBy("hits", "y").count().toArrow()
    x = np.zeros((table.num_rows, len(lexicon) + 1))
    x[:, -1] = 1
    for row, hits in enumerate(table["hits"].to_pylist()):
        x[row, hits] = 1
    weights = logistic(x, table["y"].to_numpy(), table["count"].to_numpy())
    return ToxicityModel(characters, float(weights[-1]), {w: float(v) for w, v in zip(lexicon, weights)})


def logistic(x: np.ndarray, y: np.ndarray, n: np.ndarray, ridge: float = 0.1, steps: int = 30) -> np.ndarray:
    """Weights by Newton's method with a ridge; the last column is the constant."""
    w, penalty = np.zeros(x.shape[1]), np.full(x.shape[1], ridge)
    penalty[-1] = 1e-6
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        gradient = x.T @ (n * (y - p)) - penalty * w
        curve = (x * (n * p * (1 - p))[:, None]).T @ x + np.diag(penalty)
        move = np.linalg.solve(curve, gradient)
        w += move
        if np.abs(move).max() < 1e-6:
            break
    return w


def score_documents(docs: DataFrame, model: ToxicityModel) -> DataFrame:
    """Per row: ``doc_id, held_out, score, predicted``."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # ALPHABET ** ORDER floats and LEXICON words

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        score = shared.value.scorer()
        for batch in batches:
            scores = [score(t) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(scores, pa.float64())], ["doc_id", "score"])

    scored = docs.select("doc_id", text_of().alias("text")).mapInArrow(run, "doc_id BIGINT, score DOUBLE")
    return scored.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def drop_toxic(docs: DataFrame, model: ToxicityModel) -> DataFrame:
    """The rows of ``docs`` that are not predicted toxic, with their columns."""
    shared, place = docs.sparkSession.sparkContext.broadcast(model), docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        score = shared.value.scorer()
        for batch in batches:
            yield batch.filter(pa.array([score(t or "") < 0.5 for t in batch.column(place).to_pylist()], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
