import hashlib
import itertools
import math
import random
import re

import pytest

from gatewright.llm import pii as op
from gatewright.llm import pii_spans as base

SCHEMA = "doc_id BIGINT, text STRING, spans STRING, n_ip INT"
PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def good(kind, match):
    digits = re.sub("[^0-9]", "", match)
    if kind == "ip":
        return all(int(p) <= 255 for p in match.split("."))
    if kind == "card":
        doubled = [int(c) if k % 2 == 0 else sum(divmod(2 * int(c), 10)) for k, c in enumerate(digits[::-1])]
        return 12 <= len(digits) <= 19 and sum(doubled) % 10 == 0
    return kind != "phone" or 9 <= len(digits) <= 15


def plain(text):
    found = [(m.start(), m.end(), k) for k, p in PLAIN.items() for m in re.finditer(p, text) if good(k, m.group())]
    return sorted(found, key=lambda s: (s[0], base.KINDS.index(s[2])))


def test_base_spans_equal_the_patterns():
    rng = random.Random(9)
    parts = ["a", "1", "25", "4111 1111 1111 1111", "4111-1111-1111-1112", "+49 (0) 170-1234567", "+1", "10.0.0.1", "256.1.1.1", "007.1.2.3.4", "x@y.z", "@", ".", "-", " ", "é", "٣", "a%b+c@d-e.f", "\n", "+", "0"]
    for _ in range(6000):
        text = "".join(rng.choice(parts) for _ in range(rng.randint(0, 9)))
        assert base.base_spans(text) == plain(text), repr(text)


def test_linear_on_long_runs():
    for text in ("1" * 300_000, "a" * 300_000 + "@", "+1" + "(" * 300_000, "1." * 100_000, "@" * 100_000):
        base.base_spans(text)


@pytest.fixture(scope="module")
def field():
    rng = random.Random(2)
    rows = []
    for _ in range(60):
        a = [rng.randint(1, 250) for _ in range(4)]
        rows.append("ip " + ".".join(map(str, a)))
        rows.append(f"+{a[0]} {a[1]} {a[2]} {rng.randint(1000, 9999)}")
        rows.append(f"u{a[0]}@mail{a[1]}.example.com")
        rows.append(f"{a[0]}-{a[1]} {a[2]}")
        card = "4" + "".join(str(rng.randint(0, 9)) for _ in range(14))
        rows.append(next(card + str(c) for c in range(10) if base.luhn(card + str(c))))
    train = []
    for r in rows:
        spans = op.apart(base.base_spans(r))
        train += [(r, spans)] + ([op.rewritten(r, spans), (op.spoiled(r, spans), [])] if spans else [])
    return op.SemiMarkovField().fit(train, epochs=3)


def brute(field, window):
    atoms, ending = op.candidates(window)
    n = len(atoms)
    every = [[(s, e, k, f) for e, found in ending.items() for s, k, f in found if s >= at] for at in range(n + 1)]

    def all_of(at, previous):
        if at == n:
            yield 0.0, []
            return
        for score, rest in all_of(at + 1, op.OUTSIDE):
            yield score, rest
        for s, e, k, f in every[at]:
            if s == at:
                own = field._score(k, f) + field._step(previous, k)
                for score, rest in all_of(e + 1, k):
                    yield score + own, [(atoms[s][0], atoms[e][1], k), *rest]

    return list(all_of(0, op.OUTSIDE))


@pytest.mark.parametrize("window", ["10.0.0.1", "+49 170 1234", "1234567 7654321", "a@b.c 12345678", "4111111111111111"])
def test_best_and_expectations_equal_enumeration(field, window):
    options = brute(field, window)
    assert max(options)[0] == pytest.approx(next(s for s, spans in options if spans == field.best(window)))
    z = sum(math.exp(s) for s, _ in options)
    expected = field._expectations(*op.candidates(window))
    for kind in base.KINDS:
        count = sum(math.exp(s) * sum(k == kind for *_, k in spans) for s, spans in options) / z
        assert expected.get((kind, "bias"), 0.0) == pytest.approx(count, abs=1e-9)


def test_field_adds_other_ways_of_writing(field):
    text = "é 10[.]1[.]2[.]3 und u5 (at) mail7.example.com, 12-3 4 ok"
    spans = op.all_spans(text, field)[1]
    assert {text[a:b] for a, b, _ in spans} == {"10[.]1[.]2[.]3", "u5 (at) mail7.example.com"}
    assert {k for *_, k in spans} == {"crf_ip", "crf_email"}
    assert op.all_spans("am 2024-01-02 um 12:30", field)[1] == []


def test_rows_and_mask(spark, field):
    texts = [(1, None), (2, ""), (3, "a@b.c " * 3), (3, "a@b.c " * 3), (None, "1.2.3.4"), (4, "word " * 50_000 + "+49 170 1234567")]
    frame = spark.createDataFrame([(i, t, "s", 1) for i, t in texts], SCHEMA)
    rows = op.find_spans(frame, field).collect()
    assert len(rows) == len(texts)
    for r, (i, t) in zip(sorted(rows, key=lambda r: (r.doc_id or 0, r.spans)), sorted(texts, key=lambda x: (x[0] or 0, x[1] or ""))):
        spans = plain(t or "")
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(s[2] == k for s in spans) for k in base.KINDS]
        assert r.base_sha256 == hashlib.sha256(",".join(f"{k}:{a}:{b}" for a, b, k in spans).encode()).hexdigest()
    out = op.mask_documents(frame, field)
    assert out.columns == frame.columns
    assert sorted(r.text for r in out.collect() if r.doc_id == 3) == ["<email> " * 3] * 2
    assert op.find_spans(frame.limit(0)).count() == 0
    assert op.find_spans(frame).count() == len(texts)


def test_masking_overlaps():
    assert op.masked("0123456789", [(2, 5, "card"), (4, 7, "phone")]) == "01<card>789"
