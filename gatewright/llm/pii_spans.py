"""Fixed patterns of personal data: the base spans every document gets.

Each function gives the leftmost non-overlapping matches of its pattern that
pass its test, as (start, end) in code points; a failing match is dropped and
not tried again shorter. All run in time linear in the text.
"""

from __future__ import annotations

import re

KINDS = ("email", "ip", "card", "phone")
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# The look-behind only spares starts inside a run of digits, where the pattern fails as it did at the run's start.
IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]+")
CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
DIGITS = re.compile(r"[0-9]+")


def luhn(digits: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(digits)):
        n = ord(c) - 48
        if k % 2:
            n = n * 2 - 9 if n > 4 else n * 2
        total += n
    return total % 10 == 0


def emails(text: str) -> list[tuple[int, int]]:
    found, done, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in LOCAL:
            start -= 1
        match = DOMAIN.match(text, at + 1) if start < at else None
        if match:
            done = match.end()
            found.append((start, done))
        else:
            done = at + 1
        at = text.find("@", done)
    return found


def small_number(part: str) -> bool:
    part = part.lstrip("0")
    return len(part) < 3 or len(part) == 3 and part <= "255"


def ips(text: str) -> list[tuple[int, int]]:
    return [m.span() for m in IP.finditer(text) if all(map(small_number, m.group().split(".")))]


def cards(text: str) -> list[tuple[int, int]]:
    found = []
    for m in CARD.finditer(text):
        if m.end() - m.start() >= 12:
            digits = m.group().replace(" ", "").replace("-", "")
            if 12 <= len(digits) <= 19 and luhn(digits):
                found.append(m.span())
    return found


def phones(text: str) -> list[tuple[int, int]]:
    return [m.span() for m in PHONE.finditer(text) if 9 <= sum(map(len, DIGITS.findall(m.group()))) <= 15]


def base_spans(text: str) -> list[tuple[int, int, str]]:
    """All base spans by start, then kind in the order of ``KINDS``."""
    found = []
    if "@" in text:
        found += [(*s, "email") for s in emails(text)]
    if DIGITS.search(text):
        found += [(*s, "ip") for s in ips(text)] if "." in text else []
        found += [(*s, "card") for s in cards(text)]
        found += [(*s, "phone") for s in phones(text)] if "+" in text else []
    return sorted(found, key=lambda s: (s[0], KINDS.index(s[2])))
