"""Plain versions of what the text operators compute, for small tables."""

from __future__ import annotations

import hashlib
import re
from collections import Counter

WORDS = re.compile(r"[^\x20\x09-\x0D]+")
_LOWER = str.maketrans({chr(i): chr(i + 32) for i in range(65, 91)})

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def sha(text: str | bytes) -> str:
    return hashlib.sha256(text if isinstance(text, bytes) else text.encode()).hexdigest()


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        v = int(c) * (1 + i % 2)
        total += v - 9 * (v > 9)
    return total % 10 == 0


def base_spans(text: str) -> list[tuple[str, int, int]]:
    def digits(m: str) -> str:
        return re.sub("[^0-9]", "", m)

    rules = (
        ("email", EMAIL, lambda m: True),
        ("ip", IP, lambda m: all(int(x) <= 255 for x in m.split("."))),
        ("card", CARD, lambda m: 16 <= len(digits(m)) <= 19 and luhn(digits(m))),
        ("phone", PHONE, lambda m: 8 <= len(digits(m)) <= 15),
    )
    return [(k, m.start(), m.end()) for k, p, ok in rules for m in p.finditer(text) if ok(m.group())]


def removed(docs: list[tuple[int, str | None]], length: int = 50) -> list[tuple]:
    """(doc_id, bytes, bytes removed, runs removed, hash of the rest) of every row."""
    first: dict[bytes, int] = {}
    for d, text in docs:
        b = (text or "").encode()
        for i in range(len(b) - length + 1):
            w = b[i : i + length]
            first[w] = min(first.get(w, d), d)
    out = []
    for d, text in docs:
        b = (text or "").encode()
        gone = bytearray(len(b))
        for i in range(len(b) - length + 1):
            if first[b[i : i + length]] < d:
                gone[i : i + length] = b"\1" * length
        runs = sum(1 for i, g in enumerate(gone) if g and (i == 0 or not gone[i - 1]))
        out.append((d, len(b), sum(gone), runs, sha(bytes(c for c, g in zip(b, gone) if not g))))
    return sorted(out)


def shingles(text: str | None) -> frozenset:
    words = WORDS.findall((text or "").translate(_LOWER))
    if len(words) < 5:
        return frozenset([tuple(words)] if words else [])
    return frozenset(tuple(words[i : i + 5]) for i in range(len(words) - 4))


def link(a: frozenset, b: frozenset) -> bool:
    both = len(a & b)
    return both > 0 and 100 * both >= 75 * (len(a) + len(b) - both)


def linked(docs: dict[int, str | None]) -> dict[int, tuple[int, int]]:
    """Per document the number of shingles and the smallest document reachable."""
    sets, root = {d: shingles(t) for d, t in docs.items()}, {d: d for d in docs}
    holders: dict[tuple, list[int]] = {}
    for d, s in sets.items():
        for x in s:
            holders.setdefault(x, []).append(d)

    def find(x: int) -> int:
        while root[x] != x:
            x = root[x]
        return x

    for d, s in sets.items():
        for e in Counter(e for x in s for e in holders[x] if e > d):
            if link(s, sets[e]):
                a, b = find(d), find(e)
                root[max(a, b)] = min(a, b)
    return {d: (len(s), find(d)) for d, s in sets.items()}


def counts(text: str | None) -> tuple:
    """Words, their characters, symbols, repeated lines, words in repeated triples, whether the base rules fail."""
    text = text or ""
    words, seen, copies = WORDS.findall(text), set(), 0
    for line in text.split("\n"):
        if WORDS.search(line):
            copies += line in seen
            seen.add(line)
    often = Counter(zip(words, words[1:], words[2:]))
    covered = {j for i in range(len(words) - 2) if often[tuple(words[i : i + 3])] > 1 for j in (i, i + 1, i + 2)}
    failed = len(words) < 50 or 100 * len(covered) > 50 * len(words)
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), copies, len(covered), failed


def tiled(item: list, text: list, shortest: int) -> int:
    """Words of the item in tiles: the longest common run outside earlier ones, again and again."""
    a, b, total = [False] * len(item), [False] * len(text), 0
    while True:
        best = (0, 0, 0)
        for i in range(len(item)):
            for j in range(len(text)):
                k = 0
                while i + k < len(item) and j + k < len(text) and item[i + k] == text[j + k] and not a[i + k] and not b[j + k]:
                    k += 1
                best = max(best, (k, -i, -j))
        k, i, j = best[0], -best[1], -best[2]
        if k < shortest:
            return total
        a[i : i + k], b[j : j + k] = [True] * k, [True] * k
        total += k
