"""Periodic runs against a plain search of every start and period."""

from __future__ import annotations

import hashlib
import random
import re
import zlib

import numpy as np
import pytest

from trustgate.llm import runs

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(words: list) -> list[tuple[int, int, int]]:
    """Start, length and smallest period of every run of 12 words and two periods."""
    best: dict[tuple[int, int], int] = {}
    n = len(words)
    for q in range(1, n // 2 + 1):
        i = 0
        while i + q < n:
            if words[i] != words[i + q]:
                i += 1
                continue
            end = i + q
            while end < n and words[end] == words[end - q]:
                end += 1
            if end - i >= max(12, 2 * q):
                best.setdefault((i, end), q)
            i = end - q + 1
    return sorted((s, e - s, q) for (s, e), q in best.items())


def plant(doc_id, words: list) -> list:
    h = zlib.crc32(("" if doc_id is None else str(doc_id)).encode())
    g, n = h // 10, len(words)
    if h % 10 or not n:
        return words
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + [words[a + (i - a) % p] for i in range(a, n)]


def expected(doc_id, text) -> tuple:
    words = plant(doc_id, WORD.findall(text or ""))
    found = brute(words)
    gone = {i for s, n, q in found for i in range(s + q, s + n)}
    kept = " ".join(w for i, w in enumerate(words) if i not in gone)
    lines = "".join(f"{s},{n},{q}\n" for s, n, q in found)
    start, length, period = min(found, key=lambda r: (-r[1], r[0], r[2]), default=(None,) * 3)
    return (
        doc_id,
        len(found),
        start,
        length,
        period,
        1000 * length // period if found else None,
        hashlib.sha256(lines.encode()).hexdigest(),
        hashlib.sha256(kept.encode()).hexdigest(),
    )


def texts() -> list[tuple]:
    rng = random.Random(5)
    rows: list[tuple] = [(None, None), (1, None), (2, ""), (3, " \n\t\x0b"), (None, "a b " * 9)]
    rows += [(4, "w " * 11), (5, "w " * 12), (6, "w " * 500), (7, "a b c " * 4), (8, "a b c d e " * 3)]
    rows += [(9, "a b c d e f " * 2), (10, "a b c d e f " * 2 + "x"), (11, "a b c d e " * 2)]
    for i in range(100, 260):
        letters = "ab" if i % 3 == 0 else "abcdefgh"
        words = rng.choices(letters, k=rng.randint(0, 150))
        at = rng.randint(0, len(words))
        period = rng.choices("abxyz", k=rng.randint(1, 9))
        times = rng.randint(1, 12)
        rows.append((i, " ".join(words[:at] + period * times + words[at:])))
    # Runs inside runs, a doubled text, an accented and a long one, repeated rows.
    inner = ("a a a a a a a a a a a a b " * 3) * 2
    rows += [(300, inner), (301, inner + inner), (302, "é ü x " * 20), (300, inner), (300, inner)]
    rows.append((303, " ".join(f"w{rng.randint(0, 40)}" for _ in range(900)) + " p q r s" * 700))
    return rows


@pytest.mark.parametrize("most", [runs.SORT_BYTES, 300])
def test_runs(spark, monkeypatch, most):
    """The same whether documents are sorted together or alone."""
    monkeypatch.setattr(runs, "SORT_BYTES", most)
    docs = spark.createDataFrame([(*r, "k", 1) for r in texts()], "doc_id long, text string, runs string, a int")
    got = runs.run_digests(runs.find_runs(runs.planted(docs))).collect()
    order = lambda r: (r[0] is not None, r[0] or 0, r[7])
    assert sorted(map(tuple, got), key=order) == sorted((expected(*r) for r in texts()), key=order)
    assert runs.find_runs(docs.limit(0)).count() == 0


def test_random_words():
    """Small alphabets, tries cut into many slices."""
    rng = random.Random(9)
    for _ in range(300):
        words = rng.choices(range(rng.randint(1, 4)), k=rng.randint(0, 90))
        marked = np.array([*words, 99], np.int64)
        got = list(zip(*(x.tolist() for x in runs.runs_of(marked)), strict=True))
        assert got == brute(words)


def test_tries_in_slices(monkeypatch):
    monkeypatch.setattr(runs, "TRIES", 7)
    words = ([1, 2, 3] * 30 + [4] + [1, 2, 3] * 20 + [5] * 40) * 2
    got = list(zip(*(x.tolist() for x in runs.runs_of(np.array([*words, 99]))), strict=True))
    assert got == brute(words)
