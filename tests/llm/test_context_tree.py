"""Context-tree weighting of all depths against brute force."""

from __future__ import annotations

import math
import random
import zlib
from collections import defaultdict

import numpy as np
import pytest

from trustgate.llm import context_tree

SCHEMA = "doc_id long, text string"


def kt(zero: int, one: int) -> float:
    out = 0.0
    for i in range(zero):
        out += math.log(i + 0.5)
    for i in range(one):
        out += math.log(i + 0.5)
    return out - sum(math.log(i + 1) for i in range(zero + one))


def brute(rows: list[tuple]) -> list[float]:
    """log10 scores: a tree for each decision, grown byte by byte to the start of each text."""

    def steps(text: str):
        raw = (text or "").encode().lower() + b"\xff"
        for i, byte in enumerate(raw):
            for k in range(8):
                # A text's start ends its context: -1 is the last step there is.
                yield (k, byte >> (8 - k)), (byte >> (7 - k)) & 1, (*raw[:i][::-1], -1)

    seen = defaultdict(list)
    for i, text in rows:
        if zlib.crc32(("" if i is None else str(i)).encode()) % 10:
            for decision, bit, past in steps(text):
                seen[decision].append((past, bit))
    trees = {d: build(observed, 0) for d, observed in seen.items()}
    out = []
    for _, text in rows:
        score = 0.0
        for decision, bit, past in steps(text):
            score += math.log10(chance(trees.get(decision), past, bit))
        out.append(score)
    return out


def build(observed: list, depth: int) -> dict:
    """The contexts below one, with ln of their weighted probabilities."""
    one = sum(b for _, b in observed)
    zero = len(observed) - one
    node = {"n": (zero, one), "own": kt(zero, one), "kids": {}}
    if len(observed[0][0]) == depth and all(len(p) == depth for p, _ in observed):
        return node | {"value": node["own"]}
    below = defaultdict(list)
    for past, bit in observed:
        below[past[depth]].append((past, bit))
    node["kids"] = {c: build(o, depth + 1) for c, o in below.items()}
    value = sum(k["value"] for k in node["kids"].values())
    return node | {"value": np.logaddexp(node["own"], value) - math.log(2)}


def chance(node: dict | None, past: tuple, bit: int) -> float:
    out, rest = 0.0, 1.0
    for step in (*past, None):
        if node is None:
            return out + rest * 0.5
        own = (node["n"][bit] + 0.5) / (sum(node["n"]) + 1)
        if not node["kids"]:
            return out + rest * own
        stop = math.exp(node["own"] - math.log(2) - node["value"])
        out, rest = out + rest * stop * own, rest * (1 - stop)
        node = node["kids"].get(step)
    raise AssertionError


def rows() -> list[tuple]:
    rng = random.Random(3)
    words = ["".join(rng.choices("abcdé", k=rng.randint(1, 5))) for _ in range(30)]
    out = [(i, " ".join(rng.choices(words, k=rng.randint(1, 15)))) for i in range(18)]
    out += [(100 + i, out[i][1]) for i in range(3)] + [out[1], out[1]]
    long = " ".join(rng.choices(words, k=40))
    out += [(110 + i, f"{'xyz'[i % 3]}{i}{long} {'pq'[i % 2]}") for i in range(5)]
    out += [(130, long[:90] + "Q" + long[91:]), (131, long[:90] + "R" + long[91:])]
    out += [(200, None), (201, ""), (None, "no id"), (203, "a" * 100)]
    return out


@pytest.fixture(scope="module")
def want() -> dict:
    return dict(zip([i for i, _ in rows()], brute(rows())))


@pytest.mark.parametrize("part", [10_000_000, 20])
def test_all_depths(spark, monkeypatch, want, part):
    """One part, and so many that the tree is cut at different depths."""
    monkeypatch.setattr(context_tree, "PART", part)
    given = rows()
    got = context_tree.score_documents(spark.createDataFrame(given, SCHEMA)).collect()
    assert len(got) == len(given)
    for r in got:
        assert r.score == pytest.approx(want[r.doc_id], rel=1e-7), r.doc_id
