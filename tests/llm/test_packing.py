"""Packing: every id in one piece, gapless full sequences, patterns that fit their documents."""

from __future__ import annotations

import random
from collections import Counter
from itertools import combinations_with_replacement

import numpy as np
import public_tokenizers
import pytest

from trustgate.llm import packing, pieces, token_files

SCHEMA = "doc_id long, text string, length long, ids string"


def texts() -> list[tuple]:
    rng = random.Random(11)
    words = ["".join(rng.choices("abcdefgh", k=rng.randint(1, 8))) for _ in range(300)]
    rows = [(i, " ".join(rng.choices(words, k=rng.randint(1, 700)))) for i in range(150)]
    rows += [(None, None), (500, None), (501, ""), (502, " \n"), (503, "<|endoftext|> a"), rows[0]]
    rows += [rows[0], rows[0], (None, "no id"), (504, " ".join(rng.choices(words, k=30_000)))]
    return rows


def check(pieces: list, rows: list[tuple], capacity: int) -> None:
    path = public_tokenizers.path("byte_bpe_50k.json")
    wanted = Counter()
    for doc_id, text in rows:
        ids = [*token_files.encode_text(text or "", path).tolist(), packing.END_ID]
        wanted[doc_id, tuple(ids)] += 1
    sequences: dict = {}
    for p in pieces:
        assert p.length * 4 == len(p.ids) and 0 < p.length <= capacity
        sequences.setdefault(p.sequence_id, []).append((p.offset, p.length))
    for places in sequences.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at == capacity or at & (at - 1) == 0 and at < capacity
    assert sorted(sequences) == list(range(len(sequences)))
    # Pieces of one id and size, put together in order, are its texts: as often as there are rows.
    by_doc: dict = {}
    for p in pieces:
        by_doc.setdefault((p.doc_id, p.doc_tokens), Counter())[p.start, bytes(p.ids)] += 1
    got = Counter()
    for (doc_id, ids), n in wanted.items():
        raw = np.array(ids, "<u4").tobytes()
        own = by_doc[doc_id, len(ids)]
        if n == 1:
            parts = sorted(own.elements())
            assert [s for s, _ in parts] == [0, *np.cumsum([len(b) // 4 for _, b in parts])[:-1]]
            assert b"".join(b for _, b in parts) == raw
        else:
            assert sum(len(b) * k for (_, b), k in own.items()) == n * len(raw)
            assert all(raw[4 * s : 4 * s + len(b)] == b for s, b in own)
        got[doc_id, ids] = n
    assert got == wanted and len(by_doc) == len({(d, len(i)) for d, i in wanted})


@pytest.mark.parametrize("payload", [1 << 18, 500])
def test_pack(spark, monkeypatch, payload):
    """The same rules whether documents share a payload or have one each."""
    monkeypatch.setattr(token_files, "PAYLOAD_IDS", payload)
    rows = texts()
    docs = spark.createDataFrame([(*r, 1, "x") for r in rows], SCHEMA).repartition(3)
    check(packing.pack(docs).collect(), rows, packing.CAPACITY)


def test_small_capacity(spark):
    rows = [(i, "a b c d e f g"[: 2 * (i % 7)]) for i in range(400)]
    docs = spark.createDataFrame([(*r, 1, "x") for r in rows], SCHEMA)
    check(packing.pack(docs, capacity=16).collect(), rows, 16)
    assert packing.pack(docs.limit(0)).count() == 0
    assert len(packing.pack(docs.limit(1)).collect()) == 1


def test_patterns_fit():
    rng = np.random.default_rng(4)
    for size, n in ((16, 50), (64, 3000), (2048, 600), (2048, 1)):
        counts = np.bincount(rng.integers(1, size, n), minlength=size)
        used = np.zeros(size, np.int64)
        for pattern, copies in packing.patterns(counts, size):
            assert sum(k * t for k, t in pattern.items()) == size and copies > 0
            for length, times in pattern.items():
                used[length] += times * copies
        assert (used <= counts).all()


def test_program_reaches_the_optimum(monkeypatch):
    """Against all patterns of a small capacity: no dual price lets another one in."""
    monkeypatch.setattr(packing, "GOAL", 2.0)
    rng = np.random.default_rng(8)
    for _ in range(20):
        counts = np.zeros(12, np.int64)
        counts[1:] = rng.integers(0, 30, 11)
        master = packing.Master(counts, 12)
        master.solve()
        lengths = master.lengths.tolist()
        value = sum(x for x, b in zip(master.x, master.basis, strict=True) if b)
        assert value == pytest.approx(master.price @ counts[master.lengths], abs=1e-5)
        assert (master.price >= -1e-6).all()
        price = dict(zip(lengths, master.price.tolist(), strict=True))
        for k in range(1, 13):
            for parts in combinations_with_replacement(lengths, k):
                if sum(parts) == 12:
                    assert sum(price[p] for p in parts) >= 1 - 1e-3 * 13


def test_tail_is_cut_into_powers_of_two():
    assert packing.stretch_ends(0) == [] and packing.stretch_ends(4096) == []
    assert packing.stretch_ends(2048 + 1300) == [3072, 3328, 3344, 3348]
    pieces = list(packing._rest_pieces(2000, 1348, [3072, 3328, 3344, 3348], 2048))
    assert [(b - a, s, o) for a, b, s, o in pieces] == [
        (48, 0, 2000),
        (1024, 1, 0),
        (256, 2, 0),
        (16, 3, 0),
        (4, 4, 0),
    ]


def test_a_workers_memory_keeps_recurring_keys_alone():
    asked = []

    def encode(key):
        asked.append(key)
        return key.encode()

    known = pieces.Memory(encode, 100, recurring=True)
    for i in range(50):
        assert known[f"rare {i}"] == f"rare {i}".encode()
    assert len(known) <= 2  # two keys may share a mark
    assert [known["often"] for _ in range(4)] == [b"often"] * 4
    assert "often" in known and asked.count("often") <= 2
    # However many recur, two generations hold them all.
    for key in [f"{i}" for i in range(1000) for _ in range(2)]:
        assert known[key] == key.encode()
    assert len(known) <= 100 and len(known.old) <= 100


def test_ids_do_not_depend_on_what_is_remembered():
    path = public_tokenizers.path("byte_bpe_50k.json")
    encoder = token_files.memory(path, 20, True)
    for _, text in texts()[:40]:
        wanted = token_files.encode_text(text or "", path).tobytes()
        for _ in range(3):
            assert encoder.ids(text or "") == wanted
