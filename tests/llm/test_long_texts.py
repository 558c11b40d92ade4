"""Texts beyond the sizes at which work is cut into parts."""

from __future__ import annotations

import random

import numpy as np
import public_tokenizers
import pytest

from trustgate.llm import packing, pieces, repeats, runs, simhash, token_files

PATH = public_tokenizers.path("byte_bpe_50k.json")


def long_text(n: int, seed: int = 3) -> str:
    rng = random.Random(seed)
    words = ["".join(rng.choices("abcdeéü", k=rng.randint(1, 9))) for _ in range(500)]
    gaps = [" ", " ", " ", "\n", "  ", " \n ", "\t", ". ", ", ", "  ", "!!", " 12 "]
    return "".join(rng.choice(words) + rng.choice(gaps) for _ in range(n))


@pytest.mark.parametrize("size", [1, 7, 100, 5000])
def test_parts_are_the_text_and_cut_between_matches(monkeypatch, size):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(PATH)
    text = long_text(3000) + "x" * 400 + "   \n\n" + "é" * 300 + " end"
    assert "".join(pieces.parts(text, size)) == text
    monkeypatch.setattr(pieces, "PART", size)
    want = tokenizer.encode(text, add_special_tokens=False).ids
    assert token_files.encode_text(text, PATH).tolist() == want


def test_a_text_longer_than_a_part():
    from tokenizers import Tokenizer

    text = long_text(300_000)
    assert len(text) > 1.5 * pieces.PART
    want = Tokenizer.from_file(PATH).encode(text, add_special_tokens=False).ids
    assert token_files.encode_text(text, PATH).tolist() == want


def test_blocks_packed_in_steps(monkeypatch):
    ids = np.random.default_rng(5).integers(0, 50_000, 40_000).astype(np.uint32)
    ids[::977] = 2**31
    whole = token_files.pack(ids)
    monkeypatch.setattr(token_files, "STEP", 3)
    assert token_files.pack(ids) == whole and (token_files.unpack(whole) == ids).all()


def test_votes_in_chunks():
    hashes = np.random.default_rng(6).integers(0, 2**63, 200_000, dtype=np.uint64)
    bits = (hashes[:, None] >> np.arange(64, dtype=np.uint64)) & np.uint64(1)
    want = sum(1 << b for b in range(64) if 2 * int(bits[:, b].sum()) > len(hashes))
    assert simhash.vote(hashes) % (1 << 64) == want


def test_stretches_of_parts_are_those_of_the_text():
    """A text cut with overlap has each window once, with the same marker."""
    raw = long_text(2000).encode()
    bounds = np.array([0, len(raw)])
    starts, counts, markers = repeats.stretches(raw, bounds, repeats.GRAM)
    windows = {s + k: m for s, n, m in zip(starts, counts, markers) for k in range(n)}
    assert sorted(windows) == list(range(len(raw) - repeats.LENGTH + 1))
    size, found = 700, {}
    for at in range(0, len(raw) - repeats.LENGTH + 1, size):
        part = raw[at : at + size + repeats.LENGTH - 1]
        s, n, m = repeats.stretches(part, np.array([0, len(part)]), repeats.GRAM)
        for a, b, c in zip(s, n, m):
            found.update({at + a + k: c for k in range(b)})
    assert found == windows


def test_a_long_document_through_the_new_operators(spark):
    """Sixty thousand words beside short ones: packed whole, and its run found."""
    words = [f"w{i % 9973}" for i in range(40_000)] + ["p", "q", "r"] * 7000
    docs = spark.createDataFrame([(1, " ".join(words)), (2, "a b")], "doc_id long, text string")
    found = {r.doc_id: r for r in runs.find_runs(docs).collect()}
    assert [tuple(x) for x in found[1].runs] == [(0, 40_000, 9973), (40_000, 21_000, 3)]
    assert len(found[1].collapsed.split()) == 9973 + 3 and not found[2].runs
    got = packing.pack(docs).where("doc_id = 1").orderBy("start").collect()
    ids = np.frombuffer(b"".join(bytes(p.ids) for p in got), "<u4")
    assert ids[:-1].tolist() == token_files.encode_text(" ".join(words), PATH).tolist()
