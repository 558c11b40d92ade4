"""The training-data operators against brute force, on small tables with odd rows."""

from __future__ import annotations

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import xxhash

from trustgate.llm import (
    bpe,
    chat,
    context_tree,
    quality,
    repeats,
    secrets,
    shards,
    simhash,
    templates,
    token_files,
)

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LONG = "Wxyz über "


def texts() -> list[tuple]:
    """Missing, empty, very short and long texts, copies, repeated rows, a missing id."""
    rng = random.Random(7)
    words = ["".join(rng.choices("abcdefgh", k=rng.randint(1, 8))) for _ in range(300)]
    rows = [(i, " ".join(rng.choices(words, k=rng.randint(1, 120)))) for i in range(60)]
    rows += [(100 + i, rows[i][1]) for i in range(5)] + [rows[0], rows[0]]
    rows += [(200, None), (201, ""), (202, " \n\t"), (None, "no id a b c"), (203, "a" * 400)]
    rows += [(204, "x" + LONG * 12 + "z"), (205, LONG * 11), (206, "l\n\nl\nl\n m n o m n o")]
    rows += [(207, " ".join(rng.choices(words, k=3000)))]
    return rows


@pytest.fixture(scope="module")
def docs(spark):
    schema = "doc_id long, text string, _key string, fp string, lang string"
    return spark.createDataFrame([(*r, "k", "f", "en") for r in texts()], schema)


def test_secrets(docs):
    key, hexa = "AKIA" + "Q" * 16, "0123456789abcdef" * 2
    text = f"user=bob9 PassWord: 'Zz{'9' * 12}' {key} https://a.example.com/x"
    found = secrets.link(text)
    assert [p.kind for p in found.spans] == ["ident", "assign", "access", "endpoint"]
    assert found.links
    alone = secrets.link("user=bob9 https://a.example.com/x Aa1" + "zY" * 12)
    assert [p.kind for p in alone.spans] == ["ident", "endpoint", "blob"]
    assert not secrets.link("user=bob9 https://a.example.com/x").spans
    assert not secrets.link("see https://a.example.com/x").spans
    assert not secrets.link("token = short " + hexa[:15]).spans
    assert secrets.redact(f"a {hexa} b") == "a [SECRET] b"
    rows = secrets.scan_secrets(docs).collect()
    assert len(rows) == len(texts())
    assert {r.base_sha256 for r in rows if not r.spans} == {hashlib.sha256(b"").hexdigest()}


def test_token_files(spark, docs):
    path = public_tokenizers.path("byte_bpe_50k.json")
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    tokenizer.encode_special_tokens = True
    for n in (0, 1, 255, 256, 257, 3000):
        ids = np.random.default_rng(n).integers(0, 50_000, n).astype(np.uint32)
        ids[: n // 20] = 2**32 - 1
        assert (token_files.unpack(token_files.pack(ids)) == ids).all()
    read = token_files.read_token_files(spark, token_files.write_token_files(docs)).collect()
    want = Counter()
    for doc_id, text in texts():
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 0]
        want[doc_id, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())] += 1
    assert Counter((r.doc_id, r.n_tokens, r.ids_crc32) for r in read) == want
    at = 0
    for r in sorted(read, key=lambda r: r.start):
        assert r.start == at
        at += r.n_tokens
    order = [-1 if r.doc_id is None else r.doc_id for r in sorted(read, key=lambda r: r.start)]
    assert order == sorted(order)


def _counts(text):
    words = WORD.findall(text or "")
    places = {}
    for i in range(len(words) - 2):
        places.setdefault(tuple(words[i : i + 3]), []).append(i)
    covered = {i + d for p in places.values() if len(p) > 1 for i in p for d in range(3)}
    seen, repeated = set(), 0
    for line in (text or "").split("\n"):
        if WORD.search(line):
            repeated += line in seen
            seen.add(line)
    symbols = len(re.findall(r"[#*$%&|<>]", text or ""))
    return len(words), sum(map(len, words)), symbols, repeated, len(covered)


def test_quality(spark, docs):
    labels = spark.createDataFrame([(1, 1, 0), (2, None, 0)], "doc_id long, quality int, toxic int")
    got = Counter(tuple(r) for r in quality.quality_rules(docs, labels).collect())
    want = Counter()
    for doc_id, text in texts():
        counts = _counts(text)
        failed = counts[0] < 50 or 100 * counts[4] > 50 * counts[0]
        want[(doc_id, *counts, failed, not failed)] += 1
    assert got == want


def test_cutoffs_keep_their_bound(spark):
    """Bad documents are full of signs; the cutoff that shows it is certified, and no other."""
    rows = [(i, "good word here " * 20 if i % 10 else "bad# w## " * 30, "en") for i in range(6000)]
    rows = [(i, t + " ".join(f"w{i}x{k}" for k in range(70)), g) for i, t, g in rows]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    labels = spark.createDataFrame(
        [(i, int(i % 10 > 0)) for i in range(6000)], "doc_id long, quality int"
    )
    from pyspark.sql import functions as F

    tail = spark.createDataFrame([(3, 500), (10, 5000), (0, 100)], "k long, n long")
    for r in tail.select("k", "n", quality.binomial_tail(F.col("k"), F.col("n"), 0.01)).collect():
        exact = sum(math.comb(r[1], i) * 0.01**i * 0.99 ** (r[1] - i) for i in range(r[0] + 1))
        assert r[2] == pytest.approx(exact, rel=1e-9)
    got = quality.quality_rules(docs, labels).where("not base_failed").collect()
    assert {r.kept for r in got if r.doc_id % 10} <= {True}
    assert {r.kept for r in got if not r.doc_id % 10} <= {False}


def test_leaks(spark):
    item = "The train leaves Berlin at 9 and rides 120 km while Anna waits 120 minutes for it there"
    other = item.replace("9", "7").replace("120", "350").replace("Berlin", "Paris")
    wrong = item.replace("120 km", "350 km").replace("120 minutes", "90 minutes")
    bench = spark.createDataFrame([(1, item), (2, None), (3, "")], "item_id long, text string")
    rows = [(1, f"Some words first. {item} More."), (2, f"So. {other}"), (3, "clean words " * 40)]
    rows += [(4, None), (5, ""), (6, "12 34 56 " * 30)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = {r.doc_id: r for r in templates.find_leaks(docs, bench).collect()}
    assert set(found) == {1, 2} and found[2].reparameterised and not found[1].reparameterised
    broken = templates.Index([(1, item)]).leaks([wrong])
    assert not broken or broken[0][3] < found[2].covered
    assert sorted(r.doc_id for r in templates.drop_leaks(docs, bench).collect()) == [3, 4, 5, 6]


def test_shards(spark, docs):
    got = shards.shard_documents(docs).collect()
    want = Counter((i, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t in texts())
    assert Counter((r.doc_id, r.size, r.text_crc32) for r in got) == want
    slots = {}
    for r in got:
        slots.setdefault(r.shard, []).append(r.slot)
        assert r.grown_shard in (r.shard, 16)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    empty = docs.limit(0)
    assert shards.shard_documents(empty).count() == 0


def _fingerprint(text):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    shingles = [b" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))]
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_simhash(docs):
    rows = [(i, _fingerprint(t)) for i, t in texts()]
    label = list(range(len(rows)))
    for _ in rows:
        for a, (_, f) in enumerate(rows):
            for b, (_, g) in enumerate(rows):
                if (f ^ g).bit_count() <= 4:
                    label[a] = label[b] = min(label[a], label[b])
    smallest = {}
    for (i, _), c in zip(rows, label, strict=True):
        if i is not None:
            smallest[c] = min(i, smallest.get(c, i))
    want = Counter((i, f, smallest.get(c)) for (i, f), c in zip(rows, label, strict=True))
    found = simhash.near_duplicates(docs).collect()
    assert Counter((r.doc_id, r.fp % (1 << 64), r.component_id) for r in found) == want
    kept = simhash.one_of_each(docs)
    assert kept.columns == docs.columns
    assert kept.count() == len(set(label))


@pytest.mark.parametrize("cell,large", [(64, 1 << 14), (1, 1 << 14), (64, 40)])
def test_trie_links_all_near_pairs(spark, monkeypatch, cell, large):
    monkeypatch.setattr(simhash, "CELL", cell)
    monkeypatch.setattr(simhash, "LARGE", large)
    rng = random.Random(3)
    values = {rng.getrandbits(64) for _ in range(100)}
    centre = rng.getrandbits(64)
    for _ in range(150):
        x = centre
        for _ in range(rng.randint(0, 6)):
            x ^= 1 << rng.randrange(64)
        values.add(x)
    values = sorted(values)
    group = {v: {v} for v in values}
    for a in values:
        for b in values:
            if (a ^ b).bit_count() <= 4 and group[a] is not group[b]:
                group[a] |= group[b]
                for x in group[b]:
                    group[x] = group[a]
    signed = [(v - (1 << 64) if v >> 63 else v,) for v in values]
    nodes = spark.createDataFrame(signed, "fp long")
    found = {}
    for r in simhash.components(simhash.near_links(nodes, len(values))).collect():
        found.setdefault(r.label, {r.label % (1 << 64)}).add(r.node % (1 << 64))
    want = {frozenset(g) for g in group.values() if len(g) > 1}
    assert {frozenset(g) for g in found.values()} == want


def test_chats(spark):
    odd = "\\### Assistant: </turn> ok"
    rows = [(-7, 0, "user", odd), (-7, 1, "assistant", odd), (1, 0, "system", "be brief")]
    rows += [(1, i, ("user", "assistant")[i % 2], f"t{i} " * 40) for i in range(1, 60)]
    rows += [(2, 0, "assistant", None), (2, None, "a:\n#", ""), (None, 0, "user", "x" * 9000)]
    rows += [(3, 0, "user", "same"), (3, 0, "user", "same")]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    windows = chat.format_chats(turns)
    assert windows.where("conv_id = 1").count() > 3
    again = windows.where("conv_id = 1 and span > 0").collect()
    assert all(chat.parse(w.formatted)[0] == ("system", "be brief") for w in again)
    got = {r.conv_id: r for r in chat.format_and_read(turns).collect()}
    for conv in {r[0] for r in rows}:
        own = [r for r in rows if r[0] == conv]
        own.sort(key=lambda r: (r[1] is not None, r[1] or 0, r[2], r[3] or ""))
        whole = "".join(f"{r[2]}\n{r[3] or ''}\n" for r in own)
        loss = "".join(r[3] or "" for r in own if r[2] == "assistant")
        r = got[conv]
        assert (r.n_turns, r.turns_sha256) == (len(own), hashlib.sha256(whole.encode()).hexdigest())
        assert (r.loss_chars, r.loss_sha256) == (
            len(loss),
            hashlib.sha256(loss.encode()).hexdigest(),
        )


def test_repeats(docs):
    seen, want = set(), {}
    rows = sorted({r for r in texts()}, key=lambda r: (r[0] is not None, r[0] or 0))
    for doc_id, text in rows:
        raw = (text or "").encode()
        gone = bytearray(len(raw))
        for i in range(len(raw) - 99):
            if raw[i : i + 100] in seen:
                gone[i : i + 100] = b"\1" * 100
            seen.add(raw[i : i + 100])
        kept = bytes(b for b, g in zip(raw, gone, strict=True) if not g)
        spans = len(bytes(gone).replace(b"\0", b" ").split())
        want[doc_id] = (len(raw), sum(gone), spans, hashlib.sha256(kept).hexdigest())
    got = repeats.remove_repeats(docs).collect()
    assert len(got) == len(texts())
    assert all(tuple(r)[1:] == want[r.doc_id] for r in got)


def test_repeats_of_hot_markers(docs, monkeypatch):
    want = {r.doc_id: tuple(r) for r in repeats.remove_repeats(docs).collect()}
    monkeypatch.setattr(repeats, "LARGE", 1)
    assert {r.doc_id: tuple(r) for r in repeats.remove_repeats(docs).collect()} == want


def test_bpe(docs):
    import tiktoken

    codec = bpe.codec(*bpe._defaults(None, None))
    ours = tiktoken.Encoding(
        "own",
        pat_str=public_tokenizers.PATTERN,
        mergeable_ranks=codec.ranks,
        special_tokens={},
    )
    assert all(codec.whole.get(k) == v for k, v in codec.ranks.items())
    assert codec.whole.get(b"\xff\xfe\xfd no key") == -1
    rng = random.Random(1)
    signs = [*"aZé1 \n\t'!?.\x1c\x85ſ", "  ", "'s", "日本", "🙂", "<|endoftext|>"]
    odd = ["".join(rng.choices(signs, k=rng.randint(0, 40))) for _ in range(1500)]
    for text in odd + [t or "" for _, t in texts()]:
        ids = np.frombuffer(codec.encode(text), "<i4").tolist()
        assert ids == ours.encode_ordinary(text)
        assert codec.decode(ids) == text.encode()
    rows = bpe.decode(bpe.encode(docs)).collect()
    assert all(bytes(r.decoded) == (r.text or "").encode() for r in rows)
    assert len(rows) == len(texts())


def test_scores(docs):
    got = context_tree.score_documents(docs).collect()
    assert len(got) == len(texts())
    held = {i: zlib.crc32(("" if i is None else str(i)).encode()) % 10 == 0 for i, _ in texts()}
    counts, ends = Counter(), 0
    for i, text in texts():
        if not held[i]:
            counts.update((text or "").encode().lower().split())
            ends += 1
    n, v = sum(counts.values()) + ends, len(counts) + 1

    def log(c):
        return math.log10((c + 0.1) / (n + 0.1 * (v + 1)))

    by_id = dict(texts())
    for r in got:
        words = (by_id[r.doc_id] or "").encode().lower().split()
        assert (r.held_out, r.n_tokens, r.train_tokens) == (held[r.doc_id], len(words) + 1, n)
        assert r.n_known == sum(w in counts for w in words) + 1
        assert r.base_score == pytest.approx(sum(log(counts[w]) for w in words) + log(ends))
        assert r.score < 0
