"""The pipeline's near-duplicate stage against brute force on edited copies."""

from __future__ import annotations

import random

import corpus_pipeline


def _shingles(text):
    words = (text or "").lower().split()
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))}


def test_stage_drops_all_copies_of_four_fifths(spark):
    """Copies edited every 20 to 100 words differ in many bits; a common line is no copy."""
    rng = random.Random(5)
    words = ["".join(rng.choices("abcdefgh", k=rng.randint(2, 8))) for _ in range(2000)]
    line = " ".join(rng.choices(words, k=12))
    texts = []
    for _ in range(50):
        base = rng.choices(words, k=rng.randint(60, 300))
        texts.append(" ".join(base) + " " + line)
        for every in (20, 35, 45, 60, 100):
            copy = list(base)
            for _ in range(max(1, len(copy) // every)):
                copy[rng.randrange(len(copy))] = rng.choice(words)
            texts.append(" ".join(copy) + " " + line)
    texts += [None, "", " \n", "three short words", "Three  short words"]
    sets = [_shingles(t) for t in texts]
    label = list(range(len(texts)))
    linked = 0
    for a in range(len(texts)):
        for b in range(a):
            inter = len(sets[a] & sets[b])
            if 5 * inter >= 4 * len(sets[a] | sets[b]):
                old, new = max(label[a], label[b]), min(label[a], label[b])
                label = [new if x == old else x for x in label]
                linked += 1
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    kept = corpus_pipeline.drop_near_duplicates(spark, docs, "")
    assert linked > 100
    assert sorted(r.doc_id for r in kept.collect()) == sorted(set(label))


def test_a_notice_shared_by_many_texts_makes_few_pairs(spark, monkeypatch):
    """Texts that share most of their words, but too few to be copies, aren't all paired."""
    from trustgate.llm import near_copies

    rng = random.Random(8)
    word = lambda: "".join(rng.choices("abcdefgh", k=6))
    notice = [word() for _ in range(300)]
    texts = [" ".join([word() for _ in range(50)] + notice) for _ in range(800)]
    texts += [texts[0] + " more", texts[1]]
    sizes = []
    confirm = near_copies._confirmed
    monkeypatch.setattr(
        near_copies,
        "_confirmed",
        lambda pairs, sets, share: sizes.append(pairs.count()) or confirm(pairs, sets, share),
    )
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    kept = sorted(r.doc_id for r in near_copies.one_of_each(docs).collect())
    assert kept == list(range(800))
    assert sum(sizes) < 10 * len(texts)


def test_copies_of_other_sizes_and_orders_are_found(spark):
    """Brute force over short texts that share passages of all shares, in both directions."""
    from trustgate.llm import near_copies

    rng = random.Random(21)
    words = [f"w{i}" for i in range(400)]
    texts = []
    for _ in range(25):
        base = rng.sample(words, rng.randint(8, 60))
        texts.append(" ".join(base))
        for cut in (1, 2, 3, 5, 8):
            texts.append(" ".join(base[cut:]))
            texts.append(" ".join(base + rng.sample(words, cut)))
    sets = [_shingles(t) for t in texts]
    label = list(range(len(texts)))
    for a in range(len(texts)):
        for b in range(a):
            if 5 * len(sets[a] & sets[b]) >= 4 * len(sets[a] | sets[b]) and label[a] != label[b]:
                old, new = max(label[a], label[b]), min(label[a], label[b])
                label = [new if x == old else x for x in label]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    kept = sorted(r.doc_id for r in near_copies.one_of_each(docs).collect())
    assert kept == sorted(set(label)) and len(kept) < len(texts)
