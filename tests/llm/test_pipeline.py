"""The pipeline against a brute-force version of its stages, and every operator on empty tables."""

from __future__ import annotations

import random
import re

import public_tokenizers
import pytest
import tiktoken
import xxhash

import corpus_pipeline
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

COLUMNS = "doc_id long, text string, lang string, source string, n_chars long"
LABELS = "doc_id long, quality int, toxic int"
ITEMS = "item_id long, text string"
ITEM = "a farmer sells twelve boxes of pears each box holds nine pears how many pears did he sell"
KEY = "AKIA" + "Q7" * 8
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def corpus() -> list[tuple]:
    rng = random.Random(11)
    words = ["".join(rng.choices("abcdefghij", k=rng.randint(2, 9))) for _ in range(900)]
    clean = [" ".join(rng.choices(words, k=rng.randint(80, 160))) for _ in range(50)]
    texts = list(enumerate(clean[:40]))
    texts += [(100 + i, clean[i]) for i in range(6)]  # exact copies
    texts += [(200 + i, clean[10 + i] + " tail") for i in range(6)]  # near ones, if so by their bits
    texts += [(300, f"{clean[40]} {ITEM} {clean[41]}"), (301, f"{clean[42]} {ITEM.upper()}")]
    texts += [(302, clean[43] + " " + ITEM.replace("twelve", "forty").replace("nine", "six"))]
    texts += [(400, f"{clean[44]}\nkey {KEY} end"), (401, f"password = {'k9' * 8} {clean[45]}")]
    texts += [(500, None), (501, ""), (502, "few words"), (503, "say it again " * 60)]
    texts += [(None, clean[46] + " without an id")]
    rows = [(i, t, "en", "web", None if t is None else len(t)) for i, t in texts]
    return rows + rows[:1]  # a repeated row


def good(text: str | None) -> bool:
    words = WORD.findall(text or "")
    places: dict[tuple, list[int]] = {}
    for i in range(len(words) - 2):
        places.setdefault(tuple(words[i : i + 3]), []).append(i)
    covered = {i + d for p in places.values() if len(p) > 1 for i in p for d in range(3)}
    return len(words) >= 50 and 100 * len(covered) <= 50 * len(words)


def shingles(text: str) -> frozenset:
    words = (text or "").lower().split()
    return frozenset(tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4)))


def one_of_each(rows: list[tuple]) -> list[tuple]:
    """The first of each group of texts whose five-word shingles agree to 0.8 or more."""
    sets = [shingles(r[1]) for r in rows]
    label = list(range(len(rows)))
    alike = [
        (a, b)
        for a in range(len(rows))
        for b in range(a)
        if 5 * len(sets[a] & sets[b]) >= 4 * len(sets[a] | sets[b])
    ]
    for _ in rows:
        for a, b in alike:
            label[a] = label[b] = min(label[a], label[b])
    order = sorted(range(len(rows)), key=lambda i: (rows[i][0] is None, rows[i][0] or 0))
    first: dict[int, int] = {}
    for i in order:
        first.setdefault(label[i], i)
    return [rows[i] for i in first.values()]


def test_pipeline(spark, tmp_path):
    rows = corpus()
    spark.createDataFrame(rows, COLUMNS).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, 1, 0), (2, None, None)], LABELS).write.parquet(
        f"{tmp_path}/labels.parquet"
    )
    items = [(1, ITEM), (2, None), (3, "")]
    spark.createDataFrame(items, ITEMS).write.parquet(f"{tmp_path}/benchmark.parquet")

    kept = one_of_each([r for r in rows if good(r[1])])
    # The item's words, its numbers replaced by any other ones.
    pattern = re.compile(re.sub(r"\b(twelve|nine)\b", r"\\w+", ITEM), re.IGNORECASE)
    kept = [r for r in kept if not pattern.search(r[1])]
    secret = re.compile(rf"{KEY}|password = \w+")
    codec = bpe.codec(*bpe._defaults(None, None))
    theirs = tiktoken.Encoding(
        "own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=codec.ranks, special_tokens={}
    )
    want = {r[0]: theirs.encode_ordinary(secret.sub(secrets.MARK, r[1])) for r in kept}
    assert len(want) == len(kept) and {400, 401, None} <= set(want)
    assert not {100, 300, 301, 302, 500, 501, 502, 503} & set(want)

    got = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert len(got) == len(want)
    assert {r.doc_id: r.ids for r in got} == want
    assert all(r.round_trip and r.n_tokens == len(r.ids) for r in got)


def test_stages_keep_the_columns(spark, tmp_path):
    """Also where documents bring further columns with names that the stages use themselves."""
    rows = [(*r, "x", 1) for r in corpus()]
    docs = spark.createDataFrame(rows, f"{COLUMNS}, _key string, fp int")
    spark.createDataFrame([], LABELS).write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([], ITEMS).write.parquet(f"{tmp_path}/benchmark.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, str(tmp_path)).columns == docs.columns


@pytest.mark.parametrize(
    "operator",
    [
        lambda s, d: secrets.scan_secrets(d),
        lambda s, d: secrets.redact_documents(d),
        lambda s, d: token_files.read_token_files(s, token_files.write_token_files(d)),
        lambda s, d: quality.quality_rules(d, s.createDataFrame([], LABELS)),
        lambda s, d: quality.keep_good(d, s.createDataFrame([], LABELS)),
        lambda s, d: templates.find_leaks(d, s.createDataFrame([], ITEMS)),
        lambda s, d: templates.drop_leaks(d, s.createDataFrame([(1, ITEM)], ITEMS)),
        lambda s, d: shards.shard_documents(d),
        lambda s, d: simhash.near_duplicates(d),
        lambda s, d: simhash.one_of_each(d),
        lambda s, d: chat.format_and_read(
            s.createDataFrame([], "conv_id long, turn long, role string, text string")
        ),
        lambda s, d: repeats.remove_repeats(d),
        lambda s, d: bpe.decode(bpe.encode(d)),
        lambda s, d: context_tree.score_documents(d),
    ],
)
def test_empty_tables(spark, operator):
    assert operator(spark, spark.createDataFrame([], COLUMNS)).collect() == []


def test_nothing_to_match_or_learn_from(spark):
    """No benchmark item leaves every document; one held-out document is scored without a model."""
    docs = spark.createDataFrame(corpus(), COLUMNS)
    none = spark.createDataFrame([], ITEMS)
    assert templates.find_leaks(docs, none).count() == 0
    assert templates.drop_leaks(docs, none).count() == docs.count()
    alone = docs.where("doc_id is null")
    (row,) = context_tree.score_documents(alone).collect()
    assert row.held_out and row.train_tokens == 0 and row.base_score == pytest.approx(0)
    assert row.score < 0
