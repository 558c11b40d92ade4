"""The Merkle manifest against a plain recursive one."""

from __future__ import annotations

import hashlib
import zlib
from collections import Counter

import pytest

from trustgate.llm import merkle

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, grp string, place int"


def digest(value: str) -> str:
    return hashlib.sha256(value.encode()).hexdigest()


def leaf_of(doc_id, source, lang, n_chars, text) -> str:
    out = ""
    for value in (doc_id, source, lang, n_chars, text):
        shown = None if value is None else str(value)
        out += "-" if shown is None else f"{len(shown.encode())}:{shown}"
    return digest(out)


def tree(nodes: list[str]) -> tuple[str, list[list[tuple[str, str]]]]:
    """The root, and of each node what stands left and right of its way, from below."""
    ways: list[list[tuple[str, str]]] = [[] for _ in nodes]
    below = [[i] for i in range(len(nodes))]
    while len(nodes) > 1:
        up, members = [], []
        for at in range(0, len(nodes), 8):
            run = nodes[at : at + 8]
            for k in range(len(run)):
                for i in below[at + k]:
                    ways[i].append(("".join(run[:k]), "".join(run[k + 1 :])))
            up.append(digest("".join(run)))
            members.append([i for b in below[at : at + 8] for i in b])
        nodes, below = up, members
    return nodes[0], ways


def brute(rows: list[tuple]) -> Counter:
    groups: dict = {}
    for doc_id, text, lang, source, n_chars in rows:
        leaf = leaf_of(doc_id, source, lang, n_chars, text)
        groups.setdefault(lang, []).append((doc_id, leaf, text, source, n_chars))
    order = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees, lists = {}, {}
    for lang in order:
        members = sorted(groups[lang], key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
        lists[lang], trees[lang] = members, tree([m[1] for m in members])
    root, uppers = tree([trees[lang][0] for lang in order]) if order else ("", [])
    want: Counter = Counter()
    for lang, upper in zip(order, uppers, strict=True):
        subroot, ways = trees[lang]
        for (doc_id, leaf, text, source, n_chars), way in zip(lists[lang], ways, strict=True):
            way = way + upper
            other = leaf
            if zlib.crc32(("" if doc_id is None else str(doc_id)).encode()) % 3 == 0:
                low = None if text is None else "".join(
                    c.lower() if "A" <= c <= "Z" else c for c in text
                )
                other = leaf_of(doc_id, source, lang, n_chars, low)
            for left, right in way:
                other = digest(left + other + right)
            proof = digest("".join(a + b for a, b in way))
            want[doc_id, leaf, subroot, root, proof, other, other == root] += 1
    return want


def rows_of(n: int) -> list[tuple]:
    """Languages of many sizes, one with 60 % of the rows; odd rows among them."""
    rows = [
        (
            (i * 37) % (2 * n),
            f"Text {i} ÄÖ {'x' * (i % 50)}" if i % 3 else f"text {i}",
            "en" if i % 5 < 3 else ("de", "zz", "Ä", None)[i % 4],
            ("web", None)[i % 2],
            None if i % 7 == 0 else i,
        )
        for i in range(n)
    ]
    rows += [(None, None, None, None, None), (3, "", "", "", 0), (5, "Aa" * 60_000, "one", "s", 1)]
    return rows + [rows[0], rows[0], (None, "No Id", "de", "web", 2), (12, None, "en", "web", 0)]


def run(spark, rows) -> list:
    docs = spark.createDataFrame([(*r, "clash", 7) for r in rows], SCHEMA)
    return merkle.verify_manifest(docs).collect()


@pytest.mark.parametrize("n", [0, 1, 8, 700])
def test_manifest(spark, n):
    rows = rows_of(n) if n else []
    got = run(spark, rows)
    assert Counter(map(tuple, got)) == brute(rows)
    if n > 1:
        assert {r.verified for r in got} == {True, False}


def test_single_leaf_is_the_root(spark):
    (only,) = run(spark, [(4, "a", "en", "web", 1)])
    assert only.leaf == only.subroot == only.root and only.verified
    assert only.proof_sha256 == digest("")


def test_untampered_rows_verify(spark):
    docs = spark.createDataFrame([(*r, "clash", 7) for r in rows_of(100)], SCHEMA)
    rows = merkle.manifest(docs)
    folded = rows.select("root", merkle.folded(rows["leaf"], rows["proof"]).alias("f")).collect()
    assert len(folded) == len(rows_of(100)) and all(r.f == r.root for r in folded)


def test_manifest_matches_sql(spark):
    """Whole documents of the test tables, and odd rows, against the SQL text."""
    import duckdb

    from trustgate.llm.oracle import ORACLE_SQL

    rows = rows_of(300)
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR, lang VARCHAR, source VARCHAR, n_chars BIGINT)")
    con.executemany("INSERT INTO documents VALUES (?, ?, ?, ?, ?)", rows)
    want = con.sql(ORACLE_SQL["op13_merkle_manifest"])
    got = spark.createDataFrame([(*r, "clash", 7) for r in rows], SCHEMA)
    found = merkle.verify_manifest(got)
    assert found.columns == want.columns
    assert Counter(map(tuple, found.collect())) == Counter(map(tuple, want.fetchall()))
