"""Near copies by the Jaccard similarity of word shingles, found whole.

Two texts are copies if their sets of ``WORDS``-word shingles agree to ``SHARE`` or more, and copies
of copies are one group. SimHash links close copies, but no bit budget that a trie can walk finds
all pairs of that similarity; so its links are only the first candidates. The others come from a
prefix join: with any common order of all shingles, two sets that agree to a share ``s`` have
``COMMON`` shingles in common among the first ``n - ceil(s n) + COMMON`` of each. Shingles that a sample shows to be
frequent come last in the order, which keeps the groups of the join small; the result doesn't
depend on the sample. Every candidate is confirmed by its exact similarity.

Candidates are taken in two rounds: each text with the head of its groups, the one with the fewest
rare shingles, then all pairs that the first round's links left in different components. A large
group of alike texts is thereby one round of pairs with its head, not all pairs.
"""

from __future__ import annotations

from fractions import Fraction

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from trustgate.llm import simhash
from trustgate.llm.common import map_texts, stored, unused

WORDS = 5
SHARE = Fraction(4, 5)
#: Shingles that the prefixes of two copies share, or as many as their sets must share, if fewer.
COMMON = 3
#: One text in so many is sampled for frequent shingles, and so many of these come last.
SAMPLE = 20
FREQUENT = 1 << 18


def hashes(text: str, words: int = WORDS) -> np.ndarray:
    """Hashes of all shingles in order; a text with fewer words is one shingle."""
    found = text.encode().lower().split()
    last = max(1, len(found) - words + 1)
    digest = xxhash.xxh64_intdigest
    each = (digest(b" ".join(found[i : i + words]), simhash.SEED) for i in range(last))
    return np.fromiter(each, np.uint64, last)


def shingles(text: str, words: int = WORDS) -> np.ndarray:
    """Hashes of the distinct shingles, ascending."""
    return np.unique(hashes(text, words)).view(np.int64)


def _lists(values: list[np.ndarray]) -> pa.Array:
    ends = np.cumsum([0, *map(len, values)]).astype(np.int32)
    flat = np.concatenate(values) if values else np.zeros(0, np.int64)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(flat, pa.int64()))


def _sets(texts: DataFrame, words: int) -> DataFrame:
    """node and its shingles."""

    def make():
        def work(batch: pa.RecordBatch) -> pa.RecordBatch:
            found = [shingles(t, words) for t in batch.column("text").to_pylist()]
            return pa.RecordBatch.from_arrays(
                [batch.column("node"), _lists(found)], names=["node", "shingles"]
            )

        return work

    return map_texts(texts.select("node", "text"), make, "node long, shingles array<long>")


def _prefixes(texts: DataFrame, words: int, share: Fraction, frequent: np.ndarray) -> DataFrame:
    """node, key, fingerprint, number of shingles and those that come first in the common order.

    frequent: shingles that come last, the most frequent one at the end.
    """
    by_hash = np.argsort(frequent)
    sent = texts.sparkSession.sparkContext.broadcast((frequent[by_hash], by_hash + 1))

    def make():
        known, ranks = sent.value

        def first(own: np.ndarray) -> tuple[np.ndarray, int]:
            """The prefix, and how many shingles in a thousand aren't known as frequent."""
            rank = np.zeros(len(own), np.int64)
            if len(known):
                at = np.minimum(np.searchsorted(known, own), len(known) - 1)
                rank = np.where(known[at] == own, ranks[at], 0)
            n = len(own)
            kept = n + COMMON + (-n * share.numerator) // share.denominator
            return own[np.lexsort((own, rank))[:kept]], int(1000 * (rank == 0).mean())

        def work(batch: pa.RecordBatch) -> pa.RecordBatch:
            prints, sizes, rare, prefixes = [], [], [], []
            # One text's hashes at a time: only its print and prefix stay.
            for text in batch.column("text").to_pylist():
                each = hashes(text, words)
                own = np.unique(each).view(np.int64)
                prints.append(simhash.vote(each) if text.strip(" \t\n\r\v\f") else 0)
                sizes.append(len(own))
                prefix, odd = first(own)
                prefixes.append(prefix)
                rare.append(odd)
            return pa.RecordBatch.from_arrays(
                [
                    batch.column("node"),
                    batch.column("key"),
                    pa.array(prints, pa.int64()),
                    pa.array(sizes, pa.int64()),
                    pa.array(rare, pa.int32()),
                    _lists(prefixes),
                ],
                names=["node", "key", "fp", "n", "rare", "prefix"],
            )

        return work

    return map_texts(
        texts.select("node", "key", "text"),
        make,
        "node long, key long, fp long, n long, rare int, prefix array<long>",
    )


def _frequent(texts: DataFrame, words: int) -> np.ndarray:
    """Shingles of more than one sampled text, in ascending order of their number."""
    sample = texts.where(F.pmod("node", F.lit(SAMPLE)) == 0)
    counts = (
        _sets(sample, words)
        .dropDuplicates(["node"])
        .select(F.explode("shingles").alias("shingle"))
        .groupBy("shingle")
        .count()
    )
    most = counts.where("count > 1").orderBy(F.desc("count"), "shingle").limit(FREQUENT)
    rows = most.select("shingle").toPandas()["shingle"].to_numpy(np.int64)
    return rows[::-1].copy()


def _confirmed(pairs: DataFrame, sets: DataFrame, share: Fraction) -> DataFrame:
    """Those of the pairs (a, b) whose shingles agree to the share or more."""
    one = sets.select(F.col("node").alias("a"), F.col("shingles").alias("x"))
    two = sets.select(F.col("node").alias("b"), F.col("shingles").alias("y"))
    both = F.size(F.array_intersect("x", "y")).cast("long")
    sizes = (F.size("x") + F.size("y")).cast("long")
    # both / (sizes - both) >= p / q
    p, q = share.numerator, share.denominator
    return stored(
        pairs.join(one, "a").join(two, "b").where(both * (p + q) >= sizes * p).select("a", "b")
    )


def links(texts: DataFrame, words: int = WORDS, share: Fraction = SHARE) -> DataFrame:
    """Links (a, b) between nodes whose closure is that of all pairs of the share or more.

    texts: ``node``, ``key`` and ``text``; rows with the same node have the same text.
    """
    p, q = share.numerator, share.denominator
    # Of rows with the same text one goes on: a large group of exact copies is one node.
    known = _prefixes(texts, words, share, _frequent(texts, words)).dropDuplicates(["node"])
    known = stored(known)

    # Members of groups: of a component of fingerprints, or of a shingle in the prefix.
    prints = stored(known.select("fp").distinct())
    label = simhash.components(simhash.near_links(prints, prints.count()))
    close = known.join(label, known.fp == label.node, "left").select(
        F.coalesce("label", "fp").alias("group"), known["node"], "n", "rare", F.lit(0).alias("at")
    )
    spread = known.select(F.posexplode("prefix").alias("at", "group"), "node", "n", "rare")

    def with_head(rows: DataFrame) -> DataFrame:
        """The rows of groups of several nodes, each with the group's head.

        That is the text with the smallest share of rare shingles: of a group of edited copies
        the one they were made from, which is closer to all of them than they are to each other.
        """
        same = Window.partitionBy("group")
        both = rows.withColumns(
            {
                "head": F.min(F.struct("rare", "node", "n")).over(same),
                "low": F.min("node").over(same),
                "high": F.max("node").over(same),
            }
        )
        return stored(both.where("low <> high").drop("low", "high", "rare"))

    def candidates(pairs: DataFrame) -> DataFrame:
        """Pairs (a, b) of sizes n and m, one row for each shingle that their prefixes share."""
        must = F.expr(f"least({COMMON}, ceil(greatest(n, m) * {p} / {q}))")
        alike = pairs.where(f"least(n, m) * {q} >= greatest(n, m) * {p}")
        return alike.groupBy("a", "b", "n", "m").count().where(F.col("count") >= must).select("a", "b")

    def confirmed(pairs: DataFrame) -> DataFrame:
        pairs = stored(pairs)
        members = pairs.select(F.col("a").alias("node")).union(pairs.select("b")).distinct()
        chosen = known.join(members, "node", "left_semi").groupBy("node").agg(F.min("key").alias("key"))
        sets = stored(_sets(texts.join(chosen, ["node", "key"], "left_semi"), words))
        return _confirmed(pairs, sets, share)

    shared, by_print = with_head(spread), with_head(close)

    def with_first(rows: DataFrame) -> DataFrame:
        head = [F.col("head.node").alias("a"), F.col("head.n").alias("m")]
        return rows.select(F.col("node").alias("b"), "n", *head).where("a <> b")

    found = confirmed(
        candidates(with_first(shared)).union(with_first(by_print).select("a", "b")).distinct()
    )
    label = simhash.components(found).toDF("node", "label")
    left = shared.join(label, "node", "left").select(
        "group", "node", "n", "at", F.coalesce("label", "node").alias("label")
    )
    # Groups that became one component are done.
    apart = left.groupBy("group").agg(F.min("label").alias("low"), F.max("label").alias("high"))
    left = stored(left.join(apart.where("low <> high").select("group"), "group", "left_semi"))
    # Sets of n and m that agree to s share s / (1 + s) (n + m) shingles or more, so what they share
    # first stands in a short prefix of both. A passage that is most of many texts, but too little
    # to make them alike, lies behind those prefixes, and yields no pair of them.
    small = left.where(f"at < n - ceil(n * {2 * p} / {p + q}) + {COMMON}")
    other = left.select(
        "group",
        F.col("node").alias("b"),
        F.col("n").alias("m"),
        F.col("at").alias("at_b"),
        F.col("label").alias("to"),
    )
    order = (F.col("n") < F.col("m")) | ((F.col("n") == F.col("m")) & (F.col("a") < F.col("b")))
    must = f"ceil((n + m) * {p} / {p + q}) - {COMMON}"
    alike = f"n * {q} >= m * {p} and label <> to and at < n - ({must}) and at_b < m - ({must})"
    rest = small.withColumnRenamed("node", "a").join(other, "group").where(order & F.expr(alike))
    return found.union(confirmed(candidates(rest)))


def one_of_each(docs: DataFrame, words: int = WORDS, share: Fraction = SHARE) -> DataFrame:
    """The rows of the document that stays of each group of copies, with all columns.

    The one with the smallest doc_id stays (missing ids last), of several with that id the one
    with the smallest text hash; of wholly repeated rows one. Texts without a word are copies of
    each other, missing ones among them.
    """
    key, node = unused(docs, "_key"), unused(docs, "_hash")
    low = F.lit(-(1 << 63))
    text = F.coalesce(F.col("text"), F.lit(""))
    keyed = docs.withColumns(
        {key: F.coalesce(F.col("doc_id").cast("long"), low), node: F.xxhash64(text)}
    )
    rows = keyed.select(
        F.col(node).alias("node"),
        F.col("doc_id").cast("long").alias("doc_id"),
        F.col(key).alias("key"),
        text.alias("text"),
    )
    label = simhash.components(links(rows, words, share)).toDF("node", "label")
    order = F.struct(F.col("doc_id").isNull().alias("none"), "key", "node")
    kept = (
        rows.drop("text")
        .join(label, "node", "left")
        .groupBy(F.coalesce("label", "node").alias("group"))
        .agg(F.min(order).alias("first"))
        .select(F.col("first.key").alias(key), F.col("first.node").alias(node))
    )
    return (
        keyed.join(kept.distinct(), [key, node], "left_semi")
        .dropDuplicates([key, node])
        .drop(key, node)
    )
