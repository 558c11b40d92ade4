"""Near duplicates by 64-bit SimHash fingerprints, joined on a binary trie.

The join keeps, of all pairs of fingerprints, those within a Hamming budget. A binary trie over
the sorted fingerprints is walked by pairs of nodes: a pair holds the bits in which its two
prefixes differ, its children add one where they take different branches, and a pair over the
budget is dropped with everything below it.

To spread the walk, the bits are cut into ``budget + k`` blocks. Two fingerprints within the
budget agree in at least ``k`` blocks, so the trie is walked below each choice of ``k`` blocks,
among fingerprints that agree there. ``k`` grows with the logarithm of the table, so that such
a cell stays small; every ``k`` finds the same pairs. A cell that is still too large is cut into
its own next trie level: pairs of children within the budget become cells of their own.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trustgate.llm.common import id_and_text, map_texts, stored, unused

BITS = 64
WORDS = 4
SEED = 42
BUDGET = 4
#: Fingerprints that agree on the chosen blocks by chance, on average, at most.
CELL = 64
#: A cell with more fingerprints is cut into children of this many bits, again and again.
LARGE = 1 << 14
CUT_BITS = 5
#: Node pairs and leaf pairs held at once by the walk.
FRONT = 1 << 16
#: Node pairs with at most so many leaf pairs are compared outright.
OUTRIGHT = 32


def fingerprint(text: str, words: int = WORDS) -> int:
    """Majority of the shingles' hash bits, as a signed number; 0 without a word."""
    found = text.encode().lower().split()  # bytes: A-Z alone, and ASCII white space
    if not found:
        return 0
    digest = xxhash.xxh64_intdigest
    last = max(1, len(found) - words + 1)
    each = (digest(b" ".join(found[i : i + words]), SEED) for i in range(last))
    return vote(np.fromiter(each, np.uint64, last))


def vote(hashes: np.ndarray) -> int:
    """The bits that are set in over half of the hashes, as a signed number."""
    votes = np.zeros(BITS, np.int64)
    for first in range(0, len(hashes), 1 << 16):
        some = hashes[first : first + (1 << 16)].astype(">u8")
        votes += np.unpackbits(some.view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int(np.packbits(votes * 2 > len(hashes)).view(">i8")[0])


def fingerprints(docs: DataFrame, words: int = WORDS) -> DataFrame:
    """doc_id and fingerprint ``fp`` (signed 64 bits) of every whole text, and a text hash."""

    def make():
        def work(batch: pa.RecordBatch) -> pa.RecordBatch:
            texts = batch.column("text").to_pylist()
            return pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array([fingerprint(t, words) for t in texts], pa.int64()),
                    batch.column("text_hash"),
                ],
                names=["doc_id", "fp", "text_hash"],
            )

        return work

    rows = id_and_text(docs).withColumn("text_hash", F.xxhash64("text"))
    return map_texts(rows, make, "doc_id long, fp long, text_hash long")


class Forest:
    """Union of array positions; every tree's root is its smallest position."""

    def __init__(self, n: int):
        self.parent = np.arange(n)

    def roots(self, at: np.ndarray) -> np.ndarray:
        found = self.parent[at]
        while True:
            above = self.parent[found]
            if (above == found).all():
                return found
            found = above

    def link(self, a: np.ndarray, b: np.ndarray) -> None:
        while len(a):
            a, b = self.roots(a), self.roots(b)
            apart = a != b
            a, b = a[apart], b[apart]
            np.minimum.at(self.parent, np.maximum(a, b), np.minimum(a, b))


def _pairs(low: np.ndarray, high: np.ndarray, low2: np.ndarray, high2: np.ndarray):
    """Positions of all leaf pairs below node pairs; of a node with itself, each pair once."""
    width = high2 - low2
    number = (high - low) * width
    of = np.repeat(np.arange(len(number)), number)
    step = np.arange(len(of)) - np.repeat(np.cumsum(number) - number, number)
    a, b = low[of] + step // width[of], low2[of] + step % width[of]
    kept = a < b
    return a[kept], b[kept]


def walk(
    fps: np.ndarray,
    nodes: tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray],
    forest: Forest,
    budget: int,
) -> None:
    """Link all pairs within the budget below the given node pairs.

    fps: unsigned, ascending within each node. A node is a range of positions that share their
    leading bits; a node pair is two ranges (equal, or the first wholly before the second).
    """
    start = np.zeros(len(nodes[0]), np.int64)
    stack = [(BITS - 1, *nodes, start)]
    while stack:
        bit, low, high, low2, high2, spent = stack.pop()
        if len(low) > FRONT:
            for part in (slice(FRONT, None), slice(None, FRONT)):
                rest = (low[part], high[part], low2[part], high2[part], spent[part])
                stack.append((bit, *rest))
            continue
        size = (high - low) * (high2 - low2)
        few = (size <= OUTRIGHT) | (bit < 0)
        if few.any():
            chosen = np.flatnonzero(few)
            ends = np.cumsum(size[chosen])
            for group in np.split(chosen, np.flatnonzero(np.diff(ends // (FRONT * 8))) + 1):
                a, b = _pairs(low[group], high[group], low2[group], high2[group])
                near = np.bitwise_count(fps[a] ^ fps[b]) <= budget
                forest.link(a[near], b[near])
            kept = ~few
            low, high, low2, high2, spent = (x[kept] for x in (low, high, low2, high2, spent))
        if not len(low):
            continue
        middle, middle2 = _splits(fps, low, high, bit), _splits(fps, low2, high2, bit)
        same = (low == low2) & (high == high2)
        children = (
            (low, middle, low2, middle2, spent),
            (middle, high, middle2, high2, spent),
            (low, middle, middle2, high2, spent + 1),
            (middle[~same], high[~same], low2[~same], middle2[~same], spent[~same] + 1),
        )
        joined = [np.concatenate(c) for c in zip(*children, strict=True)]
        alive = (joined[1] > joined[0]) & (joined[3] > joined[2]) & (joined[4] <= budget)
        stack.append((bit - 1, *(x[alive] for x in joined)))


def _splits(fps: np.ndarray, low: np.ndarray, high: np.ndarray, bit: int) -> np.ndarray:
    """In each range, the first position whose bit is set (binary search, all ranges at once)."""
    begin, end = low.copy(), high.copy()
    while True:
        open_ = begin < end
        if not open_.any():
            return begin
        middle = (begin + end) >> 1
        at = np.minimum(middle, len(fps) - 1)
        is_set = (fps[at] >> np.uint64(bit)) & np.uint64(1) == 1
        begin = np.where(open_ & ~is_set, middle + 1, begin)
        end = np.where(open_ & is_set, middle, end)


def _blocks(count: int) -> list[tuple[int, int]]:
    """(shift, width) of bit blocks of about one size."""
    edges = [BITS * i // count for i in range(count + 1)]
    return [(a, b - a) for a, b in zip(edges, edges[1:], strict=False)]


def _choose(n: int, budget: int) -> int:
    """Blocks that must agree, so that chance cells hold no more than CELL on average."""
    k = 1
    while k < 6 and n / 2.0 ** (BITS * k // (budget + k)) > CELL:
        k += 1
    return k


def _part(fp: Column, blocks: Iterable[tuple[int, int]]) -> Column:
    mask = 0
    for shift, width in blocks:
        mask |= ((1 << width) - 1) << shift
    return fp.bitwiseAND(F.lit(mask - (1 << BITS) if mask >> 63 else mask))


def _cells(nodes: DataFrame, k: int, budget: int) -> DataFrame:
    """Every fingerprint once for each choice of k agreeing blocks: cell, key, role, fp."""
    blocks = _blocks(budget + k)
    choices = list(combinations(blocks, k))
    keys = F.array(*[_part(F.col("fp"), c) for c in choices])
    return nodes.select("fp", F.posexplode(keys).alias("choice", "key")).select(
        F.col("choice").cast("long"),
        "key",
        F.lit("").alias("trail"),
        F.lit(0).alias("spent"),
        F.lit(-1).alias("role"),
        "fp",
    )


def _cuts(k: int, budget: int) -> list[list[tuple[int, int]]]:
    """For each choice of agreeing blocks, (shift, width) of the cuts of all other bits, in turn."""
    blocks = _blocks(budget + k)
    found = []
    for choice in combinations(blocks, k):
        cuts = []
        for shift, width in reversed([b for b in blocks if b not in choice]):
            for top in range(width, 0, -CUT_BITS):
                low = max(0, top - CUT_BITS)
                cuts.append((shift + low, top - low))
        found.append(cuts)
    return found


def _cut_cells(large: DataFrame, cuts: list[tuple[int, int]], budget: int) -> DataFrame:
    """Cut cells into pairs of children by a few more bits; pairs over the budget are pruned.

    cuts: the bits to look at, for each choice. A cell of a node with itself (role -1) has its
    children's pairs once, smaller prefix first; in a cell of two nodes (roles 0 and 1) the two
    sides meet in all pairs of children.
    """
    shifts = F.array(*[F.lit(s) for s, _ in cuts])
    masks = F.array(*[F.lit((1 << w) - 1) for _, w in cuts])
    at = (F.col("choice") + 1).cast("int")
    spread = (
        large.withColumns({"shift": F.element_at(shifts, at), "mask": F.element_at(masks, at)})
        .withColumn("child", F.expr("cast(shiftrightunsigned(fp, shift) & mask as int)"))
        .withColumn(
            "other",
            F.expr(
                "explode(filter(sequence(0, mask),"
                f" d -> spent + bit_count(child ^ d) <= {int(budget)}))"
            ),
        )
    )
    own = F.col("child")
    alone = F.col("role") == -1
    first = F.when(alone, F.least(own, "other")).when(F.col("role") == 0, own)
    first = first.otherwise(F.col("other"))
    second = F.when(alone, F.greatest(own, "other")).when(F.col("role") == 0, F.col("other"))
    second = second.otherwise(own)
    role = (
        F.when(alone & (own == F.col("other")), -1)
        .when(alone, F.when(own < F.col("other"), 0).otherwise(1))
        .otherwise(F.col("role"))
    )
    return spread.select(
        "choice",
        "key",
        F.concat_ws("/", "trail", F.concat_ws("-", first, second)).alias("trail"),
        F.expr("cast(spent + bit_count(child ^ other) as int)").alias("spent"),
        role.alias("role"),
        "fp",
    )


CELL_KEY = ["choice", "key", "trail"]


def _linked(cells: DataFrame, budget: int) -> DataFrame:
    """Walk the trie of each cell; links that connect all that the walk found near.

    Cells are gathered by hash and ordered, then walked many at a time; no cell spans two of the
    arrays that are walked, and an array holds LARGE fingerprints or one cell.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        size = 0

        def work(ids: np.ndarray, roles: np.ndarray, fps: np.ndarray) -> pa.RecordBatch:
            edges = np.flatnonzero(np.diff(ids)) + 1
            low, high = np.concatenate([[0], edges]), np.concatenate([edges, [len(ids)]])
            alone = roles[low] == -1
            # The rows of a cell of two nodes are ordered by role: role 1 starts at its split.
            ones = np.concatenate([[0], np.cumsum(roles == 1)])
            middle = high - (ones[high] - ones[low])
            both = alone | ((middle > low) & (middle < high))
            nodes = (
                low[both],
                np.where(alone, high, middle)[both],
                np.where(alone, low, middle)[both],
                high[both],
            )
            forest = Forest(len(ids))
            walk(fps, nodes, forest, budget)
            joined = np.flatnonzero(forest.parent != np.arange(len(ids)))
            return pa.RecordBatch.from_arrays(
                [
                    pa.array(fps[joined].view(np.int64)),
                    pa.array(fps[forest.roots(joined)].view(np.int64)),
                ],
                names=["a", "b"],
            )

        def gathered() -> tuple[np.ndarray, ...]:
            return tuple(np.concatenate(x) for x in zip(*held, strict=True))

        for batch in batches:
            part = (
                batch.column("cell").to_numpy(zero_copy_only=False),
                batch.column("role").to_numpy(zero_copy_only=False),
                batch.column("fp").to_numpy(zero_copy_only=False).view(np.uint64),
            )
            held.append(part)
            size += batch.num_rows
            if size >= 4 * LARGE:
                ids, roles, fps = gathered()
                last = int(np.searchsorted(ids == ids[-1], True))
                if last:
                    yield work(ids[:last], roles[:last], fps[:last])
                held, size = [(ids[last:], roles[last:], fps[last:])], len(ids) - last
        if size:
            yield work(*gathered())

    # A cell's number must tell cells apart within a task: two columns of the key and the trail
    # go into the order, their changes into a running number.
    order = [*CELL_KEY, "role", F.col("fp").bitwiseXOR(F.lit(-(1 << 63)))]
    return (
        cells.repartition(*CELL_KEY)
        .sortWithinPartitions(*order)
        .mapInArrow(_numbered, "cell long, role int, fp long")
        .mapInArrow(run, "a long, b long")
    )


def _numbered(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Replace the cell's key by a number that rises by one with each new cell of a task."""
    number, last = 0, None
    for batch in batches:
        if not batch.num_rows:
            continue
        choice = batch.column("choice").to_numpy()
        key = batch.column("key").to_numpy()
        trail = batch.column("trail").dictionary_encode()
        names = trail.dictionary.to_pylist()
        code = trail.indices.to_numpy()
        new = np.ones(batch.num_rows, bool)
        new[1:] = (np.diff(choice) != 0) | (np.diff(key) != 0) | (np.diff(code) != 0)
        new[0] = last != (choice[0], key[0], names[code[0]])
        cells = number + np.cumsum(new)
        number = int(cells[-1])
        last = (choice[-1], key[-1], names[code[-1]])
        yield pa.RecordBatch.from_arrays(
            [pa.array(cells), batch.column("role"), batch.column("fp")],
            names=["cell", "role", "fp"],
        )


def near_links(nodes: DataFrame, n: int, budget: int = BUDGET) -> DataFrame:
    """Links (a > b as found) whose closure is that of all pairs of fps within the budget."""
    k = _choose(n, budget)
    cells = _cells(nodes, k, budget)
    found = None
    cuts = _cuts(k, budget)
    for level in range(min(map(len, cuts))):
        counts = cells.groupBy(*CELL_KEY).agg(
            F.count("*").alias("n"), F.min("role").alias("low"), F.max("role").alias("high")
        )
        # A cell of two nodes with rows of one side alone has no pair.
        paired = (F.col("low") < 0) | (F.col("low") < F.col("high"))
        large = stored(counts.where((F.col("n") > LARGE) & paired).select(*CELL_KEY))
        if large.isEmpty():
            break
        small = cells.join(large, CELL_KEY, "left_anti")
        links = _linked(small, budget)
        found = links if found is None else found.union(links)
        of_large = cells.join(large, CELL_KEY, "left_semi")
        cells = stored(_cut_cells(of_large, [c[level] for c in cuts], budget))
    links = _linked(cells, budget)
    return stored((links if found is None else found.union(links)).distinct())


def components(links: DataFrame) -> DataFrame:
    """node -> label, the smallest node of its component, for all nodes of the links.

    Alternating large-star and small-star steps, each a join and a pre-aggregated minimum, until
    the edges stay the same. All state is in stored tables; the driver sees a count and a sum.
    """
    edges = links.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
    edges = stored(edges.distinct())
    seen = None
    while True:
        check = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if check == seen or not check[0]:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("label"))
        seen = check
        both = edges.union(edges.select(F.col("v"), F.col("u"))).toDF("u", "v")
        least = both.groupBy("u").agg(F.min("v").alias("m"))
        least = least.select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.where("u <> v").distinct()
        down = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (
            large.join(down, "u")
            .select(F.col("v").alias("u"), F.col("m").alias("v"))
            .union(down.select("u", "m"))
            .where("u <> v")
            .distinct()
        )
        edges = stored(small)


def near_duplicates(docs: DataFrame, words: int = WORDS, budget: int = BUDGET) -> DataFrame:
    """doc_id, fp, text_hash and component_id of every row.

    component_id is the smallest doc_id reachable over fingerprints that differ in at most
    ``budget`` bits. Texts without a word, missing ones among them, have fingerprint zero and
    are linked like any other. Rows with a missing doc_id take part, but never name a component;
    one of only such rows has none. Repeated rows are one fingerprint; further columns are left
    out, and an empty table gives an empty result.
    """
    rows = stored(fingerprints(docs, words))
    nodes = stored(rows.groupBy("fp").agg(F.min("doc_id").alias("first")))
    n = nodes.count()
    labels = components(near_links(nodes.select("fp"), n, budget))
    named = nodes.join(labels, nodes.fp == labels.node, "left").select(
        "fp", "first", F.coalesce("label", "fp").alias("label")
    )
    names = named.groupBy("label").agg(F.min("first").alias("component_id"))
    of = named.join(names, "label").select("fp", "component_id")
    return rows.join(of, "fp").select("doc_id", "fp", "text_hash", "component_id")


def one_of_each(docs: DataFrame, words: int = WORDS, budget: int = BUDGET) -> DataFrame:
    """The rows of the document that stays of each component, with all columns.

    The one with the smallest doc_id stays (missing ids last), of several with that id the one
    with the smallest text hash; of wholly repeated rows one.
    """
    found = near_duplicates(docs, words, budget)
    order = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_hash")
    # A component without any id keeps one row of each fingerprint.
    group = [F.col("component_id"), F.when(F.col("component_id").isNull(), F.col("fp"))]
    kept = found.groupBy(*group).agg(F.min(order).alias("first")).select("first.*")
    low = F.lit(-(1 << 63))
    key, mark = unused(docs, "_key"), unused(docs, "_hash")
    kept = kept.select(F.coalesce("doc_id", low).alias(key), F.col("text_hash").alias(mark))
    keyed = docs.withColumns(
        {
            key: F.coalesce(F.col("doc_id").cast("long"), low),
            mark: F.xxhash64(F.coalesce(F.col("text"), F.lit(""))),
        }
    )
    return (
        keyed.join(kept.distinct(), [key, mark], "left_semi")
        .dropDuplicates([key, mark])
        .drop(key, mark)
    )
