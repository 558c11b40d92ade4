"""Periodic runs of words by the branching-tandem test on an enhanced suffix array.

A run with smallest period q ends in a square whose halves part right after it: its two places
have exactly q words in common, so they lie in different children of an LCP interval of depth q.
For each interval it is enough to try the suffixes of the smaller child: for a suffix at i and
depth d, is ISA[i + d] or ISA[i - d] in the other child? Intervals are taken as splits between
neighbours of the suffix array, found by nearest smaller LCP values; there are no tree nodes, and
halving the smaller side each time bounds the tries by n log n. A square found is rotated to the
left as long as the word before equals the word a period later; squares with the same stretch are
one run, whose period is the smallest.

Runs count from ``LEAST`` words on, so with a period below four they hold a square of depth four,
five or six as well; intervals of lower depth need no test. Only suffixes whose first four words
occur twice in their document are therefore sorted, by prefix doubling, whose ranks also give
the common lengths. Documents of a slice are worked on together; a word counts per document, so
that suffixes of different documents part at once.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trustgate.llm.common import map_texts

#: Words of the shortest run.
LEAST = 12
#: Depth from which intervals are tested; 2 ** 2, as ranks double.
DEPTH = 4
#: Suffixes tried at once.
TRIES = 1 << 20
#: Text bytes sorted together; a longer text is sorted alone.
SORT_BYTES = 2 << 20


def _dense(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    """Ranks of pairs, from 0 without gaps."""
    key = first.astype(np.int64) * (int(second.max(initial=0)) + 1) + second
    return np.unique(key, return_inverse=True)[1].astype(np.int32)


def _shifted(rank: np.ndarray, by: int) -> np.ndarray:
    """The rank of the suffix ``by`` words later; past the end lies rank 0, behind an end mark."""
    out = np.zeros_like(rank)
    out[: max(0, len(rank) - by)] = rank[by:]
    return out


def ranks(words: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
    """Places whose first DEPTH words recur, in suffix order, and ranks by 1, 2, 4 ... words.

    words: numbers of words, in which each document's end is a number of its own. A rank is the
    same for two places exactly if as many words from there on are.
    """
    levels = [words.astype(np.int32)]
    while 1 << (len(levels) - 1) < DEPTH:
        levels.append(_dense(levels[-1], _shifted(levels[-1], 1 << (len(levels) - 1))))
    # From here on a rank is the place of its first suffix in the order, which later ones refine.
    dense = levels[-1]
    sizes = np.bincount(dense)
    rank = levels[-1] = (np.cumsum(sizes) - sizes).astype(np.int32)[dense]
    live = np.flatnonzero(sizes[dense] > 1)
    chosen, length = live, DEPTH
    while len(live):
        group, after = rank[live], rank[live + length]
        at = np.lexsort((after, group))
        live, group, after = live[at], group[at], after[at]
        new = np.ones(len(live), bool)
        new[1:] = group[1:] != group[:-1]
        place = np.arange(len(live))
        old_start = np.maximum.accumulate(np.where(new, place, 0))
        new[1:] |= after[1:] != after[:-1]
        start = np.maximum.accumulate(np.where(new, place, 0))
        rank = rank.copy()
        rank[live] = group + (start - old_start)
        levels.append(rank)
        length *= 2
        alone = new & np.append(new[1:], True)
        live = live[~alone]
    return chosen[np.argsort(rank[chosen], kind="stable")], levels


def _common(a: np.ndarray, b: np.ndarray, levels: list[np.ndarray]) -> np.ndarray:
    """Words that the suffixes at a and b have in common."""
    length = np.zeros(len(a), np.int64)
    for k in range(len(levels) - 1, -1, -1):
        length += (levels[k][a + length] == levels[k][b + length]).astype(np.int64) << k
    return length


def _common_before(a: np.ndarray, b: np.ndarray, levels: list[np.ndarray]) -> np.ndarray:
    """Words that agree right before a and b, where a is the smaller place."""
    length = np.zeros(len(a), np.int64)
    for k in range(len(levels) - 1, -1, -1):
        start = a - length - (1 << k)
        inside = np.maximum(start, 0)
        same = (start >= 0) & (levels[k][inside] == levels[k][inside + (b - a)])
        length += same.astype(np.int64) << k
    return length


def _splits(lcp: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Splits of LCP intervals: where the left side begins, the split, where the right one ends.

    lcp[r] belongs to the suffixes r - 1 and r. The left side reaches back to the nearest smaller
    value, the right one on to the nearest that isn't larger.
    """
    begins, places, ends = [], [], []
    stack: list[tuple[int, int, int]] = []
    rows = np.flatnonzero(lcp >= DEPTH)
    last = -1
    for r, depth in zip(rows.tolist(), lcp[rows].tolist(), strict=True):
        if r != last + 1:
            for d, at, begin in stack:
                begins.append(begin), places.append(at), ends.append(last + 1)
            stack = []
        begin = r - 1
        while stack and stack[-1][0] >= depth:
            d, at, b = stack.pop()
            begins.append(b), places.append(at), ends.append(r)
            begin = b
        stack.append((depth, r, begin))
        last = r
    for _, at, begin in stack:
        begins.append(begin), places.append(at), ends.append(last + 1)
    return np.array(begins, np.int64), np.array(places, np.int64), np.array(ends, np.int64)


def _chunks(sizes: np.ndarray) -> Iterator[slice]:
    """Slices of rows whose sizes sum up to TRIES, or one larger row."""
    ends = np.cumsum(sizes)
    at = 0
    while at < len(sizes):
        done = ends[at - 1] if at else 0
        to = max(at + 1, int(np.searchsorted(ends, done + TRIES, side="right")))
        yield slice(at, to)
        at = to


def squares(words: np.ndarray, levels: list[np.ndarray], order: np.ndarray):
    """Starts and periods of the squares whose halves part right after them."""
    none = np.zeros(0, np.int64)
    if not len(order):
        return none, none
    lcp = np.zeros(len(order), np.int64)
    lcp[1:] = _common(order[:-1], order[1:], levels)
    place_of = np.full(len(words), -1, np.int64)
    place_of[order] = np.arange(len(order))
    begin, split, end = _splits(lcp)
    left_small = split - begin <= end - split
    low, size = np.where(left_small, begin, split), np.where(left_small, split - begin, end - split)
    other = np.where(left_small, split, begin), np.where(left_small, end, split)
    starts, periods = [none], [none]
    for some in _chunks(size):
        n = size[some]
        row = np.repeat(np.arange(some.start, some.stop), n)
        within = np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)
        at, depth = order[low[row] + within], lcp[split[row]]
        for first, second in ((at, at + depth), (at - depth, at)):
            tried = second if first is at else first
            inside = (tried >= 0) & (tried < len(words))
            place = np.where(inside, place_of[np.where(inside, tried, 0)], -1)
            hit = (place >= other[0][row]) & (place < other[1][row])
            starts.append(first[hit])
            periods.append(depth[hit])
    return np.concatenate(starts), np.concatenate(periods)


def runs_of(words: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, length and period of all runs of LEAST words or more, by start, then period."""
    order, levels = ranks(words)
    at, period = squares(words, levels, order)
    begin = at - _common_before(at, at + period, levels)
    end = at + 2 * period
    keep = end - begin >= LEAST
    begin, end, period = begin[keep], end[keep], period[keep]
    by = np.lexsort((period, end, begin))
    begin, end, period = begin[by], end[by], period[by]
    first = np.ones(len(by), bool)
    first[1:] = (begin[1:] != begin[:-1]) | (end[1:] != end[:-1])
    begin, end, period = begin[first], end[first], period[first]
    # A period of one to three words was found as four, five or six.
    for small in range(DEPTH - 1, 0, -1):
        fits = (period < 2 * DEPTH - 1) & (period % small == 0) & (period > small)
        for k in range(2 * DEPTH - 2):
            place = np.minimum(begin + k, end - 1 - small)
            fits &= words[place] == words[place + small]
        period = np.where(fits, small, period)
    by = np.lexsort((period, begin))
    return begin[by], (end - begin)[by], period[by]


def _numbers(documents: list[list[bytes]]) -> np.ndarray:
    """Words of all documents as numbers, alike only within a document, each with an end mark."""
    known: dict[bytes, int] = {}
    flat = [known.setdefault(w, len(known)) for doc in documents for w in doc]
    sizes = np.array([len(d) for d in documents], np.int64)
    bounds = np.cumsum(sizes + 1)
    out = np.full(int(bounds[-1]) if len(bounds) else 0, -1, np.int64)
    of = np.repeat(np.arange(len(documents)), sizes)
    out[np.arange(len(flat)) + of] = np.array(flat, np.int64)
    doc = np.repeat(np.arange(len(documents)), sizes + 1)
    return _dense(doc, out + 1)


def _work(batch: pa.RecordBatch) -> pa.RecordBatch:
    documents = [(t or "").encode().split() for t in batch.column("text").to_pylist()]
    words = _numbers(documents)
    begin, length, period = runs_of(words)
    sizes = np.array([len(d) + 1 for d in documents], np.int64)
    firsts = np.cumsum(sizes) - sizes
    of = np.searchsorted(firsts, begin, side="right") - 1
    ends = np.searchsorted(of, np.arange(len(documents) + 1))
    # A word goes if a run holds it after the run's first period.
    depth = np.zeros(len(words) + 1, np.int64)
    np.add.at(depth, begin + period, 1)
    np.add.at(depth, begin + length, -1)
    gone = np.cumsum(depth) > 0
    start = begin - firsts[of]
    texts = []
    for i, doc in enumerate(documents):
        if ends[i] < ends[i + 1]:
            drop = gone[firsts[i] : firsts[i] + len(doc)].tolist()
            doc = [w for w, d in zip(doc, drop, strict=True) if not d]
        texts.append(b" ".join(doc).decode())
    offsets = pa.array(ends, pa.int32())
    found = pa.StructArray.from_arrays(
        [pa.array(x, pa.int64()) for x in (start, length, period)],
        names=["start", "length", "period"],
    )
    return pa.RecordBatch.from_arrays(
        [
            batch.column("doc_id"),
            pa.ListArray.from_arrays(offsets, found),
            pa.array(texts, pa.string()),
        ],
        names=["doc_id", "runs", "collapsed"],
    )


SCHEMA = (
    "doc_id long, runs array<struct<start:long,length:long,period:long>>, collapsed string"
)


def find_runs(docs: DataFrame) -> DataFrame:
    """Per document: doc_id, its runs (by start, then period) and the text without repeats.

    A run is a stretch of at least LEAST words and two periods that no neighbouring word extends.
    ``collapsed`` holds the words that no run holds after its first period, joined by one space.
    Missing and empty texts have no words, no runs and an empty ``collapsed``; repeated rows
    are worked on alike, further columns are left out, an empty table has no rows. A document is
    sorted in one task, in memory that grows with its words (about 100 bytes a word, and 4 more for
    each doubling of its longest repeat).
    """
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")

    def make() -> Callable[[pa.RecordBatch], pa.RecordBatch]:
        return _work

    return map_texts(texts, make, SCHEMA, SORT_BYTES)


def planted(docs: DataFrame) -> DataFrame:
    """doc_id and text; by the checksum of the id, a tenth of the texts is made periodic.

    With h the checksum of the decimal doc_id (empty for a missing one), g = h div 10 and n words:
    where 10 divides h, each word from a = g mod n on becomes word a + (i - a) mod p, with
    p = 1 + (n - a) div (3 + g mod 8).
    """
    h = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary"))
    split = F.split(F.coalesce(F.col("text"), F.lit("")), "[\\x20\\x09-\\x0D]+")
    # A column of its own: inside the function below it would be split anew for each word.
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        "text",
        F.floor(h / 10).cast("long").alias("g"),
        F.when(h % 10 == 0, F.filter(split, lambda w: w != "")).alias("words"),
    )
    g, n = F.col("g"), F.greatest(F.size("words"), F.lit(1))
    a = (g % n).cast("int")
    p = (F.floor((n - a) / (3 + g % 8)) + 1).cast("int")
    placed = rows.withColumns({"n": n, "a": a, "p": p})

    def word(i: Column) -> Column:
        a = F.col("a")
        return F.get("words", F.when(i < a, i).otherwise(a + (i - a) % F.col("p")))

    periodic = F.array_join(F.transform(F.sequence(F.lit(0), F.col("n") - 1), word), " ")
    text = F.when(F.size("words") > 0, periodic).otherwise(F.col("text"))
    return placed.select("doc_id", text.alias("text"))


def run_digests(found: DataFrame) -> DataFrame:
    """Per document of ``find_runs``: the number of runs, the longest one, and digests."""
    runs = F.col("runs")
    # Greatest length first, then smallest start, then period.
    best = F.array_max(
        F.transform(
            runs,
            lambda r: F.struct(
                r["length"].alias("length"), (-r["start"]).alias("start"), (-r["period"]).alias("period")
            ),
        )
    )
    line = F.transform(
        runs, lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n"))
    )
    return found.withColumn("_best", best).select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        (-F.col("_best.start")).alias("start"),
        F.col("_best.length").alias("length"),
        (-F.col("_best.period")).alias("period"),
        F.expr("1000 * _best.length div -_best.period").alias("exponent_milli"),
        F.sha2(F.array_join(line, "").cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
    )
