"""Benchmark decontamination by template windows.

Numbers, names and units become typed placeholders, all other words are lower-cased without
punctuation. A capitalised word is a name, but at the start of a sentence it may be either, so a text
has two templates, and its plain words stand beside them: a window with too few literals for a
template, or of a text whose sentences are cut otherwise, is found by its words. Windows of ``WINDOW`` such tokens of every document are hash-joined to the windows
of the benchmark items. A hit's placeholders bind the item's values to the document's: within one
copy of the item each of its values must stand for one value of the document, and hits that break
the binding with the most support don't count. What remains must cover enough of the item, in any
copy that the document holds.
"""

from __future__ import annotations

from collections import Counter, defaultdict
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trustgate.llm.common import id_and_text, map_texts, texts_of

WINDOW = 8
#: So many covered tokens are a leak of an item of less than twice the length.
SHORTEST = 5
#: A template needs so many literal tokens, so that runs of numbers or names don't match.
LITERALS = 4
#: An item counts as leaked when so many of its tokens are covered, or this share of a short one.
COVERED = 13
SHARE = 0.5
#: Benchmark text that one pass holds in memory; a larger benchmark takes several passes.
PASS_BYTES = 16 << 20
#: A run of hits goes on with one of so many latest chains.
CHAINS = 8
#: Remembered raw words per worker.
REMEMBER = 150_000

# Words that stand for numbers, and units of measure.
NUMBER_WORDS = frozenset(
    "zero one two three four five six seven eight nine ten eleven twelve thirteen fourteen"
    " fifteen sixteen seventeen eighteen nineteen twenty thirty forty fifty sixty seventy eighty"
    " ninety hundred thousand million billion".split()
)
UNITS = frozenset(
    "mm cm m km inch inches foot feet ft yard yards mile miles mg g kg gram grams kilogram"
    " kilograms ounce ounces oz pound pounds lb lbs ton tons ml l liter liters litre litres"
    " second seconds sec s minute minutes min hour hours h day days week weeks month months year"
    " years percent dollar dollars cent cents euro euros usd eur degree degrees meter meters"
    " metre metres kilometer kilometers kilometre kilometres mph kmh watt watts volt volts".split()
)

NUMBER, NAME, UNIT = np.array([1, 2, 3], np.uint64)
F_DROP, F_NUMBER, F_UNIT, F_TITLE, F_END = 1, 2, 4, 8, 16
BASE = np.uint64(0x9E3779B97F4A7C15)
#: Ways to read a text: first words of sentences as literals, as names, and words alone.
KINDS = range(3)


def core_of(raw: bytes) -> str:
    """A raw word without signs at its ends."""
    word = raw.decode()
    if word.isalnum():
        return word
    first, last = 0, len(word)
    while first < last and not word[first].isalnum():
        first += 1
    while last > first and not word[last - 1].isalnum():
        last -= 1
    return word[first:last]


def _traits(raw: bytes) -> tuple[int, int]:
    core = core_of(raw)
    low = core.lower()
    flags = 0
    if not core:
        flags |= F_DROP
    elif core[0].isdigit() and not any(c.isalpha() for c in core) or low in NUMBER_WORDS:
        flags |= F_NUMBER
    elif low in UNITS:
        flags |= F_UNIT
    elif len(core) > 1 and core[0].isupper() and core[1:].islower() and core.isalpha():
        flags |= F_TITLE
    if raw.rstrip(b"\"')]")[-1:] in (b".", b"!", b"?", b":"):
        flags |= F_END
    return xxhash.xxh3_64_intdigest(low.encode()) | 4, flags


class Words(dict):
    """Raw word -> number of its entry in ``hashes`` and ``flags``."""

    def __init__(self):
        super().__init__()
        self.hashes: list[int] = []
        self.flags: list[int] = []

    def __missing__(self, raw: bytes) -> int:
        value, flags = _traits(raw)
        self[raw] = number = len(self.hashes)
        self.hashes.append(value)
        self.flags.append(flags)
        return number


@lru_cache(maxsize=1)
def _words() -> list[Words]:
    return [Words()]


class Templates:
    """Canonical tokens of several texts in a row."""

    def __init__(self, texts: list[str]):
        holder = _words()
        if len(holder[0]) > REMEMBER:
            holder[0] = Words()
        words = holder[0]
        split = [t.encode().split() for t in texts]
        raw = [w for s in split for w in s]
        numbers = np.fromiter(map(words.__getitem__, raw), np.int64, len(raw))
        flags = np.array(words.flags, np.uint8)[numbers] if raw else np.zeros(0, np.uint8)
        of = np.repeat(np.arange(len(texts)), [len(s) for s in split])
        # Dropped words are signs alone; a sentence that they end ends at the word before.
        kept = np.flatnonzero(flags & F_DROP == 0)
        self.raw, self.at, self.of = raw, kept, of[kept]
        flags, numbers = flags[kept], numbers[kept]
        hashes = np.array(words.hashes, np.uint64)[numbers] if raw else np.zeros(0, np.uint64)
        begins = np.ones(len(kept), bool)
        begins[1:] = (self.of[1:] != self.of[:-1]) | (flags[:-1] & F_END > 0)
        fresh = np.ones(len(kept), bool)
        fresh[1:] = self.of[1:] != self.of[:-1]
        number = flags & F_NUMBER > 0
        after_number = np.zeros(len(kept), bool)
        after_number[1:] = number[:-1] & ~fresh[1:]
        unit = (flags & F_UNIT > 0) & after_number
        title = flags & F_TITLE > 0
        self.slots = [number | unit | title & ~begins, number | unit | title]
        self.slots.append(np.zeros(len(kept), bool))
        typed = np.where(number, NUMBER, np.where(unit, UNIT, NAME))
        self.codes = [np.where(slot, typed, hashes) for slot in self.slots]

    def value(self, i: int) -> str:
        return core_of(self.raw[self.at[i]]).lower()

    def windows(self, size: int, kind: int) -> tuple[np.ndarray, np.ndarray]:
        """Places of windows within one text that hold enough literals, and their hashes.

        Windows of a later kind that read like those of the first one are left out.
        """
        codes = self.codes[kind]
        n = len(codes) - size + 1
        if n < 1:
            return np.zeros(0, np.int64), np.zeros(0, np.uint64)
        ok = self.of[:n] == self.of[size - 1 :]
        if kind < 2:
            literal = np.concatenate([[0], np.cumsum(~self.slots[kind])])
            ok &= literal[size:] - literal[:-size] >= min(LITERALS, size)
        if kind:
            other = np.concatenate([[0], np.cumsum(codes != self.codes[0])])
            ok &= other[size:] > other[:-size]
            if not ok.any():
                return np.zeros(0, np.int64), np.zeros(0, np.uint64)
        value = np.zeros(n, np.uint64)
        for i in range(size):
            value = value * BASE + codes[i : i + n]
        value ^= value >> np.uint64(29)
        places = np.flatnonzero(ok)
        return places, value[places]


class Index:
    """Windows of a benchmark by hash, one table for each window length."""

    def __init__(self, items: list[tuple[object, str]]):
        self.ids = [i for i, _ in items]
        self.texts = Templates([t for _, t in items])
        self.first = np.searchsorted(self.texts.of, np.arange(len(items) + 1))
        self.length = np.diff(self.first)
        self.tables: dict[int, tuple[np.ndarray, dict[int, list[int]]]] = {}
        # Items without a window of a template are looked up by their whole template as well.
        windowed = {int(self.texts.of[p]) for k in (0, 1) for p in self.texts.windows(WINDOW, k)[0]}
        whole = {n for i, n in enumerate(self.length.tolist()) if n > WINDOW and i not in windowed}
        sizes = {WINDOW} | {n for n in self.length.tolist() if 0 < n < WINDOW} | whole
        for size in sorted(sizes):
            found: dict[int, list[int]] = defaultdict(list)
            for kind in KINDS if size <= WINDOW else KINDS[:2]:
                places, values = self.texts.windows(size, kind)
                for place, value in zip(places.tolist(), values.tolist(), strict=True):
                    item = self.texts.of[place]
                    if size == WINDOW or (
                        self.length[item] == size and (size < WINDOW or item not in windowed)
                    ):
                        found[value].append(place << 2 | kind)
            # A bit table on the hash's upper bits rules nearly all windows out at once.
            seen = np.zeros(1 << 22, bool)
            if found:
                seen[np.array(list(found), np.uint64) >> np.uint64(42)] = True
                self.tables[size] = (seen, found)

    def leaks(self, texts: list[str]) -> list[tuple[int, object, int, int, int, bool]]:
        """(text number, item id, hits, covered tokens, item tokens, values changed) of leaks."""
        if not self.tables:
            return []
        docs = Templates(texts)
        hits: dict[tuple[int, int], list[tuple[int, int, int, int]]] = defaultdict(list)
        for size, (seen, found) in self.tables.items():
            for kind in KINDS if size <= WINDOW else KINDS[:2]:
                places, values = docs.windows(size, kind)
                maybe = np.flatnonzero(seen[values >> np.uint64(42)])
                for place, value in zip(
                    places[maybe].tolist(), values[maybe].tolist(), strict=True
                ):
                    for entry in found.get(value, ()):
                        own, read = entry >> 2, entry & 3
                        here = docs.codes[kind][place : place + size]
                        if (here == self.texts.codes[read][own : own + size]).all():
                            key = (int(docs.of[place]), int(self.texts.of[own]))
                            hits[key].append((place, own, size, read))
        out = []
        for (text, item), found in hits.items():
            best = None
            for copy in _copies(found):
                kept, changed = self._consistent(docs, copy)
                covered = {i for _, own, size, _ in kept for i in range(own, own + size)}
                # Of copies that cover alike, a verbatim one is reported.
                windows = len({h[:3] for h in kept})
                best = max(best or (0, False, 0), (len(covered), not changed, windows))
            n = int(self.length[item])
            if best[0] >= min(COVERED, n, max(SHORTEST, -(-n * SHARE // 1))):
                out.append((text, self.ids[item], best[2], best[0], n, not best[1]))
        return out

    def _consistent(self, docs: Templates, hits: list[tuple[int, int, int, int]]):
        """The hits whose slots agree with the best-supported value for each value of the item."""
        bound: list[list[tuple[str, str]]] = []
        for place, own, size, read in hits:
            slots = np.flatnonzero(self.texts.slots[read][own : own + size]).tolist()
            bound.append([(self.texts.value(own + i), docs.value(place + i)) for i in slots])
        support = Counter(pair for pairs in bound for pair in pairs)
        there: dict[str, str] = {}
        for a, b in sorted(support, key=lambda p: (-support[p], p)):
            there.setdefault(a, b)
        good = [all(there.get(a) == b for a, b in pairs) for pairs in bound]
        kept = [h for h, ok in zip(hits, good, strict=True) if ok]
        changed = any(
            a != b for pairs, ok in zip(bound, good, strict=True) if ok for a, b in pairs
        )
        return kept, changed


def _copies(hits: list[tuple[int, int, int, int]]) -> list[list[tuple[int, int, int, int]]]:
    """Groups of an item's hits in a document that may be one copy of it.

    A copy without edits has one alignment, document place less item place. One with words added
    or left out is a chain of alignments that goes on in both. All hits together stand for a copy
    whose parts are in any other order.
    """
    runs: dict[int, list[tuple[int, int, int, int]]] = defaultdict(list)
    for hit in sorted(hits):
        runs[hit[0] - hit[1]].append(hit)
    if len(runs) == 1:
        return [hits]
    chains: list[list[tuple[int, int, int, int]]] = []
    for run in sorted(runs.values()):
        for chain in chains[: -CHAINS - 1 : -1]:
            if run[0][1] > chain[-1][1]:
                chain += run
                break
        else:
            chains.append(list(run))
    return [*runs.values(), *chains, hits]


def _passes(benchmark: DataFrame) -> list[list[tuple[object, str]]]:
    """The benchmark's items in parts of at most about PASS_BYTES each.

    The size is checked first; what a part holds is collected and sent to the tasks.
    """
    items = benchmark.where("text is not null").select("item_id", "text")
    size = items.agg(F.sum(F.octet_length("text") + 64)).first()[0] or 0
    parts = max(1, -(-size // PASS_BYTES))
    return [
        [
            tuple(r)
            for r in items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(parts)) == i)
            .dropDuplicates()
            .collect()
        ]
        for i in range(parts)
    ]


@lru_cache(maxsize=2)
def _index(items: tuple[tuple[object, str], ...]) -> Index:
    return Index(list(items))


SCHEMA = (
    "doc_id long, item_id long, n_windows long, covered long, item_tokens long, reparameterised"
    " boolean"
)


def find_leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """One row per document and benchmark item that it holds, verbatim or with other values.

    Missing and empty texts on either side match nothing, and so do items without a letter or
    digit. Where an item has too few literal words for a template, it is found with its own values
    alone; one of fewer than SHORTEST tokens must be there as a whole. Items with the same text are all reported, repeated item rows
    once; repeated documents each get their rows. Further columns are left out. The benchmark is
    taken in parts of bounded size, one pass over the documents each.
    """
    rows = id_and_text(docs)
    found = None
    for items in _passes(benchmark):
        sent = docs.sparkSession.sparkContext.broadcast(tuple(items))

        def make(sent=sent):
            index = _index(sent.value)

            def work(batch: pa.RecordBatch) -> pa.RecordBatch:
                ids = batch.column("doc_id").to_pylist()
                got = [(ids[x[0]], *x[1:]) for x in index.leaks(texts_of(batch))]
                kinds = [pa.int64()] * 5 + [pa.bool_()]
                columns = zip(*got, strict=True) if got else [[]] * 6
                return pa.RecordBatch.from_arrays(
                    [pa.array(list(c), k) for c, k in zip(columns, kinds, strict=True)],
                    names=[c.split()[0] for c in SCHEMA.split(", ")],
                )

            return work

        part = map_texts(rows, make, SCHEMA)
        found = part if found is None else found.union(part)
    return found


def drop_leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows, with all columns, that hold no benchmark item. Missing texts stay."""
    for items in _passes(benchmark):
        sent = docs.sparkSession.sparkContext.broadcast(tuple(items))

        def make(sent=sent):
            index = _index(sent.value)

            def work(batch: pa.RecordBatch) -> pa.RecordBatch:
                leaks = index.leaks([t or "" for t in texts_of(batch)])
                bad = {x[0] for x in leaks}
                return batch.filter(pa.array([i not in bad for i in range(batch.num_rows)]))

            return work

        docs = map_texts(docs, make, docs.schema)
    return docs
