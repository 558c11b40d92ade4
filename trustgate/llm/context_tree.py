"""Language-model scores: context-tree weighting over bytes, beside a word unigram base.

Each byte is eight binary decisions, first bit first. A decision counts zeros and ones in each of
its contexts: no byte before, the last byte, the last two, and so on to the start of the text.
A context's Krichevsky-Trofimov estimate is mixed with the product of the longer contexts below
it, half and half at every depth without a bound, which gives each context the weight of stopping
there. A text's score is the sum over its bytes, and an end mark, of the mixed prediction.

Documents lie in slices. Level 0 sends every place of a text with the last ``FIRST`` bytes
before it to the part of the tree that these bytes begin with (`borders` cuts the tree so that
parts have about ``PART`` places). Each part is sorted once and stored in that order. Places
whose contexts are still equal to others there, and could still be told apart, go on to the next
level with the bytes from there to the next depth, grouped by the context they share; and so on
until none is left (`context_fold` says when what is deeper can't change a sum any more). Then
levels are folded from the deepest up, and parts into one tree per last byte and the root;
predictions come down the same way. The driver holds the borders, and 255 numbers for each last
byte.

The unigram base needs the corpus count of every word of every text. Documents are taken in
slices of bounded size; a slice sends each of its distinct words once, the words' totals come
back to the slice, and its documents are summed there. So a frequent word is one row a slice.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Callable, Iterable, Iterator
from itertools import count

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from trustgate.llm.common import id_and_text, stored
from trustgate.llm.context_fold import Fold, Level, equal_bytes

#: A byte that UTF-8 never has: what lies before a text, and the mark after it.
EDGE = 0xFF
#: Depth of contexts at level 0; each further level goes to GROWTH times the depth.
FIRST, GROWTH = 16, 4
#: Places that a part of the tree holds, about.
PART = 100_000
#: Places that are folded together, about: their decisions should fit a processor's cache.
STRETCH = 24_000
#: Text bytes whose places are sent together.
TEXT_BYTES = 2 << 20
#: Places sent at once.
SENT_PLACES = 1 << 20
#: With this set Spark removes a query's exchange files when it ends.
CLEAN_UP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
#: Text bytes of a slice; a longer text is a slice of its own.
SLICE_BYTES = 4 << 20
#: Added to every count of the unigram base.
ADDED = 0.1
#: A word's number in its slice and its total share 63 bits.
TOTAL_BITS = 41


def held_out(doc_id: Column) -> Column:
    """One in ten ids; a missing id has the checksum of the empty text and is held out."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 10 == 0


TEXTS = "slice string, data binary, starts binary, held binary, keys binary, marks binary"
_TEXTS = pa.schema(
    [("slice", pa.string())]
    + [(c, pa.binary()) for c in ("data", "starts", "held", "keys", "marks")]
)


def _texts(rows: DataFrame) -> DataFrame:
    """Slices of lower-cased texts, each with its end mark, and where they start."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, number = TaskContext.get().partitionId(), 0
        texts, others, size = [], [], 0

        def close() -> pa.RecordBatch:
            starts = np.cumsum([0] + [len(t) for t in texts[:-1]])
            held, keys, marks = zip(*others)
            row = {
                "slice": f"{part}-{number}",
                "data": b"".join(texts),
                "starts": starts.astype("<i8").tobytes(),
                "held": np.array(held, np.uint8).tobytes(),
                "keys": np.array(keys, "<i8").tobytes(),
                "marks": np.array(marks, "<i8").tobytes(),
            }
            return pa.RecordBatch.from_pylist([row], _TEXTS)

        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in ("text", "held", "key", "mark")]
            for text, *other in zip(*columns):
                raw = text.encode().lower() + bytes([EDGE])
                if texts and size + len(raw) > TEXT_BYTES:
                    yield close()
                    texts, others, size = [], [], 0
                    number += 1
                texts.append(raw)
                others.append(other)
                size += len(raw)
        if texts:
            yield close()

    return rows.mapInArrow(run, TEXTS)


_PAST = np.array([(1 << (8 * (8 - i))) - 1 for i in range(9)], np.uint64)


class Places:
    """The contexts of a slice's places."""

    def __init__(self, data: bytes, starts: bytes, deepest: int):
        starts = np.frombuffer(starts, "<i8")
        self.pad = deepest
        raw = np.frombuffer(b"\xff" * deepest + data, np.uint8)
        self.raw = raw[deepest:]
        self.words = np.zeros(len(raw) - 7, np.uint64)
        for i in range(8):
            self.words[i::8] = raw[i : i + (len(raw) - i) // 8 * 8].view("<u8")
        lengths = np.diff(np.append(starts, len(data)))
        self.of = np.repeat(np.arange(len(starts)), lengths)
        self.behind = np.arange(len(data)) - starts[self.of]

    def word(self, places: np.ndarray, k: int) -> np.ndarray:
        """Bytes 8 k + 1 to 8 k + 8 before each place, the nearest first; EDGE before a text."""
        known = np.clip(self.behind[places] - 8 * k, 0, 8)
        return self.words[places + self.pad - 8 * (k + 1)] | _PAST[known]


class Borders:
    """Contexts that make up the tree: where they begin as two words of eight bytes, their depths,
    and the part each is in."""

    def __init__(self, found: list[tuple[int, int, int, int]]):
        found = sorted(found)
        self.begin = np.array([f[:2] for f in found], np.uint64).reshape(-1, 2).T
        self.depth = np.array([f[2] for f in found], np.int64)
        n = np.array([f[3] for f in found], np.int64)
        self.part = (np.cumsum(n) - n) // PART
        # Borders deeper than a word are found by the number of their first word and the rank of
        # their second.
        self.heads, self.first, head = np.unique(
            self.begin[0], return_index=True, return_inverse=True
        )
        self.long = np.flatnonzero(self.depth > 8)
        self.seconds = np.unique(self.begin[1][self.long])
        rank = np.searchsorted(self.seconds, self.begin[1][self.long], "right")
        self.pairs = head[self.long] * (len(self.seconds) + 1) + rank

    def of(self, words: np.ndarray) -> np.ndarray:
        """The border that each pair of words lies behind."""
        head = np.searchsorted(self.heads, words[0], "right") - 1
        name = self.first[head]
        at = np.flatnonzero(self.depth[name] > 8)
        rank = np.searchsorted(self.seconds, words[1][at], "right")
        pair = head[at] * (len(self.seconds) + 1) + rank
        name[at] = self.long[np.searchsorted(self.pairs, pair, "right") - 1]
        return name


def _among(words: tuple[np.ndarray, np.ndarray], opened: list[tuple[int, int]]) -> np.ndarray:
    """Which pairs of words are among the given ones."""
    given = np.array(opened, np.uint64).T
    keys = [np.unique(g) for g in given]
    at = [np.minimum(np.searchsorted(k, w), len(k) - 1) for k, w in zip(keys, words)]
    known = [np.searchsorted(k, g) for k, g in zip(keys, given)]
    wide = len(keys[1])
    found = np.isin(at[0] * wide + at[1], known[0] * wide + known[1])
    return found & (keys[0][at[0]] == words[0]) & (keys[1][at[1]] == words[1])


def _cut(words: tuple[np.ndarray, np.ndarray], depth: int) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of words with the bytes behind a depth set to zero."""
    kept = [max(0, min(8, depth - 8 * k)) for k in range(2)]
    masks = [((1 << 64) - 1) ^ ((1 << (64 - 8 * i)) - 1) for i in kept]
    return tuple(w & np.uint64(m) for w, m in zip(words, masks))


def borders(texts: DataFrame) -> Borders:
    """Contexts of two bytes, and of a byte more while they have over PART places, to FIRST."""
    found, opened = [], []
    for depth in range(2, FIRST + 1):

        def run(batches, depth=depth, opened=opened):
            for batch in batches:
                for data, starts in zip(batch.column("data"), batch.column("starts")):
                    places = Places(data.as_py(), starts.as_py(), FIRST)
                    at = np.arange(len(places.raw))
                    words = places.word(at, 0), places.word(at, 1)
                    if opened:
                        at = np.flatnonzero(_among(_cut(words, depth - 1), opened))
                        words = words[0][at], words[1][at]
                    key, more = _cut(words, depth)
                    order = np.lexsort((more, key))
                    key, more = key[order], more[order]
                    new = (key[1:] != key[:-1]) | (more[1:] != more[:-1])
                    begin = np.flatnonzero(np.append(len(key) > 0, new)) if len(key) else order
                    n = np.diff(np.append(begin, len(key)))
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(key[begin].view(np.int64)),
                            pa.array(more[begin].view(np.int64)),
                            pa.array(n, pa.int64()),
                        ],
                        names=["key", "more", "n"],
                    )

        counts = texts.select("data", "starts").mapInArrow(run, "key long, more long, n long")
        rows = counts.groupBy("key", "more").agg(F.sum("n").alias("n")).collect()
        rows = [(r.key % (1 << 64), r.more % (1 << 64), depth, r.n) for r in rows]
        found += [r for r in rows if r[3] <= PART or depth == FIRST]
        opened = [r[:2] for r in rows if r[3] > PART]
        if not opened:
            break
    return Borders(found)


#: What goes to a part of a level: places of a slice, later those of the part in order (kind 0),
#: what the next level found (1) and what the one above predicts (2). Scores of places (3) and
#: places of open contexts (4) go to slices. ``names`` are contexts, ``lows`` bytes or decisions;
#: of a part's places ``x`` says how many slices lie before that of each, ``y`` the bytes shared.
SENT = (
    "part long, kind int, slice string, names binary, places binary, lows binary,"
    " x binary, y binary"
)
_SENT = pa.schema(
    [("part", pa.int64()), ("kind", pa.int32()), ("slice", pa.string())]
    + [(c, pa.binary()) for c in ("names", "places", "lows", "x", "y")]
)


def _split(part: np.ndarray, kind: int, name: str, **columns: np.ndarray) -> pa.RecordBatch:
    """One row for each part, with its values of the columns; an empty column is left out."""
    order = np.argsort(part, kind="stable")
    part = part[order]
    begins = np.flatnonzero(np.append(True, part[1:] != part[:-1])) if len(part) else part
    ends = np.append(begins[1:], len(part))
    arrays = {
        "part": pa.array(part[begins], pa.int64()),
        "kind": pa.array([kind] * len(begins), pa.int32()),
        "slice": pa.array([name] * len(begins), pa.string()),
    }
    for c, values in columns.items():
        if not len(values):
            continue
        values = values[order]
        arrays[c] = pa.array(
            [values[i:j].tobytes() for i, j in zip(begins, ends)], pa.binary()
        )
    none = pa.nulls(len(begins), pa.binary())
    return pa.RecordBatch.from_arrays(
        [arrays.get(f.name, none) for f in _SENT], schema=_SENT
    )


def _at_level(level: int) -> tuple[int, int]:
    return (FIRST * GROWTH ** (level - 1) if level else 0), FIRST * GROWTH**level


def _part_of(names: np.ndarray, parts: int) -> np.ndarray:
    """The part of an open context at the next level."""
    mixed = names.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    return ((mixed >> np.uint64(33)) % np.uint64(parts)).astype(np.int64)


def _send(
    places: Places, at, held, names, part, low: int, high: int, name: str
) -> pa.RecordBatch:
    words = np.stack([places.word(at, k) for k in range(low // 8, high // 8)], axis=1)
    learned = (held[places.of[at]] == 0).astype(np.int64)
    return _split(
        part,
        0,
        name,
        names=names.astype("<i8") if low else names[:0],
        places=(at << 1 | learned).astype("<u4"),
        lows=places.raw[at],
        x=words,
    )


def _sent_first(texts: DataFrame, cut: Borders) -> DataFrame:
    """Level 0: all places, by the borders."""
    low, high = _at_level(0)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                places = Places(row["data"], row["starts"], high)
                held = np.frombuffer(row["held"], np.uint8)
                n = len(places.raw)
                for at in np.array_split(np.arange(n), n // SENT_PLACES + 1):
                    # In order, what lies together is alike and takes less room.
                    at = at[np.argsort(places.word(at, 0), kind="stable")]
                    name = cut.of((places.word(at, 0), places.word(at, 1)))
                    yield _send(
                        places, at, held, name, cut.part[name], low, high, row["slice"]
                    )

    return texts.mapInArrow(run, SENT)


def _sent_on(texts: DataFrame, asked: DataFrame, level: int, parts: int) -> DataFrame:
    """A further level: the places asked for, by the context they share."""
    low, high = _at_level(level)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                places = Places(row["data"], row["starts"], high)
                held = np.frombuffer(row["held"], np.uint8)
                at = np.frombuffer(b"".join(a["places"] for a in row["asked"]), "<u4")
                at = at.astype(np.int64)
                names = np.frombuffer(b"".join(a["names"] for a in row["asked"]), "<i8")
                step = max(1, (32 << 20) // (high - low))
                for i in range(0, len(at), step):
                    one, name = at[i : i + step], names[i : i + step]
                    part = _part_of(name, parts)
                    yield _send(places, one, held, name, part, low, high, row["slice"])

    lists = asked.groupBy("slice").agg(F.collect_list(F.struct("places", "names")).alias("asked"))
    return texts.join(lists, "slice").mapInArrow(run, SENT)


def _arranged(level: int, cut: Borders | None) -> Callable:
    """A part's places in the order of their contexts, and by slice those of open contexts."""
    low, high = _at_level(level)

    def work(rows: list[dict]) -> Iterator[pa.RecordBatch]:
        number = rows[0]["part"]
        of = np.repeat(np.arange(len(rows)), [len(r["lows"]) for r in rows])
        places = _Part._all(rows, "places", "<u4")
        words = _Part._all(rows, "x", "<u8").reshape(-1, (high - low) // 8).T
        names = cut.of(words) if cut else _Part._all(rows, "names", "<i8")
        symbols = _Part._all(rows, "lows", np.uint8)
        order, shared, opens = Level.sort(names, words, symbols, (places & 1) == 1, low, high)
        of, places, names = of[order], places[order], names[order]
        slices = [r["slice"] for r in rows]
        row = {
            "part": number,
            "kind": 0,
            "slice": ",".join(slices),
            "names": names[shared < 0].astype("<i8").tobytes(),
            "places": places.tobytes(),
            "lows": symbols[order].tobytes(),
            "x": of.astype(_of_as(len(rows))).tobytes(),
            "y": (shared << 1 | opens).astype(_shared_as(level)).tobytes(),
        }
        yield pa.RecordBatch.from_pylist([row], _SENT)
        at = np.flatnonzero(opens)
        context = np.cumsum(opens & (shared < high - low))[at] - 1
        for batch in _split(
            of[at],
            4,
            "",
            names=number << 32 | context.astype(np.int64),
            places=places[at] >> 1,
        ).to_pylist():
            name = slices[batch["part"]]
            yield pa.RecordBatch.from_pylist([batch | {"part": number, "slice": name}], _SENT)

    return work


def _shared_as(level: int) -> str:
    """What holds twice the bytes that a level's contexts can share, and one."""
    most = 2 * _at_level(level)[1] + 1
    return "<i1" if most < 1 << 7 else "<i2" if most < 1 << 15 else "<i4"


def _of_as(slices: int) -> str:
    return "<u2" if slices <= 1 << 16 else "<u4"


class _Part:
    """The rows that came to a part, as a level to fold."""

    def __init__(self, rows: list[dict], level: int, cut: Borders | None):
        self.number = rows[0]["part"]
        low, high = _at_level(level)
        (own,) = (r for r in rows if r["kind"] == 0)
        self.slices = own["slice"].split(",")
        self.of = np.frombuffer(own["x"], _of_as(len(self.slices)))
        places = np.frombuffer(own["places"], "<u4")
        self.places = places >> 1
        shared = np.frombuffer(own["y"], _shared_as(level)).astype(np.int64)
        opens, shared = (shared & 1) == 1, shared >> 1
        names = np.frombuffer(own["names"], "<i8")[np.cumsum(shared < 0) - 1]
        root = cut.depth[names] if cut else np.full(len(names), low)
        symbols = np.frombuffer(own["lows"], np.uint8)
        opened = np.where(opens, np.cumsum(opens & (shared < high - low)) - 1, -1)
        self.columns = names, shared, symbols, (places & 1) == 1, opened
        self.root, self.reach = root, (low, high)
        self.values = {k: self._given(rows, k) for k in (1, 2)}

    def levels(self) -> Iterator[tuple[Level, Fold]]:
        """The part by stretches of whole groups, folded."""
        begins = np.flatnonzero(self.columns[1] < 0)
        cuts = begins[np.flatnonzero(np.diff(begins // STRETCH, prepend=0))].tolist()
        for i, j in zip([0, *cuts], [*cuts, len(self.root)]):
            at = slice(i, j)
            level = Level(*(c[at] for c in self.columns), *self.reach, self.root[at])
            level.expand()
            numbers, decisions = level.keys()
            found, value = self.given(1, numbers, decisions)
            if not found.all():
                raise ValueError("a deeper level left out a context")
            yield level, level.fold(value)

    @staticmethod
    def _all(rows: list[dict], column: str, kind) -> np.ndarray:
        return np.frombuffer(b"".join(r[column] or b"" for r in rows), kind)

    def names(self, numbers: np.ndarray) -> np.ndarray:
        """Names of open contexts, by their numbers in this part."""
        return self.number << 32 | numbers.astype(np.int64)

    @classmethod
    def _given(cls, rows: list[dict], kind: int) -> list[np.ndarray]:
        rows = [r for r in rows if r["kind"] == kind]
        key = cls._all(rows, "names", "<i8") << 8 | cls._all(rows, "lows", np.uint8)
        order = np.argsort(key)
        values = [cls._all(rows, c, "<f8") for c in ("x", "y")[:kind]]
        return [np.append(key[order], -1), *(np.append(v[order], 0.0) for v in values)]

    def given(self, kind: int, names, decisions) -> list[np.ndarray]:
        """Whether contexts were given values of a kind, and these."""
        key, *values = self.values[kind]
        wanted = names << 8 | decisions
        at = np.searchsorted(key[:-1], wanted)
        found = key[at] == wanted
        return [found, *(v[np.where(found, at, len(key) - 1)] for v in values)]


def _joined(parts: Iterable[tuple]) -> list[np.ndarray]:
    return [np.concatenate(c) for c in zip(*parts)]


def _over_parts(sent: DataFrame, work: Callable, schema: str) -> DataFrame:
    """Run ``work`` over the rows of each part."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[dict] = []
        for batch in batches:
            for i in range(batch.num_rows):
                (row,) = batch.slice(i, 1).to_pylist()
                if rows and rows[0]["part"] != row["part"]:
                    if any(r["kind"] == 0 for r in rows):
                        yield from work(rows)
                    rows = []
                rows.append(row)
        if rows and any(r["kind"] == 0 for r in rows):
            yield from work(rows)

    return sent.repartition("part").sortWithinPartitions("part").mapInArrow(run, schema)


def _over_levels(sent: DataFrame, work: Callable, schema: str, level: int, cut) -> DataFrame:
    """Run ``work`` over the parts of a level, whose places are in order."""

    def run(rows: list[dict]) -> Iterator[pa.RecordBatch]:
        yield from work(_Part(rows, level, cut))

    return _over_parts(sent, run, schema)


def _found(part: _Part) -> Iterator[pa.RecordBatch]:
    """Values of a level's groups, for the level above."""
    names, decisions, values = _joined(level.found(fold) for level, fold in part.levels())
    yield _split(
        names >> 32,
        1,
        "",
        names=names & 0xFFFFFFFF,
        lows=decisions.astype(np.uint8),
        x=values,
    )


TOPS = "byte int, part long, names binary, decisions binary, zero binary, one binary, value binary"


def _tops(cut: Borders) -> Callable:
    """Values of the contexts at the borders, by last byte."""

    def work(part: _Part) -> Iterator[pa.RecordBatch]:
        names, decisions, zero, one, value = _joined(
            (*level.of_roots(fold), *(v[fold.roots] for v in (fold.zero, fold.one, fold.top)))
            for level, fold in part.levels()
        )
        last = (cut.begin[0][names] >> np.uint64(56)).astype(np.int64)
        for byte in np.unique(last).tolist():
            at = last == byte
            row = {
                "byte": byte,
                "part": part.number,
                "names": names[at].tobytes(),
                "decisions": decisions[at].astype("<i8").tobytes(),
                "zero": zero[at].tobytes(),
                "one": one[at].tobytes(),
                "value": value[at].tobytes(),
            }
            yield pa.RecordBatch.from_pylist(
                [row],
                pa.schema(
                    [("byte", pa.int32()), ("part", pa.int64())]
                    + [(c, pa.binary()) for c in ("names", "decisions", "zero", "one", "value")]
                ),
            )

    return work


def _folded_top(group: pd.DataFrame, cut: Borders) -> tuple[Fold, np.ndarray, np.ndarray]:
    """Contexts at the borders that end in one byte, folded to it; their names and decisions."""

    def column(name: str, kind: str = "<i8") -> np.ndarray:
        return np.frombuffer(b"".join(group[name]), kind)

    names, decisions = column("names"), column("decisions")
    order = np.lexsort((names, decisions))
    names, decisions = names[order], decisions[order]
    shared = np.full(len(names), -1, np.int64)
    same = decisions[1:] == decisions[:-1]
    words = cut.begin[:, names]
    x = words[:, 1:][:, same] ^ words[:, :-1][:, same]
    shared[1:][same] = equal_bytes(x[0]) + np.where(x[0] == 0, equal_bytes(x[1]), 0)
    zero, one = column("zero")[order], column("one")[order]
    value = column("value", "<f8")[order]
    fold = Fold(shared, zero, one, cut.depth[names], value, np.ones(len(names)))
    return fold, names, decisions


def _root(rows: list) -> dict[tuple[int, int], tuple[float, float]]:
    """From the values of each last byte and decision, what the root predicts, and leaves."""
    if not rows:
        return {}
    byte, decision, zero, one, value = (np.array(c) for c in zip(*rows))
    order = np.lexsort((byte, decision))
    byte, decision = byte[order], decision[order]
    shared = np.where(np.append(True, decision[1:] != decision[:-1]), -1, 0)
    depth = np.ones(len(byte), np.int64)
    fold = Fold(shared, zero[order], one[order], depth, value[order], np.zeros(len(byte)))
    trees = len(fold.roots)
    chance, rest = fold.predict(np.zeros(trees), np.ones(trees))
    return {k: v for k, v in zip(zip(byte.tolist(), decision.tolist()), zip(chance, rest))}


def _from_top(tops: DataFrame, cut: Borders) -> DataFrame:
    """Predictions down to the borders, for the parts of level 0."""

    def up(group: pd.DataFrame) -> pd.DataFrame:
        fold, _, decisions = _folded_top(group, cut)
        return pd.DataFrame(
            {
                "byte": int(group["byte"].iloc[0]),
                "decision": decisions[fold.begins],
                "zero": fold.zero[fold.roots],
                "one": fold.one[fold.roots],
                "value": fold.top[fold.roots],
            }
        )

    schema = "byte int, decision long, zero long, one long, value double"
    root = _root([tuple(r) for r in tops.groupBy("byte").applyInPandas(up, schema).collect()])

    def down(group: pd.DataFrame) -> pd.DataFrame:
        fold, names, decisions = _folded_top(group, cut)
        byte = int(group["byte"].iloc[0])
        above = np.array([root[byte, d] for d in decisions[fold.begins].tolist()])
        chance, rest = fold.predict(above[:, 0], above[:, 1])
        return _split(
            cut.part[names],
            2,
            "",
            names=names,
            lows=decisions.astype(np.uint8),
            x=chance,
            y=rest,
        ).to_pandas()

    return tops.groupBy("byte").applyInPandas(down, SENT)


def _predicted(parts: int) -> Callable:
    """Scores of places, and predictions for the next level: ``SENT``, of kind 3 and 2."""

    def work(part: _Part) -> Iterator[pa.RecordBatch]:
        scores, further = [], []
        for level, fold in part.levels():
            asked, chance, rest = part.given(2, *level.of_roots(fold))
            logs, *on = level.predict(fold, chance, rest, asked)
            scores.append(logs)
            further.append(on)
        logs = np.concatenate(scores)
        by = np.argsort(part.of, kind="stable")
        ends = np.flatnonzero(np.diff(part.of[by])) + 1
        for at in np.split(by, ends):
            zeros = np.zeros(len(at), np.int64)
            name = part.slices[part.of[at[0]]]
            yield _split(zeros, 3, name, places=part.places[at], x=logs[at].astype("<f4"))
        numbers, decisions, chance, rest = _joined(further)
        if len(numbers):
            names = part.names(numbers)
            yield _split(
                _part_of(names, parts),
                2,
                "",
                names=names,
                lows=decisions.astype(np.uint8),
                x=chance,
                y=rest,
            )

    return work


def _summed(texts: DataFrame, logs: DataFrame) -> DataFrame:
    """Scores of documents from those of their places."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                starts = np.frombuffer(row["starts"], "<i8")
                score = np.zeros(len(starts))
                for one in row["logs"]:
                    places = np.frombuffer(one["places"], "<u4")
                    of = np.searchsorted(starts, places, "right") - 1
                    score += np.bincount(of, np.frombuffer(one["x"], "<f4"), len(starts))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.frombuffer(row["keys"], "<i8")),
                        pa.array(np.frombuffer(row["marks"], "<i8")),
                        pa.array(score),
                    ],
                    names=["key", "mark", "score"],
                )

    lists = logs.groupBy("slice").agg(F.collect_list(F.struct("places", "x")).alias("logs"))
    known = texts.select("slice", "starts", "keys", "marks").join(lists, "slice")
    return known.mapInArrow(run, "key long, mark long, score double")


def _step(df: DataFrame) -> DataFrame:
    """A stored step, whose exchange files go when it ends: those of all steps would add up."""
    conf = df.sparkSession.conf
    before = conf.get(CLEAN_UP, "false")
    conf.set(CLEAN_UP, "true")
    try:
        return stored(df)
    finally:
        conf.set(CLEAN_UP, before)


def tree_scores(rows: DataFrame) -> DataFrame:
    """key, mark, score of each text by the tree of all texts that are not held out."""
    texts = stored(_texts(rows.select("text", "held", "key", "mark")))
    cut = borders(texts)
    sent, levels, parts = _sent_first(texts, cut), [], [int(cut.part.max(initial=0)) + 1]
    while True:
        level = len(levels)
        arrange = _arranged(level, None if level else cut)
        arranged = _step(_over_parts(sent, arrange, SENT))
        levels.append(arranged.where("kind = 0"))
        asked = arranged.where("kind = 4")
        n = asked.agg(F.sum(F.octet_length("places"))).first()[0]
        if not n:
            break
        parts.append(-(-n // (4 * PART)))
        sent = _sent_on(texts, asked, level + 1, parts[-1])
    for level in range(len(levels) - 1, 0, -1):
        found = _step(_over_levels(levels[level], _found, SENT, level, None))
        levels[level - 1] = levels[level - 1].unionByName(found)
    tops = _step(_over_levels(levels[0], _tops(cut), TOPS, 0, cut))
    above, scores = _from_top(tops, cut), []
    for level, sent in enumerate(levels):
        below = parts[level + 1] if level + 1 < len(parts) else 1
        work = _predicted(below)
        sent = sent.unionByName(above)
        out = _step(_over_levels(sent, work, SENT, level, None if level else cut))
        scores.append(out.where("kind = 3"))
        above = out.where("kind = 2")
    logs = scores[0]
    for more in scores[1:]:
        logs = logs.unionByName(more)
    return _summed(texts, logs)


SLICE_SCHEMA = (
    "slice string, words array<binary>, train array<long>, doc_ids array<long>,"
    " marks array<long>, held array<boolean>, n_words array<long>, pairs binary, times binary"
)


def _word_slices(rows: DataFrame) -> DataFrame:
    """One row per slice: its distinct words, their training counts, and each document's words."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, number = TaskContext.get().partitionId(), 0
        texts, held, marks, ids, size = [], [], [], [], 0

        def close() -> pa.RecordBatch:
            vocabulary: dict[bytes, int] = defaultdict(count().__next__)
            split = [t.lower().split() for t in texts]
            lengths = np.array([len(s) for s in split], np.int64)
            numbers = np.fromiter(
                (vocabulary[w] for s in split for w in s), np.int64, int(lengths.sum())
            )
            of = np.repeat(np.arange(len(split)), lengths)
            learned = ~np.array(held, bool)[of]
            total = np.bincount(numbers[learned], minlength=len(vocabulary))
            wide = max(1, len(vocabulary))
            pairs, times = np.unique(of * wide + numbers, return_counts=True)
            # Per document its words' numbers, as (document, word) in two 32-bit integers.
            places = np.stack([pairs // wide, pairs % wide]).astype("<u4")
            row = {
                "slice": f"{part}-{number}",
                "words": list(vocabulary),
                "train": total.tolist(),
                "doc_ids": ids,
                "marks": marks,
                "held": held,
                "n_words": lengths.tolist(),
                "pairs": places.tobytes(),
                "times": times.astype("<u4").tobytes(),
            }
            return pa.RecordBatch.from_pylist(
                [row],
                pa.schema(
                    [
                        ("slice", pa.string()),
                        ("words", pa.list_(pa.binary())),
                        ("train", pa.list_(pa.int64())),
                        ("doc_ids", pa.list_(pa.int64())),
                        ("marks", pa.list_(pa.int64())),
                        ("held", pa.list_(pa.bool_())),
                        ("n_words", pa.list_(pa.int64())),
                        ("pairs", pa.binary()),
                        ("times", pa.binary()),
                    ]
                ),
            )

        for batch in batches:
            for i, text in enumerate(batch.column("text").to_pylist()):
                raw = text.encode()
                if texts and size + len(raw) > SLICE_BYTES:
                    yield close()
                    texts, held, marks, ids, size = [], [], [], [], 0
                    number += 1
                texts.append(raw)
                size += len(raw)
                held.append(batch.column("held")[i].as_py())
                marks.append(batch.column("mark")[i].as_py())
                ids.append(batch.column("doc_id")[i].as_py())
        if texts:
            yield close()

    return rows.mapInArrow(run, SLICE_SCHEMA)


def _totals(slices: DataFrame) -> DataFrame:
    """Per slice the corpus totals of its words, packed with their numbers; and words first seen.

    A word has one row for each slice that holds it, so no word is hot; the window's rows spill.
    """
    each = F.posexplode(F.arrays_zip("words", "train")).alias("no", "w")
    rows = slices.select("slice", each).select(
        "slice", "no", F.col("w.words").alias("word"), F.col("w.train").alias("train")
    )
    same = Window.partitionBy("word")
    total = F.sum("train").over(same)
    known = rows.select(
        "slice",
        F.shiftleft(F.col("no").cast("long"), TOTAL_BITS).bitwiseOR(total).alias("total"),
        ((F.min("slice").over(same) == F.col("slice")) & (total > 0)).alias("first"),
    )
    return known.groupBy("slice").agg(
        F.collect_list("total").alias("totals"), F.sum(F.col("first").cast("long")).alias("new")
    )


BASE_SCHEMA = (
    "doc_id long, mark long, held_out boolean, n_tokens long, n_known long, train_tokens long,"
    " base_score double"
)


def base_scores(rows: DataFrame) -> DataFrame:
    """Unigram scores of all documents by the words of those that are not held out."""
    slices = stored(_word_slices(rows))
    totals = stored(_totals(slices.select("slice", "words", "train")))
    trained = slices.select(
        F.expr("aggregate(train, 0L, (a, x) -> a + x)").alias("words"),
        F.expr("size(filter(held, x -> not x))").cast("long").alias("ends"),
    ).agg(F.sum("words"), F.sum("ends"))
    n_words, ends = (x or 0 for x in trained.first())
    distinct = (totals.agg(F.sum("new")).first()[0] or 0) + (ends > 0)
    n = n_words + ends
    below = n + ADDED * (distinct + 1)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                packed = batch.column("totals")[i]
                packed = (
                    packed.values.to_numpy() if packed.is_valid else np.zeros(0, np.int64)
                )
                learned = np.zeros(len(packed), np.int64)
                learned[packed >> TOTAL_BITS] = packed & ((1 << TOTAL_BITS) - 1)
                ids = batch.column("doc_ids")[i].as_py()
                pairs = np.frombuffer(batch.column("pairs")[i].as_py(), "<u4").reshape(2, -1)
                times = np.frombuffer(batch.column("times")[i].as_py(), "<u4").astype(np.float64)
                logs = np.log10((learned + ADDED) / below)
                of, word = pairs[0].astype(np.int64), pairs[1]
                score = np.bincount(of, times * logs[word], len(ids))
                known = np.bincount(of, times * (learned[word] > 0), len(ids)).astype(np.int64)
                n_words = np.array(batch.column("n_words")[i].as_py(), np.int64)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(ids, pa.int64()),
                        pa.array(batch.column("marks")[i].as_py(), pa.int64()),
                        pa.array(batch.column("held")[i].as_py(), pa.bool_()),
                        pa.array(n_words + 1),
                        pa.array(known + (ends > 0)),
                        pa.array(np.full(len(ids), n, np.int64)),
                        pa.array(score + np.log10((ends + ADDED) / below)),
                    ],
                    names=[c.split()[0] for c in BASE_SCHEMA.split(", ")],
                )

    wanted = slices.select("slice", "doc_ids", "marks", "held", "n_words", "pairs", "times")
    return wanted.join(totals, "slice", "left").mapInArrow(run, BASE_SCHEMA)


def score_documents(docs: DataFrame) -> DataFrame:
    """One row per document: held_out, token counts, unigram base score and the model's score.

    Both scores are log10 probabilities of the whole text, A-Z lower-cased, with its end; they
    learn from all documents that are not held out. A missing or empty text is the end alone.
    Repeated rows all count and get the same scores; further columns are left out. With nothing
    to learn from, every decision is even and the base score is 0.
    """
    rows = id_and_text(docs).withColumns(
        {
            "held": held_out(F.col("doc_id")),
            "mark": F.xxhash64("text"),
            "key": F.coalesce("doc_id", F.lit(-(1 << 63))),
        }
    )
    scores = tree_scores(rows).dropDuplicates(["key", "mark"])
    base = base_scores(rows).withColumn("key", F.coalesce("doc_id", F.lit(-(1 << 63))))
    return base.join(scores, ["key", "mark"]).drop("key", "mark")
