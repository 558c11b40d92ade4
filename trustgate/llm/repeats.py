"""Removal of passages that occur earlier in the corpus, byte for byte.

A byte goes if some string of ``LENGTH`` bytes around it also starts earlier: in a document with
a smaller id, or before it in its own. Equal strings have to meet, and no machine holds the
corpus, so the work is cut by content first. Every string (window) has a marker, the ``GRAM``
bytes within it with the smallest hash, leftmost on ties; equal windows have equal markers at
equal places. Consecutive windows with one marker form a stretch, and stretches of one marker
are gathered. Stretches that are equal as a whole need no search: all but the earliest go. What
is left, markers with different stretches, is searched by the Burrows-Wheeler transform.

Search: suffixes of the gathered stretches are ordered by their first LENGTH bytes, which gives
the transform. Starting from the whole order, intervals of suffixes with a common prefix are
extended backward by one byte, breadth first. Each step lengthens the prefix by one and shows
between which neighbours it ends, so common prefixes come out by increasing length, and after
LENGTH steps all borders left unmarked lie within windows that are equal.

A marker with more than LARGE stretches would make one task long. Its stretches are cut anew
with GRAM = LENGTH, where every window is its own marker, and gathered by that.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trustgate.llm.common import id_and_text, slices, stored

LENGTH = 100
GRAM = 20
#: Bytes hashed at once; a longer text is cut into parts that overlap by LENGTH - 1.
PART = 4 << 20
PLACE_BITS = 23
#: Stretches of one marker that a task searches, and bytes of stretches searched together.
LARGE = 20_000
SEARCH_BYTES = 1 << 20
#: Never occurs in UTF-8.
GAP = b"\xff"

_A, _B, _C = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9], np.uint64)


def _hashes(raw: np.ndarray, gram: int) -> np.ndarray:
    """A hash of the ``gram`` bytes from each place (fewer places than bytes)."""
    n = len(raw) - gram + 1
    words = np.zeros(len(raw) - 7, np.uint64)
    for i in range(8):
        words[i::8] = raw[i : i + (len(raw) - i) // 8 * 8].view("<u8")
    value = np.zeros(n, np.uint64)
    # Eight bytes at a time; the last word ends where the gram ends.
    for at in [*range(0, gram - 8, 8), gram - 8]:
        value = (value ^ words[at : at + n]) * _A
        value ^= value >> np.uint64(32)
    value *= _B
    value ^= value >> np.uint64(29)
    value *= _C
    return value ^ (value >> np.uint64(32))


def _windows_min(key: np.ndarray, width: int) -> np.ndarray:
    """The smallest key of each run of ``width`` places, by doubling."""
    reach = 1
    while 2 * reach <= width:
        key = np.minimum(key[:-reach], key[reach:])
        reach *= 2
    rest = width - reach
    return np.minimum(key[: len(key) - rest], key[rest:]) if rest else key


def stretches(raw: bytes, bounds: np.ndarray, gram: int):
    """Stretches of windows that share a marker: starts, window counts and markers' hashes.

    raw: parts one after another; bounds: their ends and 0. No window crosses a bound.
    """
    none = np.zeros(0, np.int64)
    if len(raw) < LENGTH:
        return none, none, none
    hashes = _hashes(np.frombuffer(raw, np.uint8), gram)
    low = np.uint64((1 << PLACE_BITS) - 1)
    key = (hashes & ~low) | np.arange(len(hashes), dtype=np.uint64)
    marker = (_windows_min(key, LENGTH - gram + 1) & low).astype(np.int64)
    valid = np.zeros(len(marker), bool)
    for begin, end in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
        valid[begin : max(begin, end - LENGTH + 1)] = True
    starts = np.flatnonzero(valid)
    if not len(starts):
        return none, none, none
    marker = marker[starts]
    new = np.ones(len(starts), bool)
    new[1:] = (np.diff(marker) != 0) | (np.diff(starts) != 1)
    first = np.flatnonzero(new)
    counts = np.diff(np.append(first, len(starts)))
    return starts[first], counts, hashes[marker[first]].view(np.int64)


FOUND = "repeat boolean, marker long, body long, doc long, mark long, start long, n long"
_FOUND = [c.split()[0] for c in FOUND.split(", ")]


def _parts(rows: Iterable[tuple[int, int, int, bytes]]):
    """Batches of (doc, mark, offset, bytes) with about PART bytes, long texts cut with overlap."""
    held, size = [], 0
    for doc, mark, base, raw in rows:
        for at in range(0, max(1, len(raw) - LENGTH + 1), PART):
            piece = raw[at : at + PART + LENGTH - 1]
            if size and size + len(piece) > PART:
                yield held
                held, size = [], 0
            held.append((doc, mark, base + at, piece))
            size += len(piece)
    if held:
        yield held


def _stretch_rows(part: list[tuple[int, int, int, bytes]], gram: int) -> pa.RecordBatch:
    """Stretches of a batch; one that repeats an earlier one of the batch is settled at once."""
    raw = b"".join(p[3] for p in part)
    bounds = np.cumsum([0, *[len(p[3]) for p in part]])
    starts, counts, markers = stretches(raw, bounds, gram)
    digest = xxhash.xxh3_64_intdigest
    body = np.array(
        [
            digest(raw[s : s + n])
            for s, n in zip(starts.tolist(), (counts + LENGTH - 1).tolist(), strict=True)
        ],
        np.uint64,
    ).view(np.int64)
    of = np.searchsorted(bounds, starts, side="right") - 1
    doc = np.array([p[0] for p in part], np.int64)[of]
    mark = np.array([p[1] for p in part], np.int64)[of]
    at = starts - bounds[of] + np.array([p[2] for p in part], np.int64)[of]
    order = np.lexsort((at, mark, doc, body, markers))
    repeat = np.zeros(len(order), bool)
    m, b = markers[order], body[order]
    like = (m[1:] == m[:-1]) & (b[1:] == b[:-1])
    repeat[order[1:]] = like
    # A place that is there twice comes from a repeated row, and is no repeat of itself.
    again = np.zeros(len(order), bool)
    place = [x[order] for x in (doc, mark, at)]
    again[order[1:]] = like & np.logical_and.reduce([x[1:] == x[:-1] for x in place])
    columns = (repeat, markers, body, doc, mark, at, counts.astype(np.int64))
    return pa.RecordBatch.from_arrays([pa.array(c[~again]) for c in columns], names=_FOUND)


def _texts(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple[int, int, int, bytes]]:
    for batch in batches:
        for piece in slices(batch):
            for doc, mark, text in zip(
                *(piece.column(c).to_pylist() for c in ("doc", "mark", "text")), strict=True
            ):
                yield doc, mark, 0, text.encode()


def _settle(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of stretches ordered by marker, body and place: drop markers that occur once, settle repeats.

    The first of equal stretches stays open (``repeat`` false), the others are repeats.
    """
    tail: pa.RecordBatch | None = None
    last = None  # marker and body of the row before the tail
    for batch in batches:
        if not batch.num_rows:
            continue
        if tail is not None:
            batch = pa.Table.from_batches([tail, batch]).combine_chunks().to_batches()[0]
        yield from _settled(batch, last, batch.num_rows - 1)
        if batch.num_rows > 1:
            last = tuple(batch.column(c)[batch.num_rows - 2].as_py() for c in _FOUND)
        tail = batch.slice(batch.num_rows - 1)
    if tail is not None:
        yield from _settled(tail, last, 1)


def _settled(batch: pa.RecordBatch, before, number: int) -> Iterator[pa.RecordBatch]:
    """The first ``number`` rows, judged with one neighbour on either side."""
    if not number:
        return
    done = batch.column("repeat").to_numpy(zero_copy_only=False)
    marker, body = (batch.column(c).to_numpy() for c in ("marker", "body"))
    n = batch.num_rows
    like = np.zeros(n + 1, bool)  # row i has the marker of row i - 1
    like[1:n] = (marker[1:] == marker[:-1]) & ~done[1:] & ~done[:-1]
    same = np.zeros(n, bool)
    same[1:] = like[1:n] & (body[1:] == body[:-1])
    if before is not None and not before[0] and not done[0]:
        like[0] = before[1] == marker[0]
        same[0] = like[0] and before[2] == body[0]
    places = [batch.column(c).to_numpy() for c in ("doc", "mark", "start")]
    again = same.copy()  # the same place once more, from a repeated row
    again[1:] &= np.logical_and.reduce([x[1:] == x[:-1] for x in places])
    if again[0]:
        again[0] = before[3:6] == tuple(int(x[0]) for x in places)
    repeat = done | same
    kept = ((repeat | like[:n] | like[1 : n + 1]) & ~again)[:number]
    out = batch.slice(0, number).set_column(0, "repeat", pa.array(repeat[:number]))
    yield out.filter(pa.array(kept))


def _gathered(found: DataFrame) -> DataFrame:
    """Settle equal stretches; repeats of a batch are spread by place, the others by marker."""
    route = F.when(F.col("repeat"), F.xxhash64("doc", "start")).otherwise(F.col("marker"))
    return (
        found.withColumn("route", route)
        .repartition("route")
        .drop("route")
        .sortWithinPartitions("repeat", "marker", "body", "doc", "mark", "start")
        .mapInArrow(_settle, FOUND)
    )


def window_classes(raw: np.ndarray) -> np.ndarray:
    """A number for each place, equal for places whose LENGTH bytes are equal; -1 at the end.

    raw: bytes with at least LENGTH gaps at its end.
    """
    n = len(raw) - LENGTH
    order = _suffix_order(raw, n)
    transform = raw[order - 1]  # of the first place, the byte before is the last gap
    borders = _expand(transform, LENGTH)
    classes = np.empty(n, np.int64)
    classes[order] = np.cumsum(borders[:n])
    return classes


def _suffix_order(raw: np.ndarray, n: int) -> np.ndarray:
    """Places 0 to n - 1 in order of their first LENGTH bytes, by doubling ranks."""
    # As many bytes first as a word holds beside a place.
    reach = (64 - n.bit_length()) // 8
    value = np.zeros(n, np.uint64)
    for i in range(reach):
        value = (value << np.uint64(8)) | raw[i : i + n]
    order, rank = _ranks(value, 8 * reach)
    while reach < LENGTH:
        step = min(reach, LENGTH - reach)
        # Beyond the last place there are gaps alone, which sort last as one more rank.
        last = int(rank[order[-1]]) + 1
        width = last.bit_length()
        after = np.full(n, last, np.uint64)
        after[: n - step] = rank[step:]
        order, rank = _ranks((rank << np.uint64(width)) | after, 2 * width)
        reach += step
    return order


def _ranks(value: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Places in order of their values, which have ``width`` bits, and each place's rank."""
    n = len(value)
    bits = n.bit_length()
    if width + bits <= 64:
        # Value and place share a word: sorting words is several times faster than an argsort.
        packed = (value << np.uint64(bits)) | np.arange(n, dtype=np.uint64)
        packed.sort()
        order = (packed & np.uint64((1 << bits) - 1)).astype(np.int64)
        ordered = packed >> np.uint64(bits)
    else:
        order = np.argsort(value, kind="stable")
        ordered = value[order]
    rank = np.zeros(n, np.uint64)
    rank[order[1:]] = np.cumsum(ordered[1:] != ordered[:-1])
    return order, rank


def _expand(transform: np.ndarray, longest: int) -> np.ndarray:
    """borders[i]: the suffixes at i - 1 and i share fewer than ``longest`` bytes.

    Breadth-first backward extension. An interval (low, high) holds the suffixes that start with
    some string w; the bytes before them split it into the intervals of all strings cw. The end
    of such an interval is a border of suffixes that share len(w) bytes. The first string that
    reaches a border gives the length, and only such strings are extended further.
    """
    n = len(transform)
    kind = np.int32 if n < 1 << 31 else np.int64
    by_byte = np.argsort(transform, kind="stable").astype(kind)
    mapped = np.empty(n, kind)
    mapped[by_byte] = np.arange(n, dtype=kind)
    # The places of the same byte before and after each place.
    before, after = np.full(n, -1, kind), np.full(n, n, kind)
    same = transform[by_byte[1:]] == transform[by_byte[:-1]]
    before[by_byte[1:][same]] = by_byte[:-1][same]
    after[by_byte[:-1][same]] = by_byte[1:][same]
    borders = np.zeros(n + 1, bool)
    borders[[0, n]] = True
    low, high = np.zeros(1, kind), np.full(1, n, kind)
    for _ in range(longest):
        if not len(low):
            break
        size = high - low
        ends = np.cumsum(size, dtype=np.int64)
        place = np.arange(ends[-1]) + np.repeat(low - (ends - size), size)
        a = place[before[place] < np.repeat(low, size)]
        b = place[after[place] >= np.repeat(high, size)]
        # First and last place of each byte of each interval. Intervals of one length don't
        # overlap, so both come into one order, by byte and interval.
        low, high = np.sort(mapped[a]), np.sort(mapped[b]) + 1
        fresh = ~borders[high]
        low, high = low[fresh], high[fresh]
        borders[high] = True
    return borders


def _search(rows: list[tuple[int, int, int, int, bytes]]) -> pa.RecordBatch:
    """Runs of windows, of stretches (doc, mark, start, windows, bytes), that start earlier too."""
    raw = GAP.join(r[4] for r in rows) + GAP * (LENGTH + 1)
    sizes = np.array([len(r[4]) + 1 for r in rows], np.int64)
    bases = np.cumsum(sizes) - sizes
    classes = window_classes(np.frombuffer(raw, np.uint8))
    n = np.array([r[3] for r in rows], np.int64)
    of = np.repeat(np.arange(len(rows)), n)
    step = np.arange(len(of)) - np.repeat(np.cumsum(n) - n, n)
    kind = classes[bases[of] + step]
    doc, mark, start = (np.array([r[i] for r in rows], np.int64)[of] for i in range(3))
    start = start + step
    order = np.lexsort((start, mark, doc, kind))
    repeat = np.zeros(len(of), bool)
    like = kind[order[1:]] == kind[order[:-1]]
    # The first place of a class stays, also where a repeated row shows it again.
    first = np.maximum.accumulate(np.where(np.append(True, ~like), np.arange(len(order)), 0))
    own = [x[order] for x in (doc, mark, start)]
    repeat[order] = ~np.logical_and.reduce([x == x[first] for x in own])
    at = np.flatnonzero(repeat)
    new = np.ones(len(at), bool)
    new[1:] = (np.diff(at) != 1) | (np.diff(of[at]) != 0)
    first = np.flatnonzero(new)
    counts = np.diff(np.append(first, len(at)))
    at = at[first]
    return pa.RecordBatch.from_arrays(
        [pa.array(doc[at]), pa.array(mark[at]), pa.array(start[at]), pa.array(counts)],
        names=["doc", "mark", "start", "n"],
    )


RUNS = "doc long, mark long, start long, n long"


def _searched(bodies: DataFrame) -> DataFrame:
    """bodies: marker, doc, mark, start, n, bytes. All stretches of a marker are searched together."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        size, now = 0, None
        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in ("doc", "mark", "start", "n", "bytes")]
            markers = batch.column("marker").to_pylist()
            for marker, *row in zip(markers, *columns, strict=True):
                if size > SEARCH_BYTES and marker != now:
                    yield _search(held)
                    held, size = [], 0
                held.append(tuple(row))
                size += len(row[4])
                now = marker
        if held:
            yield _search(held)

    return bodies.repartition("marker").sortWithinPartitions("marker").mapInArrow(run, RUNS)


def _bodies(rows: DataFrame, wanted: DataFrame) -> DataFrame:
    """The bytes of wanted stretches (marker, doc, mark, start, n), cut from their documents."""
    lists = wanted.groupBy("doc", "mark").agg(
        F.collect_list(F.struct("marker", "start", "n")).alias("wanted")
    )

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in slices(batch):
                columns = zip(
                    *(piece.column(c).to_pylist() for c in ("doc", "mark", "text")), strict=True
                )
                markers, docs, marks, starts, counts, bodies = [], [], [], [], [], []
                for (doc, mark, text), asked in zip(columns, piece.column("wanted"), strict=True):
                    raw = text.encode()
                    asked = asked.values
                    at = asked.field("start").to_numpy().tolist()
                    n = asked.field("n").to_numpy().tolist()
                    markers += asked.field("marker").to_numpy().tolist()
                    starts += at
                    counts += n
                    docs += [doc] * len(at)
                    marks += [mark] * len(at)
                    bodies += [
                        raw[s : s + k + LENGTH - 1] for s, k in zip(at, n, strict=True)
                    ]
                numbers = [pa.array(c, pa.int64()) for c in (markers, docs, marks, starts, counts)]
                yield pa.RecordBatch.from_arrays(
                    [*numbers, pa.array(bodies, pa.binary())],
                    names=["marker", "doc", "mark", "start", "n", "bytes"],
                )

    schema = "marker long, doc long, mark long, start long, n long, bytes binary"
    return rows.join(lists, ["doc", "mark"]).mapInArrow(run, schema)


def _cut_anew(bodies: DataFrame) -> DataFrame:
    """Stretches of the windows of the given ones, each window its own marker."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows():
            for batch in batches:
                names = ("doc", "mark", "start", "bytes")
                yield from zip(*(batch.column(c).to_pylist() for c in names), strict=True)

        for part in _parts(rows()):
            yield _stretch_rows(part, LENGTH)

    return bodies.mapInArrow(run, FOUND)


def repeated_runs(rows: DataFrame) -> DataFrame:
    """doc, mark, start, n: runs of n windows that all start earlier too.

    rows: doc, mark, text; (doc, mark) names a text, and orders texts.
    """

    def find(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in _parts(_texts(batches)):
            yield _stretch_rows(part, GRAM)

    found = stored(_gathered(rows.mapInArrow(find, FOUND)))
    open_ = found.where("not repeat").select("marker", "doc", "mark", "start", "n")
    kinds = open_.groupBy("marker").agg(F.count("*").alias("kinds")).where("kinds > 1")
    wanted = open_.join(kinds, "marker")
    few = wanted.where(F.col("kinds") <= LARGE).drop("kinds")
    runs = found.where("repeat").select("doc", "mark", "start", "n")
    runs = runs.union(_searched(_bodies(rows, few)))
    many = kinds.where(F.col("kinds") > LARGE).select("marker")
    if not many.isEmpty():
        hot = _bodies(rows, open_.join(many, "marker"))
        again = _gathered(_cut_anew(hot)).where("repeat")
        runs = runs.union(again.select("doc", "mark", "start", "n"))
    return runs


SCHEMA = "doc long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary"


def _without(raw: bytes, starts: np.ndarray, counts: np.ndarray) -> tuple[bytes, int, int]:
    """The bytes outside all windows of the runs, how many went, and in how many spans."""
    order = np.argsort(starts, kind="stable")
    begins, ends = starts[order], (starts + counts + LENGTH - 1)[order]
    reach = np.maximum.accumulate(ends)
    new = np.concatenate([[True], begins[1:] > reach[:-1]])
    first = np.flatnonzero(new)
    begins, ends = begins[first], np.append(reach[first[1:] - 1], reach[-1])
    kept = [raw[a:b] for a, b in zip([0, *ends.tolist()], [*begins.tolist(), len(raw)], strict=True)]
    return b"".join(kept), int((ends - begins).sum()), len(first)


def _remove(joined: DataFrame, texts: bool) -> DataFrame:
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in slices(batch):
                rows = []
                columns = (piece.column(c).to_pylist() for c in ("doc", "text"))
                for doc, text, runs in zip(*columns, piece.column("runs"), strict=True):
                    raw = kept = text.encode()
                    removed = spans = 0
                    if runs.is_valid and len(runs):
                        start = runs.values.field("start").to_numpy()
                        kept, removed, spans = _without(raw, start, runs.values.field("n").to_numpy())
                    digest = hashlib.sha256(kept).hexdigest()
                    rows.append((doc, len(raw), removed, spans, digest, kept if texts else None))
                kinds = [pa.int64()] * 4 + [pa.string(), pa.binary()]
                columns = zip(*rows, strict=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(list(c), k) for c, k in zip(columns, kinds, strict=True)],
                    names=[c.split()[0] for c in SCHEMA.split(", ")],
                )

    return joined.mapInArrow(run, SCHEMA)


def remove_repeats(docs: DataFrame, texts: bool = False) -> DataFrame:
    """One row per document: bytes, removed bytes, removed spans and a digest of what is left.

    With ``texts`` the kept bytes come along. Texts below LENGTH bytes, missing ones among them,
    lose nothing. A missing doc_id comes before all others; different texts of one doc_id are
    ordered by their hash. Wholly repeated rows (same id and text) are one document, so both
    keep the same; further columns are left out.
    """
    rows = id_and_text(docs).select(
        F.coalesce("doc_id", F.lit(-(1 << 63))).alias("doc"),
        F.xxhash64("text").alias("mark"),
        "text",
    )
    runs = stored(repeated_runs(rows)).groupBy("doc", "mark").agg(
        F.collect_set(F.struct("start", "n")).alias("runs")
    )
    joined = rows.join(runs, ["doc", "mark"], "left")
    out = _remove(joined, texts).withColumnRenamed("doc", "doc_id")
    none = F.col("doc_id") == F.lit(-(1 << 63))
    out = out.withColumn("doc_id", F.when(~none, F.col("doc_id")))
    return out if texts else out.drop("kept")
