"""Packing of token sequences as a cutting-stock problem, solved by column generation.

Documents are cut into whole sequences of ``CAPACITY`` tokens and a remainder each. What counts of
the remainders is how many there are of each length, a histogram of fewer than CAPACITY numbers
however large the corpus. A pattern says how many remainders of which lengths fill a sequence
exactly. A linear program over patterns covers as many tokens as it can; its columns are found by
a knapsack, which fills CAPACITY exactly at the lowest price of the lengths (dynamic programming),
and a pattern that costs less than the sequence it fills enters the basis. Patterns are rounded
down, then up as far as remainders are left.

Documents are ranked within their length, and the pattern's copies are dealt to ranks in order:
a document's sequence and place in it follow from its length and rank alone. Remainders that no
rounded pattern takes stand one behind the other and are cut where a sequence is full; the last
stretch is cut into powers of two. So no sequence has padding.

Ranks are counts of equal lengths in earlier payloads, summed up by Spark; ids are encoded once,
stored, and joined to the payload's first ranks.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import public_tokenizers
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from trustgate.llm import token_files
from trustgate.llm.common import id_and_text, slices, stored, texts_of

CAPACITY = 2048
END_ID = 1
#: The linear program ends when patterns cover this share of the tokens, or after so many pivots;
#: either only decides how many remainders are cut.
GOAL = 0.98
PIVOTS = 1500
#: Columns that enter after one knapsack.
COLUMNS = 60
#: Recurring pieces and pre-tokens of one generation of a worker's memory: beside it, payloads are
#: joined.
ENTRIES = 400_000
#: Pieces given to Spark at once, by their ids.
OUT_IDS = 1 << 20
_EPS = 1e-9
#: Added to the price of a length that is used up; less for one that is left.
_TIE = 1e-3
_RANK_BITS = 44


@dataclass
class Master:
    """The linear program: cover lengths by patterns, each length no more often than it occurs.

    A basis of patterns and slacks, its inverse, the basic values and the lengths' prices.
    """

    counts: np.ndarray
    capacity: int
    lengths: np.ndarray = field(init=False)
    basis: list[tuple[np.ndarray, np.ndarray] | None] = field(init=False)

    def __post_init__(self) -> None:
        """Slacks, and wherever two lengths fill a sequence the pattern of the two."""
        self.lengths = np.flatnonzero(self.counts)
        m = len(self.lengths)
        self.row = np.full(self.capacity + 1, -1)
        self.row[self.lengths] = np.arange(m)
        self.x = self.counts[self.lengths].astype(np.float64)
        self.inverse, self.price = np.eye(m), np.zeros(m)
        self.basis = [None] * m
        for i, length in enumerate(self.lengths.tolist()):
            j = int(self.row[self.capacity - length])
            if j == i:
                self.basis[i] = (np.array([i]), np.array([2.0]))
                self.inverse[i, i] = self.price[i] = 0.5
                self.x[i] /= 2
            elif j > i:
                scarce, other = (i, j) if self.x[i] <= self.x[j] else (j, i)
                self.basis[scarce] = (np.array([i, j]), np.array([1.0, 1.0]))
                self.inverse[other, scarce] = -1.0
                self.price[scarce] = 1.0
                self.x[other] -= self.x[scarce]

    def enter(self, rows: np.ndarray, times: np.ndarray, value: float = 1.0) -> bool:
        """Bring a column into the basis if that helps; a slack has value 0."""
        gain = value - self.price[rows] @ times
        if gain <= _EPS:
            return False
        d = self.inverse[:, rows] @ times
        able = np.flatnonzero(d > _EPS)
        if not len(able):
            return False
        ratios = self.x[able] / d[able]
        out = able[np.argmin(ratios)]
        step = max(0.0, float(ratios.min()))
        self.x = np.maximum(self.x - step * d, 0.0)
        self.x[out] = step
        line = self.inverse[out] / d[out]
        some = np.flatnonzero(line)
        others = np.flatnonzero(np.abs(d) > 1e-12)
        others = others[others != out]
        self.inverse[np.ix_(others, some)] -= np.outer(d[others], line[some])
        self.inverse[out] = line
        self.price[some] += gain * line[some]
        self.basis[out] = (rows, times) if value else None
        return True

    def left(self) -> np.ndarray:
        """How often each length is not used yet."""
        rows = [(*b, x) for x, b in zip(self.x.tolist(), self.basis, strict=True) if b and x > 0]
        left = self.counts[self.lengths].astype(np.float64)
        if rows:
            used = np.concatenate([times * x for _, times, x in rows])
            np.subtract.at(left, np.concatenate([r for r, _, _ in rows]), used)
        return np.maximum(left, 0.0)

    def columns(self) -> list[tuple[np.ndarray, np.ndarray]]:
        """Patterns that cost less than a sequence and share no length, the cheapest first.

        Of patterns that cost the same, those of lengths that are left most often.
        """
        cost = np.full(self.capacity + 1, np.inf)
        price = self.price + _TIE / (1.0 + self.left())
        cost[self.lengths] = price
        best, taken = np.full(self.capacity + 1, np.inf), np.zeros(self.capacity + 1, np.int64)
        best[0] = 0.0
        for total in range(1, self.capacity + 1):
            ways = cost[1 : total + 1] + best[total - 1 :: -1]
            taken[total] = k = ways.argmin()
            best[total] = ways[k]
        with_length = price + best[self.capacity - self.lengths]
        found, used = [], np.zeros(len(self.lengths), bool)
        for i in np.argsort(with_length, kind="stable").tolist():
            if with_length[i] >= 1.0 - 1e-7 or len(found) >= COLUMNS:
                break
            if used[i]:
                continue
            parts, rest = [int(self.lengths[i])], self.capacity - int(self.lengths[i])
            while rest:
                parts.append(int(taken[rest]) + 1)
                rest -= parts[-1]
            rows, times = np.unique(self.row[parts], return_counts=True)
            if not used[rows].any():
                used[rows] = True
                found.append((rows, times.astype(np.float64)))
        return found

    def covered(self) -> float:
        patterns = sum(x for x, b in zip(self.x.tolist(), self.basis, strict=True) if b)
        return patterns * self.capacity / max(1, int(self.lengths @ self.counts[self.lengths]))

    def solve(self) -> None:
        pivots = 0
        while pivots < PIVOTS and len(self.lengths) and self.covered() < GOAL:
            moved = 0
            for row in np.flatnonzero(self.price < -1e-7).tolist():
                moved += self.enter(np.array([row]), np.array([1.0]), 0.0)
            for rows, times in self.columns():
                moved += self.enter(rows, times)
            if not moved:
                return
            pivots += moved


def patterns(counts: np.ndarray, capacity: int = CAPACITY) -> list[tuple[dict[int, int], int]]:
    """Patterns (length -> times, which sum up to the capacity) and how often each is used.

    counts: remainders of each length, from 0 to capacity - 1. No length is used more often than
    it occurs.
    """
    counts = np.array(counts, np.int64)
    counts[0] = 0
    master = Master(counts, capacity)
    master.solve()
    left = counts.copy()
    chosen = []
    by_rest = sorted(
        (b for b in zip(master.x.tolist(), master.basis, strict=True) if b[1]),
        key=lambda b: int(b[0]) - b[0],
    )
    # Whole parts first; then what is left, for the patterns nearest to one more copy.
    for whole in (True, False):
        for x, (rows, times) in by_rest:
            lengths, need = master.lengths[rows], times.astype(np.int64)
            room = int((left[lengths] // need).min())
            copies = min(int(x + 1e-6), room) if whole else room
            if copies > 0:
                left[lengths] -= copies * need
                chosen.append((dict(zip(lengths.tolist(), need.tolist(), strict=True)), copies))
    return chosen


@dataclass(frozen=True)
class Plan:
    """What a document's place follows from: bounded by the capacity, not by the corpus.

    ``segments`` has, by length and first rank: length and first rank as one key, first rank,
    remainders in a sequence, first sequence, offset of the first one. ``quota`` is the number of
    ranks of each length that patterns take.
    """

    segments: np.ndarray
    quota: np.ndarray
    sequences: int

    @classmethod
    def of(cls, chosen: list[tuple[dict[int, int], int]], capacity: int = CAPACITY) -> Plan:
        used = np.zeros(capacity, np.int64)
        rows, sequences = [], 0
        for pattern, copies in chosen:
            offset = 0
            for length, times in pattern.items():
                first = int(used[length])
                rows.append(((length << _RANK_BITS) + first, first, times, sequences, offset))
                used[length] += copies * times
                offset += times * length
            sequences += copies
        return cls(np.array(sorted(rows), np.int64).reshape(-1, 5), used, sequences)

    def place(self, lengths: np.ndarray, ranks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Sequence and offset of remainders that patterns take."""
        key = (lengths << _RANK_BITS) + ranks
        row = self.segments[np.searchsorted(self.segments[:, 0], key, side="right") - 1]
        copy, place = np.divmod(ranks - row[:, 1], np.maximum(row[:, 2], 1))
        return row[:, 3] + copy, row[:, 4] + place * lengths


def stretch_ends(total: int, capacity: int = CAPACITY) -> list[int]:
    """Where the last stretch of the remainders that stand in a row is cut: powers of two."""
    at, ends = total - total % capacity, []
    while at < total:
        at += 1 << ((total - at).bit_length() - 1)
        ends.append(at)
    return ends


def _flat(ids: np.ndarray) -> bytes:
    """Ids as 16 bits each where all fit, else as 32."""
    return ids.astype("<u2" if not len(ids) or ids.max() < 1 << 16 else "<u4").tobytes()


UNIT_SCHEMA = "part int, unit int, doc_ids array<long>, lengths array<long>, payload binary"


def _encoded(docs: DataFrame, tokenizer: str) -> DataFrame:
    """Ids of whole documents, each with its end id, in payloads of many documents."""
    limit = token_files.PAYLOAD_IDS

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = token_files.memory(tokenizer, ENTRIES, True)
        end = np.array([END_ID], "<u4").tobytes()
        part, unit = TaskContext.get().partitionId(), 0
        ids, names, lengths, held = [], [], [], 0

        def close() -> pa.RecordBatch:
            packed = _flat(np.frombuffer(b"".join(ids), "<u4"))
            columns = [[part], [unit], [names], [lengths], [packed]]
            types = [pa.int32(), pa.int32(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.binary()]
            return pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, types, strict=True)],
                names=["part", "unit", "doc_ids", "lengths", "payload"],
            )

        for batch in batches:
            for piece in slices(batch):
                for name, text in zip(
                    piece.column("doc_id").to_pylist(), texts_of(piece), strict=True
                ):
                    got = encoder.ids(text)
                    ids += (got, end)
                    names.append(name)
                    lengths.append(len(got) // 4 + 1)
                    held += lengths[-1]
                    if held >= limit:
                        yield close()
                        unit += 1
                        ids, names, lengths, held = [], [], [], 0
        if names:
            yield close()

    return id_and_text(docs).mapInArrow(run, UNIT_SCHEMA)


def _remainders(units: DataFrame, capacity: int) -> DataFrame:
    """A row per unit and length of remainder: ``n`` documents and their ``chunks`` whole sequences."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # Encoding is over: workers need no longer hold what they remembered for it.
        token_files.forget()
        for batch in batches:
            for row in batch.to_pylist():
                chunks, r = np.divmod(np.array(row["lengths"], np.int64), capacity)
                lengths, of, n = np.unique(r, return_inverse=True, return_counts=True)
                whole = np.bincount(of, chunks, len(lengths)).astype(np.int64)
                same = [pa.array([row[k]] * len(lengths), pa.int32()) for k in ("part", "unit")]
                yield pa.RecordBatch.from_arrays(
                    [*same, pa.array(lengths), pa.array(n), pa.array(whole)],
                    names=["part", "unit", "r", "n", "chunks"],
                )

    schema = "part int, unit int, r long, n long, chunks long"
    return units.select("part", "unit", "lengths").mapInArrow(run, schema)


def _placed_units(units: DataFrame, plan: Plan, counts: DataFrame) -> DataFrame:
    """part, unit, first rank of each length, and what stands before the unit: whole sequences,
    and tokens of remainders that no pattern takes.

    counts: a row per unit and remainder: ``n`` documents, ``chunks`` whole sequences.
    """
    spark = units.sparkSession
    # At most one row per length below the capacity.
    quota = spark.createDataFrame(
        [(r, int(q)) for r, q in enumerate(plan.quota.tolist()) if q] or [(-1, 0)],
        "of long, quota long",
    )
    same = Window.partitionBy("r").orderBy("part", "unit")
    before = same.rowsBetween(Window.unboundedPreceding, -1)
    ranked = counts.withColumn("rank", F.coalesce(F.sum("n").over(before), F.lit(0)))
    quota_of = F.coalesce("quota", F.lit(0))
    beyond = F.greatest(F.lit(0), F.col("rank") + F.col("n") - F.greatest("rank", quota_of))
    by_unit = (
        ranked.join(F.broadcast(quota), ranked["r"] == quota["of"], "left")
        .groupBy("part", "unit")
        .agg(
            F.collect_list(F.struct("r", "rank")).alias("ranks"),
            F.sum(beyond * F.col("r")).alias("rest"),
            F.sum("chunks").alias("chunks"),
        )
    )
    by_unit = stored(by_unit)
    # Sums over the units of a part, then over parts: one row per file of the encoded table.
    parts = by_unit.groupBy("part").agg(F.sum("rest").alias("rest"), F.sum("chunks").alias("chunks"))
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    inside = Window.partitionBy("part").orderBy("unit").rowsBetween(Window.unboundedPreceding, -1)

    def summed(column: str, over) -> Column:
        return F.coalesce(F.sum(column).over(over), F.lit(0))

    first = parts.select(
        "part", summed("rest", earlier).alias("rest0"), summed("chunks", earlier).alias("chunks0")
    )
    return by_unit.join(first, "part").select(
        "part",
        "unit",
        "ranks",
        (F.col("rest0") + summed("rest", inside)).alias("rest_at"),
        (F.col("chunks0") + summed("chunks", inside)).alias("chunk_at"),
    )


def _rest_pieces(begin: int, length: int, ends: list[int], capacity: int):
    """(from, to, sequence, offset) of a remainder in the row of those that no pattern takes."""
    at, stop = begin, begin + length
    while at < stop:
        sequence = at // capacity
        low, high = sequence * capacity, (sequence + 1) * capacity
        if ends and high > ends[-1]:
            k = next(i for i, end in enumerate(ends) if end > at)
            sequence, low, high = sequence + k, ends[k - 1] if k else low, ends[k]
        to = min(stop, high)
        yield at - begin, to - begin, sequence, at - low
        at = to


PIECE_SCHEMA = (
    "doc_id long, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long"
)


def pack(docs: DataFrame, tokenizer: str | None = None, capacity: int = CAPACITY) -> DataFrame:
    """The pieces of all documents in their sequences, with their ids.

    Per piece: doc_id, start and length in the document, ids (little-endian unsigned 32-bit),
    doc_tokens (with the end id), sequence_id and the offset there. Sequences are full, but for the
    last few, whose lengths are powers of two. A missing or empty text is its end id alone;
    repeated rows are packed each for itself, a missing doc_id stays missing; an empty table has
    no pieces. Further columns are left out.
    """
    tokenizer = tokenizer or public_tokenizers.path("byte_bpe_50k.json")
    spark = docs.sparkSession
    encoded = stored(_encoded(docs, tokenizer))
    counts = stored(_remainders(encoded, capacity))
    # No more rows than lengths below the capacity come to the driver.
    histogram = np.zeros(capacity, np.int64)
    for row in counts.groupBy("r").agg(F.sum("n").alias("n")).collect():
        histogram[row.r] = row.n
    plan = Plan.of(patterns(histogram, capacity), capacity)
    rest = int(((histogram - plan.quota) * np.arange(capacity)).sum())
    ends = stretch_ends(rest, capacity)
    after_rest = plan.sequences + rest // capacity + len(ends)
    sent = spark.sparkContext.broadcast((plan, ends, after_rest))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        token_files.forget()
        for batch in batches:
            for row in range(batch.num_rows):
                yield from _pieces(batch.slice(row, 1).to_pylist()[0], *sent.value, capacity)

    # The same join at every size: what is joined to the payloads grows with them.
    firsts = _placed_units(encoded, plan, counts).hint("merge")
    placed = encoded.join(firsts, ["part", "unit"])
    return placed.mapInArrow(run, PIECE_SCHEMA)


def _pieces(
    unit: dict, plan: Plan, ends: list[int], after_rest: int, capacity: int
) -> Iterator[pa.RecordBatch]:
    """Pieces of a payload's documents."""
    names = unit["doc_ids"]
    tokens = np.array(unit["lengths"], np.int64)
    first = np.cumsum(tokens) - tokens
    wide = len(unit["payload"]) == 4 * int(tokens.sum())
    ids = np.frombuffer(unit["payload"], "<u4" if wide else "<u2").astype("<u4")
    r = tokens % capacity
    base = np.zeros(capacity, np.int64)
    for known in unit["ranks"]:
        base[known["r"]] = known["rank"]
    # A document's rank: those of its length before the unit, and before it in the unit.
    by = np.argsort(r, kind="stable")
    new = np.append(True, r[by][1:] != r[by][:-1])
    place = np.arange(len(r))
    rank = np.empty(len(r), np.int64)
    rank[by] = place - np.maximum.accumulate(np.where(new, place, 0))
    rank += base[r]
    taken = (r > 0) & (rank < plan.quota[r])
    sequence, offset = np.zeros(len(r), np.int64), np.zeros(len(r), np.int64)
    if taken.any():
        sequence[taken], offset[taken] = plan.place(r[taken], rank[taken])
    loose = np.where(taken, 0, r)
    rest_at = (unit["rest_at"] + np.cumsum(loose) - loose).tolist()
    chunks = tokens // capacity
    chunk_at = (after_rest + unit["chunk_at"] + np.cumsum(chunks) - chunks).tolist()

    columns: list[list] = [[] for _ in range(7)]
    held = 0

    def add(i: int, begin: int, end: int, to: int, at: int) -> None:
        nonlocal held
        raw = ids[first[i] + begin : first[i] + end].tobytes()
        values = (names[i], begin, end - begin, raw, int(tokens[i]), to, at)
        for column, value in zip(columns, values, strict=True):
            column.append(value)
        held += end - begin

    def out() -> pa.RecordBatch:
        types = [pa.int64()] * 3 + [pa.binary()] + [pa.int64()] * 3
        return pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(columns, types, strict=True)],
            names=[c.split()[0] for c in PIECE_SCHEMA.split(", ")],
        )

    for i in range(len(names)):
        whole = int(chunks[i])
        for k in range(whole):
            add(i, k * capacity, (k + 1) * capacity, chunk_at[i] + k, 0)
            if held >= OUT_IDS:
                yield out()
                columns, held = [[] for _ in range(7)], 0
        start, size = whole * capacity, int(r[i])
        if taken[i]:
            add(i, start, start + size, int(sequence[i]), int(offset[i]))
        elif size:
            for begin, end, to, at in _rest_pieces(rest_at[i], size, ends, capacity):
                add(i, start + begin, start + end, plan.sequences + to, at)
    if columns[0]:
        yield out()
