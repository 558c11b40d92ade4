"""Byte-level BPE by ranks: a minimal perfect hash for whole pre-tokens, a heap for the rest.

Tier one looks a pre-token up in a minimal perfect hash over the vocabulary (hash and displace:
buckets of keys get a displacement that puts all of them on free slots; single keys get one of
the last free slots outright). The slot's key is compared, so strangers are told apart. Tier two
merges a missing pre-token's bytes: a doubly linked list of parts and a heap of adjacent pairs
by rank and place, stale entries skipped when they come up.
"""

from __future__ import annotations

import base64
from array import array
from collections.abc import Callable
from functools import cached_property, lru_cache
from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import public_tokenizers
import regex
import xxhash
from pyspark.sql import DataFrame

from trustgate.llm.common import map_texts, texts_of
from trustgate.llm.pieces import TextMemory


#: Entries of one generation of a task's memory; it ends with the task, as workers outlive a stage.
ENTRIES = 400_000
#: Rows decoded at once.
DECODE_ROWS = 256


class PerfectHash:
    """Keys (bytes) to their values through n slots for n keys, without empty ones."""

    def __init__(self, items: dict[bytes, int]):
        self.size = n = len(items)
        self.keys: list[bytes] = [b""] * n
        self.values: list[int] = [-1] * n
        self.buckets = max(1, n // 2)
        #: Of each bucket: a displacement from 0, or -1 - slot for a bucket of one key.
        self.shift = [0] * self.buckets
        groups: dict[int, list[tuple[int, bytes]]] = {}
        for key in items:
            h = xxhash.xxh64_intdigest(key)
            groups.setdefault(h % self.buckets, []).append((h, key))
        taken = bytearray(n)
        alone = []
        for bucket, members in sorted(groups.items(), key=lambda g: -len(g[1])):
            if len(members) == 1:
                alone.append((bucket, members[0][1]))
                continue
            shift = 0
            while True:
                slots = {self._slot(h, shift) for h, _ in members}
                if len(slots) == len(members) and not any(taken[s] for s in slots):
                    break
                shift += 1
            self.shift[bucket] = shift
            for h, key in members:
                self._put(self._slot(h, shift), key, items[key], taken)
        free = (s for s in range(n) if not taken[s])
        for (bucket, key), slot in zip(alone, list(free), strict=True):
            self.shift[bucket] = -1 - slot
            self._put(slot, key, items[key], taken)

    def _slot(self, h: int, shift: int) -> int:
        # The upper half steps through the slots; an added constant keeps equal halves apart.
        return ((h & 0xFFFFFFFF) + shift * ((h >> 32) | 1) + shift * shift * 7919) % self.size

    def _put(self, slot: int, key: bytes, value: int, taken: bytearray) -> None:
        taken[slot] = 1
        self.keys[slot], self.values[slot] = key, value

    def get(self, key: bytes) -> int:
        """The key's value, or -1 for a key that was not given."""
        if not self.size:
            return -1
        h = xxhash.xxh64_intdigest(key)
        shift = self.shift[h % self.buckets]
        slot = -1 - shift if shift < 0 else self._slot(h, shift)
        return self.values[slot] if self.keys[slot] == key else -1


def merge(token: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Ids of a pre-token by merging the lowest-ranked, then leftmost, adjacent pair."""
    n = len(token)
    get = ranks.get
    #: The part at i is token[i:after[i]]; before[i] is the start of the part to its left.
    after, before = list(range(1, n + 2)), list(range(-1, n))
    #: Rank of the pair that starts with the part at i, or -1; a heap entry is rank * n + i.
    pair = [get(token[i : i + 2], -1) for i in range(n - 1)]
    heap = [rank * n + i for i, rank in enumerate(pair) if rank >= 0]
    heapify(heap)
    pair.append(-1)
    while heap:
        rank, i = divmod(heappop(heap), n)
        if pair[i] != rank:  # merged away, or its right part has grown since
            continue
        middle = after[i]
        end = after[i] = after[middle]
        pair[middle] = -1
        rank = -1
        if end < n:
            before[end] = i
            rank = get(token[i : after[end]], -1)
            if rank >= 0:
                heappush(heap, rank * n + i)
        pair[i] = rank
        left = before[i]
        if left >= 0:
            rank = pair[left] = get(token[left:end], -1)
            if rank >= 0:
                heappush(heap, rank * n + left)
    out, i = [], 0
    while i < n:
        out.append(ranks[token[i : after[i]]])
        i = after[i]
    return out


class Codec:
    """Encoder and decoder over one file of ranks; what only one of them needs is made on use."""

    def __init__(self, path: str, pattern: str):
        with open(path, "rb") as f:
            pairs = (line.split() for line in f if line.strip())
            self.ranks = {base64.b64decode(key): int(rank) for key, rank in pairs}
        self.pattern = pattern
        self.bytes_of = [b""] * (max(self.ranks.values(), default=-1) + 1)
        for key, rank in self.ranks.items():
            self.bytes_of[rank] = key

    @cached_property
    def whole(self) -> PerfectHash:
        return PerfectHash(self.ranks)

    def memory(self) -> TextMemory:
        """A new encoder of texts, which remembers what it has encoded."""
        split = regex.compile(self.pattern).findall
        return TextMemory(split, self._token, ENTRIES)

    def _token(self, token: str) -> bytes:
        raw = token.encode()
        known = self.whole.get(raw)
        return array("i", (known,) if known >= 0 else merge(raw, self.ranks)).tobytes()

    def encode(self, text: str) -> bytes:
        """Ids as packed 32-bit integers."""
        return self.memory().ids(text)

    def decode(self, ids: list[int]) -> bytes:
        return b"".join(map(self.bytes_of.__getitem__, ids))


@lru_cache(maxsize=2)
def codec(path: str, pattern: str) -> Codec:
    return Codec(path, pattern)


def _defaults(path: str | None, pattern: str | None) -> tuple[str, str]:
    return (
        path or public_tokenizers.path("byte_bpe_50k.tiktoken"),
        pattern or public_tokenizers.PATTERN,
    )


def _with(batch: pa.RecordBatch, name: str, column: pa.Array) -> pa.RecordBatch:
    kept = [i for i, n in enumerate(batch.schema.names) if n != name]
    return pa.RecordBatch.from_arrays(
        [*[batch.column(i) for i in kept], column],
        names=[*[batch.schema.names[i] for i in kept], name],
    )


def _schema(df: DataFrame, name: str, kind: str) -> str:
    kept = ", ".join(
        f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema if f.name != name
    )
    return f"{kept}, `{name}` {kind}" if kept else f"`{name}` {kind}"


def encode(
    docs: DataFrame, path: str | None = None, pattern: str | None = None, into: str = "ids"
) -> DataFrame:
    """The rows with the ids of their whole ``text`` in the column ``into``.

    A missing or empty text has no ids (an empty array). All other columns are kept; a column
    that is already called ``into`` is replaced. Repeated rows are encoded alike.
    """
    path, pattern = _defaults(path, pattern)

    def make() -> Callable[[pa.RecordBatch], pa.RecordBatch]:
        ids = codec(path, pattern).memory().ids

        def work(batch: pa.RecordBatch) -> pa.RecordBatch:
            packed = [ids(t) if t else b"" for t in texts_of(batch)]
            offsets = np.zeros(len(packed) + 1, np.int32)
            np.cumsum([len(p) // 4 for p in packed], out=offsets[1:])
            values = np.frombuffer(b"".join(packed), "<i4")
            return _with(batch, into, pa.ListArray.from_arrays(offsets, values))

        return work

    return map_texts(docs, make, _schema(docs, into, "array<int>"))


def decode(
    encoded: DataFrame,
    path: str | None = None,
    pattern: str | None = None,
    ids: str = "ids",
    into: str = "decoded",
) -> DataFrame:
    """The rows with the bytes of their ids in the column ``into``; no ids give no bytes."""
    path, pattern = _defaults(path, pattern)

    def run(batches):
        own = codec(path, pattern)
        for batch in batches:
            for first in range(0, batch.num_rows, DECODE_ROWS):
                part = batch.slice(first, DECODE_ROWS)
                lists = part.column(ids)
                # A missing list has no elements; offsets of a slice start past zero.
                ends = np.cumsum(pc.fill_null(pc.list_value_length(lists), 0))
                flat = lists.flatten().to_numpy(zero_copy_only=False).tolist()
                column = [
                    own.decode(flat[b:e]) for b, e in zip([0, *ends[:-1]], ends, strict=True)
                ]
                yield _with(part, into, pa.array(column, pa.binary()))

    return encoded.mapInArrow(run, _schema(encoded, into, "binary"))
