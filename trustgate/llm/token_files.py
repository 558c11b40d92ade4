"""Token ids in blocks of patched frame-of-reference, written to files and read back.

A payload holds consecutive ids in blocks of ``BLOCK``. Each block stores its minimum; the
differences to it are packed with the width that holds the given percentile of them, and the
outliers go to an exception list of positions and whole differences. An index in front of the
blocks has their starts, minima, widths and exception counts, so any block can be read alone.

Layout, little-endian: magic ``PFR1``, ids, blocks, then per block u32 start, u32 minimum,
u8 width, u16 exceptions (each as one array), then the blocks: packed bits, u8 positions,
u32 differences.
"""

from __future__ import annotations

import os
import re
import zlib
from array import array
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import public_tokenizers
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from trustgate.llm.common import id_and_text, shared_folder, slices, texts_of
from trustgate.llm.pieces import ENTRIES, LIMIT, TextMemory

MAGIC = b"PFR1"
BLOCK = 256
PERCENTILE = 90
#: Ids after which a payload is closed at the end of a document.
PAYLOAD_IDS = 1 << 18
END_ID = 0
#: Marks a pre-token whose bytes are already shown as characters; no plain piece holds it.
SHOWN = "\x00"
#: Blocks (un)packed at once; bounds memory for one very long document.
STEP = 1 << 12

_HEAD = 12
_ENTRY = 11


def pack(ids: np.ndarray, percentile: int = PERCENTILE) -> bytes:
    """Ids (unsigned 32 bits) as a payload."""
    n = len(ids)
    blocks = -(-n // BLOCK)
    padded = np.zeros(blocks * BLOCK, np.uint32)
    padded[:n] = ids
    padded[n:] = ids[-1] if n else 0
    grid = padded.reshape(blocks, BLOCK)
    low = grid.min(axis=1) if blocks else np.zeros(0, np.uint32)
    at = BLOCK * percentile // 100
    widths, counts, bodies = np.zeros(blocks, np.uint8), np.zeros(blocks, np.uint16), []
    for first in range(0, blocks, STEP):
        part = slice(first, min(first + STEP, blocks))
        diff = grid[part] - low[part, None]
        if not len(diff) or diff.max() < 1 << 16:
            diff = diff.astype(np.uint16)
        lane = diff.itemsize
        # The width of the percentile is that of the value there; frexp gives its bit length.
        width = np.frexp(np.partition(diff, at, axis=1)[:, at].astype(np.float64))[1]
        outlier = diff > ((1 << width.astype(np.int64)) - 1)[:, None]
        widths[part], counts[part] = width, outlier.sum(axis=1)
        plain = np.where(outlier, 0, diff).astype(f">u{lane}")
        packed: list[bytes] = [b""] * len(diff)
        for w in np.unique(width).tolist():
            if w == 0:
                continue
            rows = np.flatnonzero(width == w)
            raw = plain[rows].view(np.uint8).reshape(len(rows), -1)
            if w < 8 * lane:
                bits = np.unpackbits(raw, axis=1).reshape(len(rows), BLOCK, 8 * lane)
                raw = np.packbits(bits[:, :, 8 * lane - w :].reshape(len(rows), -1), axis=1)
            whole, size = raw.tobytes(), BLOCK * w // 8
            for k, r in enumerate(rows.tolist()):
                packed[r] = whole[k * size : (k + 1) * size]
        places, values = np.nonzero(outlier)[1].astype(np.uint8), diff[outlier].astype("<u4")
        places, values = places.tobytes(), values.tobytes()
        ends = np.cumsum(counts[part], dtype=np.int64)
        for r, (b, e) in enumerate(zip((ends - counts[part]).tolist(), ends.tolist(), strict=True)):
            bodies.append(packed[r] + places[b:e] + values[4 * b : 4 * e])
    sizes = np.array([len(b) for b in bodies], np.int64)
    starts = _HEAD + _ENTRY * blocks + np.cumsum(sizes) - sizes
    return b"".join(
        [
            MAGIC,
            np.array([n, blocks], "<u4").tobytes(),
            starts.astype("<u4").tobytes(),
            low.astype("<u4").tobytes(),
            widths.tobytes(),
            counts.astype("<u2").tobytes(),
            *bodies,
        ]
    )


def unpack(payload: bytes) -> np.ndarray:
    """All ids of a payload."""
    if payload[:4] != MAGIC:
        raise ValueError("not a payload of packed ids")
    n, blocks = np.frombuffer(payload, "<u4", 2, 4).tolist()
    at = _HEAD
    starts = np.frombuffer(payload, "<u4", blocks, at).astype(np.int64)
    low = np.frombuffer(payload, "<u4", blocks, at + 4 * blocks)
    widths = np.frombuffer(payload, np.uint8, blocks, at + 8 * blocks)
    counts = np.frombuffer(payload, "<u2", blocks, at + 9 * blocks).astype(np.int64)
    out = np.zeros((blocks, BLOCK), np.uint32)
    for w in np.unique(widths).tolist():
        rows, size = np.flatnonzero(widths == w), BLOCK * w // 8
        lane = 2 if w <= 16 else 4
        for first in range(0, len(rows) if w else 0, STEP):
            some = rows[first : first + STEP]
            begins = starts[some].tolist()
            packed = np.frombuffer(b"".join([payload[b : b + size] for b in begins]), np.uint8)
            if w < 8 * lane:
                bits = np.zeros((len(some), BLOCK, 8 * lane), np.uint8)
                plain = np.unpackbits(packed).reshape(len(some), BLOCK, w)
                bits[:, :, 8 * lane - w :] = plain
                packed = np.packbits(bits)
            out[some] = packed.view(f">u{lane}").reshape(len(some), BLOCK)
    bodies = starts + BLOCK * widths.astype(np.int64) // 8
    for r in np.flatnonzero(counts).tolist():
        c, b = int(counts[r]), int(bodies[r])
        out[r, np.frombuffer(payload, np.uint8, c, b)] = np.frombuffer(payload, "<u4", c, b + c)
    return (out + low[:, None].astype(np.uint32)).reshape(-1)[:n]


class FileMemory(TextMemory):
    """Ids of texts by a tokenizer file, whose added tokens are found before all else."""

    def __init__(
        self, split, encode, tokenizer, entries: int = ENTRIES, recurring: bool = False
    ):
        super().__init__(split, encode, entries, recurring)
        self.tokenizer = tokenizer
        added = [t for t in tokenizer.get_added_tokens_decoder().values() if t.content]
        self.added = {
            t.content: array("I", [tokenizer.token_to_id(t.content)]).tobytes() for t in added
        }
        #: Those that take white space along or need a word's end are left to the library.
        self.odd = [t.content for t in added if t.single_word or t.lstrip or t.rstrip]
        # Of several that begin at one place the longest counts, as in the library.
        longest = sorted(self.added, key=len, reverse=True)
        self.marks = re.compile(f"({'|'.join(map(re.escape, longest))})") if added else None

    def _marked(self, text: str) -> bytes:
        if any(mark in text for mark in self.odd):
            return array("I", self.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()
        plain = super().ids
        return b"".join(
            self.added[part] if i % 2 else plain(part)
            for i, part in enumerate(self.marks.split(text))
        )

    def ids(self, text: str) -> bytes:
        for mark in self.added:
            if mark in text:
                return self._marked(text)
        return super().ids(text)


class ShownCharacters(dict):
    """Code point -> the characters that show its UTF-8 bytes, for ``str.translate``."""

    def __init__(self, shown: dict[int, int]):
        super().__init__()
        self.shown = shown
        self.update((c, self[c]) for c in range(ord(LIMIT)))

    def __missing__(self, point: int) -> str:
        # Those that plain pieces are made of are held; others are not, so it stays small.
        return chr(point).encode().decode("latin-1").translate(self.shown)


@lru_cache(maxsize=2)
def _library(path: str):
    """A file's tokenizer, and functions that split a piece and encode a pre-token by it."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    if tokenizer.normalizer is not None:
        raise ValueError("texts are cut before encoding, so a normalizer can't be applied")
    cut_up, run = tokenizer.pre_tokenizer.pre_tokenize_str, tokenizer.model.tokenize
    # Byte-level files show printable bytes as themselves, the others as characters from 256 on.
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    others = [b for b in range(256) if b not in plain]
    shown = {b: 256 + i for i, b in enumerate(others)}
    space, line = chr(shown[32]), chr(shown[10])
    characters = ShownCharacters(shown)

    def split(piece: str) -> list[str]:
        """Pre-tokens, which the library gives with bytes shown as characters."""
        return [SHOWN + t for t, _ in cut_up(piece)]

    def encode(token: str) -> bytes:
        if token[0] == SHOWN:
            token = token[1:]
        elif token.isascii():  # letters after a space, signs or a line end
            token = token.replace(" ", space).replace("\n", line)
        else:
            token = token.translate(characters)
        return array("I", [t.id for t in run(token)]).tobytes()

    return split, encode, tokenizer


@lru_cache(maxsize=1)
def memory(path: str, entries: int = ENTRIES, recurring: bool = False) -> FileMemory:
    """A worker's encoder by the library's pre-tokenizer and model, which remembers what it encodes.

    Workers outlive a stage: a later stage's tasks ``forget`` what they no longer need.
    """
    return FileMemory(*_library(path), entries, recurring)


def forget() -> None:
    """Free the worker's memory of encoded pieces."""
    memory.cache_clear()


def encode_text(text: str, path: str) -> np.ndarray:
    """The library's ids of a whole text, piece by piece (see ``pieces``)."""
    return np.frombuffer(memory(path).ids(text), "<u4")


FILE_SCHEMA = (
    "part int, payload_no int, first long, n_ids long, doc_ids array<long>, lengths array<long>,"
    " payload binary"
)
_ARROW = pa.schema(
    [
        ("part", pa.int32()),
        ("payload_no", pa.int32()),
        ("first", pa.int64()),
        ("n_ids", pa.int64()),
        ("doc_ids", pa.list_(pa.int64())),
        ("lengths", pa.list_(pa.int64())),
        ("payload", pa.binary()),
    ]
)


def write_token_files(
    docs: DataFrame, tokenizer: str | None = None, path: str | None = None
) -> str:
    """Encode every document and write payloads in ascending order of doc_id; return the folder.

    Files are Parquet files that hold payloads beside the ids and lengths of their documents:
    the committer then takes care of lost executors, and any store that Spark writes to will do.
    ``part`` counts the files in order, ``first`` the ids of a file before the payload.

    A missing text counts as empty and yields the end id alone. Missing ids come first, equal
    ids stand by their texts' hashes, equal rows are all written. An empty table writes no
    payload. A document's ids are never split between payloads.
    """
    tokenizer = tokenizer or public_tokenizers.path("byte_bpe_50k.json")
    spark = docs.sparkSession
    path = path or shared_folder(spark)
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        first = number = held = 0
        ids, names, lengths = [], [], []

        def close() -> pa.RecordBatch:
            row = {
                "part": part,
                "payload_no": number,
                "first": first,
                "n_ids": held,
                "doc_ids": names,
                "lengths": lengths,
                "payload": pack(np.frombuffer(b"".join(ids), "<u4")),
            }
            return pa.RecordBatch.from_pylist([row], _ARROW)

        end, encoder = np.array([END_ID], "<u4").tobytes(), memory(tokenizer)
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
                    if held >= PAYLOAD_IDS:
                        yield close()
                        first, number, held = first + held, number + 1, 0
                        ids, names, lengths = [], [], []
        if names:
            yield close()

    (
        id_and_text(docs)
        .withColumn("_tie", F.xxhash64("text"))
        .repartitionByRange(parts, "doc_id", "_tie")
        .sortWithinPartitions("doc_id", "_tie")
        .drop("_tie")
        .mapInArrow(run, FILE_SCHEMA)
        .write.parquet(path)
    )
    return path


READ_SCHEMA = "doc_id long, start long, n_tokens long, ids_crc32 long"


def _with_offsets(files: DataFrame) -> DataFrame:
    # One row per written file, however long the corpus is: small enough for one window.
    totals = files.groupBy("part").agg(F.sum("n_ids").alias("n"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(
        F.col("part"), F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset")
    )
    return files.join(F.broadcast(offsets), "part")


def read_token_files(spark, path: str) -> DataFrame:
    """Per document of the files: its place among all ids, its ids' number and checksum."""
    files = spark.read.schema(FILE_SCHEMA).parquet(path)
    chosen = _with_offsets(files).select(
        (F.col("offset") + F.col("first")).alias("first"), "doc_ids", "lengths", "payload"
    )

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget()
        for batch in batches:
            for i in range(batch.num_rows):
                start = batch.column("first")[i].as_py()
                names = batch.column("doc_ids")[i].as_py()
                lengths = np.array(batch.column("lengths")[i].as_py(), np.int64)
                ids = unpack(batch.column("payload")[i].as_py()).astype("<u4")
                ends = np.cumsum(lengths)
                begins = ends - lengths
                sums = [zlib.crc32(ids[b:e]) for b, e in zip(begins, ends, strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(names, pa.int64()),
                        pa.array(begins + start),
                        pa.array(lengths),
                        pa.array(sums, pa.int64()),
                    ],
                    names=["doc_id", "start", "n_tokens", "ids_crc32"],
                )

    return chosen.mapInArrow(run, READ_SCHEMA)
