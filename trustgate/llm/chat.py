"""Chat formatting in budgeted windows.

Tokens are ids of a tokenizer file. A window's budget holds the system turn, repeated history and
new turns together: what the first two need is set aside, and a conversation's prefix sums of
turn tokens are cut at multiples of the rest, which gives spans of whole turns; a turn that lies
across a cut is a span of its own. Each span becomes a window: the system turn again, a limited
number of earlier turns as history as far as the budget goes, then the span's own turns. A window
is over the budget only if a single turn is. Only the assistant turns of the span itself are under
the loss mask, so each is a target once, however often it is repeated.

Template of a turn: ``### role:`` and a line with the text, closed by ``</turn>``. Inside texts
and roles every backslash, ``#`` and ``<`` (in roles ``:`` too) has a backslash before it, so no
text can hold a mark of the template, and removing the backslashes gives it back.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterable, Iterator

import public_tokenizers
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from trustgate.llm import token_files
from trustgate.llm.common import slices, stored

#: Tokens of a window; a turn has those of its text, and TURN_TOKENS for the template.
BUDGET = 1024
TURN_TOKENS = 16
#: A system turn with more than one in so many of the budget's tokens isn't repeated.
SYSTEM_PART = 2
#: Turns, and tokens, of repeated history before a span.
HISTORY_TURNS = 2
HISTORY_TOKENS = 256

TURN_END = "\n</turn>\n"
HEAD = re.compile(r"### ((?:[^\\:]|\\.)*):\n", re.S)
ESCAPED = re.compile(r"\\(.)", re.S)


def _escape(text: Column, marks: str = "#<") -> Column:
    out = F.replace(text, F.lit("\\"), F.lit("\\\\"))
    for mark in marks:
        out = F.replace(out, F.lit(mark), F.lit("\\" + mark))
    return out


def unescape(text: str) -> str:
    return ESCAPED.sub(r"\1", text)


def _counted(turns: DataFrame, tokenizer: str) -> DataFrame:
    """Turns with the number of ids of their text."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = token_files.memory(tokenizer)
        for batch in batches:
            for part in slices(batch):
                sizes = [len(encoder.ids(t)) // 4 for t in part.column("text").to_pylist()]
                columns = [*part.columns, pa.array(sizes, pa.int64())]
                yield pa.RecordBatch.from_arrays(columns, names=[*part.schema.names, "ids"])

    schema = "conv string, conv_id long, turn long, role string, text string, ids long"
    return turns.mapInArrow(run, schema)


def _placed(turns: DataFrame, tokenizer: str) -> DataFrame:
    """Turns with their number ``at`` in the conversation and the tokens ``before`` them.

    Rows are dealt by ranges of conversation and turn, so a long conversation spreads over many
    parts; each part is numbered alone, and a conversation's parts are added up by a few rows.
    """
    parts = int(turns.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    order = ["conv", "turn", "role", "text"]
    named = turns.select(
        F.coalesce(F.col("conv_id").cast("string"), F.lit("-")).alias("conv"),
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").cast("long").alias("turn"),
        F.coalesce("role", F.lit("")).alias("role"),
        F.coalesce("text", F.lit("")).alias("text"),
    )
    # Stored once: dealing by ranges looks at the rows twice.
    counted = stored(_counted(named, tokenizer))
    dealt = stored(
        counted.withColumn("tokens", F.col("ids") + TURN_TOKENS)
        .drop("ids")
        .repartitionByRange(parts, *order)
        .sortWithinPartitions(*order)
        .withColumn("part", F.spark_partition_id())
        .withColumn("row", F.monotonically_increasing_id())
    )
    before = Window.partitionBy("conv").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    sums = dealt.groupBy("part", "conv").agg(
        F.sum("tokens").alias("t"), F.count("*").alias("n")
    )
    starts = sums.select(
        "part",
        "conv",
        F.coalesce(F.sum("t").over(before), F.lit(0)).alias("t0"),
        F.coalesce(F.sum("n").over(before), F.lit(0)).alias("n0"),
    )
    inside = Window.partitionBy("part", "conv").orderBy("row")
    running = F.sum("tokens").over(inside.rowsBetween(Window.unboundedPreceding, 0))
    return (
        dealt.join(starts, ["part", "conv"])
        .withColumn("at", F.col("n0") + F.row_number().over(inside) - 1)
        .withColumn("before", F.col("t0") + running - F.col("tokens"))
        .select("conv", "conv_id", "at", "role", "text", "tokens", "before")
    )


def format_chats(
    turns: DataFrame,
    budget: int = BUDGET,
    history_turns: int = HISTORY_TURNS,
    history_tokens: int = HISTORY_TOKENS,
    tokenizer: str | None = None,
) -> DataFrame:
    """One row per window: conv_id, span, formatted text, loss spans, number of repeated turns.

    Loss spans are code points of the formatted text, end exclusive. Turns stand in the order of
    ``turn`` (missing ones first), then role and text; repeated rows all stay. A missing text or
    role counts as empty, a missing conv_id is one more conversation. A turn longer than the
    budget is a window with it alone; a system turn of more than a SYSTEM_PART of the budget stands in
    its own place only. Further columns are left out.
    """
    tokenizer = tokenizer or public_tokenizers.path("byte_bpe_50k.json")
    placed = stored(_placed(turns, tokenizer))
    is_system = (F.col("at") == 0) & (F.col("role") == "system")
    # One row for each conversation that begins with a system turn to repeat.
    systems = placed.where(is_system & (F.col("tokens") * SYSTEM_PART <= budget)).select(
        F.col("conv").alias("of"), F.col("tokens").alias("system")
    )
    placed = placed.join(systems, placed["conv"] == systems["of"], "left").drop("of")
    aside = F.coalesce("system", F.lit(0))
    room = F.greatest(F.lit(1), F.lit(budget) - aside - F.least(F.lit(history_tokens), (budget - aside) / 2))
    cell = F.floor(F.col("before") / room)
    across = (F.col("before") + F.col("tokens") > (cell + 1) * room).cast("long")
    placed = stored(
        placed.withColumns({"span": (cell * 2 + across).cast("long"), "system": aside})
    )
    spans = placed.groupBy("conv", "span").agg(
        F.min("at").alias("first"),
        F.min("before").alias("first_before"),
        F.sum("tokens").alias("own"),
        F.max("system").alias("system"),
    )
    # What a span's own turns leave: for the system turn first, then for history.
    left = F.lit(budget) - F.col("own")
    later = spans.where("first > 0").withColumn(
        "kept", F.when((F.col("system") > 0) & (F.col("system") <= left), F.col("system")).otherwise(0)
    )
    later = later.withColumn("for_history", left - F.col("kept"))
    new = placed.select("conv", "conv_id", "span", "at", "role", "text", F.lit(False).alias("again"))
    wanted = later.select(
        "conv",
        F.col("span").alias("into"),
        "first_before",
        F.least(F.col("for_history"), F.lit(history_tokens)).alias("most"),
        F.explode(
            F.sequence(F.greatest(F.col("first") - history_turns, F.lit(0)), F.col("first") - 1)
        ).alias("at"),
    )
    history = (
        placed.join(wanted, ["conv", "at"])
        .where(F.col("first_before") - F.col("before") <= F.col("most"))
        .where(~is_system)
    )
    system = placed.where(is_system).join(
        later.where("kept > 0").select("conv", F.col("span").alias("into")), "conv"
    )
    members = new
    for extra in (history, system):
        members = members.union(
            extra.select("conv", "conv_id", "into", "at", "role", "text", F.lit(True))
        )
    body = _escape(F.col("text"))
    head = F.concat(F.lit("### "), _escape(F.col("role"), "#<:"), F.lit(":\n"))
    shown = members.select(
        "conv",
        "conv_id",
        "span",
        F.struct(
            "at",
            F.concat(head, body, F.lit(TURN_END)).alias("shown"),
            F.length(head).alias("lead"),
            F.length(body).alias("long"),
            (~F.col("again") & (F.col("role") == "assistant")).alias("target"),
            "again",
        ).alias("turn"),
    )
    # A group holds one window, which the budget bounds.
    windows = shown.groupBy("conv", "conv_id", "span").agg(
        F.sort_array(F.collect_list("turn")).alias("turns")
    )
    spot = "acc.at + x.lead"
    loss = F.expr(
        f"""aggregate(turns,
          named_struct('at', 0, 'loss', cast(array() as array<struct<start: int, end: int>>)),
          (acc, x) -> named_struct('at', acc.at + length(x.shown), 'loss', if(x.target,
            concat(acc.loss, array(named_struct('start', {spot}, 'end', {spot} + x.long))),
            acc.loss)),
          acc -> acc.loss)"""
    )
    return windows.select(
        "conv",
        "conv_id",
        "span",
        F.array_join(F.transform("turns", lambda x: x["shown"]), "").alias("formatted"),
        loss.alias("loss"),
        F.size(F.filter("turns", lambda x: x["again"])).alias("n_again"),
    )


def parse(formatted: str) -> list[tuple[str, str]]:
    """(role, text) of the turns of a formatted window."""
    turns = []
    for shown in formatted.split(TURN_END)[:-1]:
        head = HEAD.match(shown)
        turns.append((unescape(head[1]), unescape(shown[head.end() :])))
    return turns


READ_SCHEMA = (
    "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string,"
    " formatted_chars long, n_windows long"
)


def read_chats(windows: DataFrame) -> DataFrame:
    """One row per conversation, read back from its windows: turns and targets, digested.

    A conversation's windows stream through one task in order, for a digest has to be fed in
    order; only the current window and the running digests are held.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now = None
        for batch in batches:
            rows = []
            for row in batch.to_pylist():
                if now is None or now["conv"] != row["conv"]:
                    if now is not None:
                        rows.append(_closed(now))
                    now = {
                        "conv": row["conv"],
                        "conv_id": row["conv_id"],
                        "turns": hashlib.sha256(),
                        "loss": hashlib.sha256(),
                        "counts": [0, 0, 0, 0],
                    }
                formatted, counts = row["formatted"], now["counts"]
                fresh = parse(formatted)[row["n_again"] :]
                for role, text in fresh:
                    now["turns"].update(f"{role}\n{text}\n".encode())
                for span in row["loss"]:
                    text = unescape(formatted[span["start"] : span["end"]])
                    now["loss"].update(text.encode())
                    counts[1] += len(text)
                counts[0] += len(fresh)
                counts[2] += len(formatted)
                counts[3] += 1
            if rows:
                yield _batch(rows)
        if now is not None:
            yield _batch([_closed(now)])

    return (
        windows.repartition("conv")
        .sortWithinPartitions("conv", "span")
        .mapInArrow(run, READ_SCHEMA)
    )


def _closed(now: dict) -> tuple:
    n, loss_chars, chars, windows = now["counts"]
    return (
        now["conv_id"],
        n,
        now["turns"].hexdigest(),
        loss_chars,
        now["loss"].hexdigest(),
        chars,
        windows,
    )


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.int64()]
    return pa.RecordBatch.from_arrays(
        [pa.array(list(c), k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)],
        names=[c.split()[0] for c in READ_SCHEMA.split(", ")],
    )


def format_and_read(turns: DataFrame, **options: int) -> DataFrame:
    """Write the windows of all conversations and read them back."""
    return read_chats(stored(format_chats(turns, **options)))
