"""All turns of a window, repeated ones too, against the budget."""

from __future__ import annotations

import random

import public_tokenizers
import pytest
from pyspark.sql import functions as F

from trustgate.llm import chat, token_files

PATH = public_tokenizers.path("byte_bpe_50k.json")


def tokens(text: str) -> int:
    return len(token_files.encode_text(text, PATH)) + chat.TURN_TOKENS


@pytest.mark.parametrize("system", [0, 5, 200, 480, 900, 3000])
def test_windows_keep_their_budget(spark, system):
    """Only a turn that is over the budget by itself makes a window that is, and stands alone."""
    rng = random.Random(9)
    rows = [(c, 0, "system", "be " * system) for c in range(4) if system]
    rows += [
        (c, i, ("user", "assistant")[i % 2], "w " * rng.choice((3, 40, 300, 500, 900, 1500)))
        for c in range(4)
        for i in range(1, 50)
    ]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    windows = chat.format_chats(turns)
    seen, again, whole = [], 0, 0
    for w in windows.orderBy(F.col("conv_id"), F.col("span")).collect():
        parsed = chat.parse(w.formatted)
        fresh = [text for _, text in parsed[w.n_again :]]
        seen += [(w.conv_id, t) for t in fresh]
        sizes = [tokens(t) for _, t in parsed]
        whole += sum(sizes) <= chat.BUDGET
        again += w.n_again
        assert sum(sizes) <= chat.BUDGET or len(sizes) == 1
        if w.span and parsed[0][0] == "system":
            assert parsed[0][1] == "be " * system
    assert seen == [(c, t) for c, _, _, t in sorted(rows, key=lambda r: (r[0], r[1]))]
    assert whole > 20 and again > 0


def test_a_small_system_turn_is_repeated(spark):
    rows = [(1, 0, "system", "be brief")] + [(1, i, "user", "word " * 200) for i in range(1, 30)]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    windows = chat.format_chats(turns).collect()
    assert len(windows) > 5
    assert all(chat.parse(w.formatted)[0] == ("system", "be brief") for w in windows)
    # Two or three turns of 216 tokens beside the system turn and history: windows aren't near empty.
    assert sum(tokens(t) for w in windows for _, t in chat.parse(w.formatted)) > 0.5 * chat.BUDGET * len(windows)
