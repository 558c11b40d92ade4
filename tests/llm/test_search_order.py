"""The order of suffixes that the search for repeats sorts: packed words or an argsort."""

import numpy as np
import pytest

from trustgate.llm import repeats


@pytest.mark.parametrize("width", [16, 60])
def test_ranks_of_packed_and_of_wide_values(width):
    # 16 bits share a word with a place, 60 bits don't.
    rng = np.random.default_rng(7)
    value = rng.integers(0, 9, 500).astype(np.uint64) << np.uint64(width - 4)
    order, rank = repeats._ranks(value, width)
    assert sorted(order.tolist()) == list(range(500))
    assert (np.diff(value[order].astype(object)) >= 0).all()
    assert rank.tolist() == np.unique(value, return_inverse=True)[1].tolist()


def test_classes_of_windows_are_those_of_their_bytes():
    rng = np.random.default_rng(3)
    base = rng.integers(97, 99, 700).astype(np.uint8).tobytes()
    parts = [base, base[50:400], base[300:] + base[:200], b"a" * 350]
    raw = repeats.GAP.join(parts) + repeats.GAP * (repeats.LENGTH + 1)
    classes = repeats.window_classes(np.frombuffer(raw, np.uint8))
    windows = {}
    for i, kind in enumerate(classes.tolist()):
        window = raw[i : i + repeats.LENGTH]
        if repeats.GAP not in window:
            windows.setdefault(window, set()).add(kind)
    assert all(len(kinds) == 1 for kinds in windows.values())
    assert len(set.union(*windows.values())) == len(windows)
