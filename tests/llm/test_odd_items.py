"""Short, number-dense and name-first benchmark items against a search for their words."""

from __future__ import annotations

import random

from trustgate.llm import templates

ITEMS = [
    "What is 12 times 7?",
    "Which planet is closest to the sun?",
    "Name it",
    "Paris Berlin 12 km 7 kg Rome 9 days Oslo 3 hours and 4 litres",
    "12 34 56 78 90 11 13 15 17",
    "Anna buys 5 pens and 3 books in town",
]


def _core(text: str) -> str:
    cores = (templates.core_of(w).lower() for w in text.encode().split())
    return f" {' '.join(c for c in cores if c)} "


def test_verbatim_items_are_found_wherever_they_stand():
    rng = random.Random(8)
    index = templates.Index(list(enumerate(ITEMS)))
    fill = ["Question 12\n", "so", "Then.", "Heading\n", "see:", "and Bob\n", "40 km", "\n\n"]
    for _ in range(400):
        parts = rng.choices(fill, k=6)
        for item in rng.choices(ITEMS, k=rng.randint(0, 2)):
            parts.insert(rng.randrange(7), rng.choice([item, item.lower(), item.replace(" ", "\n")]))
        text = " ".join(parts)
        want = {i for i, item in enumerate(ITEMS) if _core(item) in _core(text)}
        assert want <= {x[1] for x in index.leaks([text])}
    assert not index.leaks(["What is 9 times 8? 12 34 56 78 21 22 23 24 25 Name"])


def test_a_name_may_start_a_sentence():
    index = templates.Index(list(enumerate(ITEMS)))
    for text in ("So. Bob buys 6 pens and 2 books in town", "say Bob buys 6 pens and 2 books in town"):
        (found,) = index.leaks([text])
        assert found[1] == 5 and found[5]
    dense = "Rome Paris 11 km 8 kg Oslo 7 days Bonn 2 hours of 5 litres and 3 kg or 4 km then 9"
    index = templates.Index([(1, dense)])
    other = dense.replace("11", "61").replace("Bonn", "Kiel").replace("2 hours", "6 hours")
    assert index.leaks([f"so {dense} end"]) and index.leaks([f"so {other} end"])[0][5]
