"""What the quality stage stores beside its output, and rows that share an id or a text."""

import random
from pathlib import Path

from trustgate.llm import quality

LABELS = "doc_id long, quality int"


def test_stored_counts_hold_no_texts(spark):
    rng = random.Random(4)
    texts = [" ".join(f"{rng.getrandbits(48):x}" for _ in range(400)) for _ in range(400)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    folder = Path(spark.conf.get("spark.checkpoint.dir"))
    before = set(folder.rglob("*.parquet"))
    assert quality.keep_good(docs, spark.createDataFrame([], LABELS)).count() == 400
    new = set(folder.rglob("*.parquet")) - before
    assert new and sum(p.stat().st_size for p in new) < sum(map(len, texts)) / 10


def test_rows_that_share_id_or_text_are_judged_each(spark):
    good, bad = " ".join(f"w{i}" for i in range(60)), "too short"
    rows = [
        (1, good, "en", 0), (1, good, "en", 0), (1, bad, "en", 1), (1, None, "en", 2),
        (None, good, None, 3), (None, good, "en", 4), (None, bad, "en", 5), (2, good, "de", 6),
        (-(1 << 63), good, "en", 7), (3, "", "en", 8),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, _key int")
    kept = quality.keep_good(docs, spark.createDataFrame([], LABELS))
    assert kept.columns == docs.columns
    assert sorted(r._key for r in kept.collect()) == [0, 0, 3, 4, 6, 7]
