"""Quality rules with cutoffs whose share of false rejections is bounded.

Base rules count words, symbols, repeated lines and repeated three-word windows. On top of them,
cutoffs for further features are chosen per stratum (language) on labelled documents: a cutoff
may be used only if an exact binomial test shows, at a level corrected for all tests made, that
it rejects no more than the allowed share of good documents. Among those that pass, the cutoff
that rejects the most bad labelled documents is taken, the loosest one on ties.

Everything is DataFrame and SQL expressions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trustgate.llm.common import stored, unused

#: Feature -> cutoffs from the loosest to the strictest; a document above a cutoff is rejected.
GRID = {
    "symbol_share": (0.5, 0.4, 0.3, 0.25, 0.2, 0.15, 0.12, 0.1, 0.08, 0.06),
    "dup_line_share": (0.9, 0.8, 0.7, 0.6, 0.5, 0.45, 0.4, 0.35, 0.3, 0.25),
    "repeat_share": (0.48, 0.45, 0.42, 0.39, 0.36, 0.33, 0.3, 0.27, 0.24, 0.2),
    "word_chars_mean": (40.0, 30.0, 25.0, 20.0, 18.0, 16.0, 15.0, 14.0, 13.0, 12.0),
    "short_words": (0.9, 0.8, 0.7, 0.6, 0.55, 0.5, 0.47, 0.44, 0.42, 0.4),
}
#: Allowed share of good documents that all features together may reject, and the chance that
#: any of the chosen cutoffs breaks its bound.
ALLOWED = 0.02
CHANCE = 0.05
#: Terms of a binomial tail that are added one by one; the rest is bounded from above.
TERMS = 100_000

BLANK = r"[ \\t-\\r]"
INK = r"[^ \\t-\\r]"


def base_features(docs: DataFrame, text: str = "text", into: str = "q") -> DataFrame:
    """All rows and columns plus a struct of word, symbol and repeat counts of the whole text.

    A missing text counts as empty: no word, no line, no symbol.
    """
    words, whole, packed, many = (
        unused(docs, n) for n in ("_words", "_text", "_packed", "_many")
    )
    quoted = {k: f"`{v}`" for k, v in zip("wtpm", (words, whole, packed, many), strict=True)}
    w, t, p, m = (quoted[k] for k in "wtpm")
    cut = docs.withColumn(whole, F.coalesce(F.col(text), F.lit(""))).withColumn(
        words, F.expr(f"filter(split({t}, '{BLANK}+'), x -> x <> '')")
    )
    # A window's number: 32 bits of its hash over its place. Equal windows get neighbours.
    sorted_windows = cut.withColumn(
        packed,
        F.expr(
            f"case when size({w}) > 3 then sort_array(transform(sequence(0, size({w}) - 3), i ->"
            f" shiftleft(xxhash64({w}[i], {w}[i + 1], {w}[i + 2]) & 4294967295L, 31) | i))"
            " else cast(array() as array<bigint>) end"
        ),
    )
    # Only windows whose hash occurs twice are compared as words, so a shared hash can't count.
    candidates = sorted_windows.withColumn(
        many,
        F.expr(
            f"""sort_array(transform(filter({p}, (x, i) ->
                shiftright(x, 31) = shiftright(get({p}, i - 1), 31)
                or shiftright(x, 31) = shiftright(get({p}, i + 1), 31)),
              x -> named_struct(
                's', concat_ws(' ', {w}[cast(x & 2147483647L as int)],
                  {w}[cast(x & 2147483647L as int) + 1], {w}[cast(x & 2147483647L as int) + 2]),
                'at', cast(x & 2147483647L as int))))"""
        ),
    )
    places = (
        f"sort_array(transform(filter({m}, (x, i) -> x.s = get({m}, i - 1).s"
        f" or x.s = get({m}, i + 1).s), x -> x.at))"
    )
    # Each repeated window covers three words, less where the next one begins earlier.
    covered = (
        f"aggregate(transform(array({places}), d -> transform(d, (at, i) ->"
        " cast(least(3, coalesce(get(d, i + 1) - at, 3)) as bigint)))[0], 0L, (a, x) -> a + x)"
    )
    lines = f"filter(split({t}, '\\n'), x -> x rlike '{INK}')"
    counted = candidates.withColumn(
        into,
        F.expr(
            f"""named_struct(
              'n_words', cast(size({w}) as bigint),
              'word_chars', cast(length(array_join({w}, '')) as bigint),
              'n_symbols', cast(length(regexp_replace({t}, '[^#*$%&|<>]+', '')) as bigint),
              'lines', transform(array({lines}), x -> named_struct('n', cast(size(x) as bigint),
                 'distinct', cast(size(array_distinct(x)) as bigint)))[0],
              'n_repeat_words', {covered})"""
        ),
    )
    q = F.col(into)
    n = q["n_words"]
    result = F.struct(
        n.alias("n_words"),
        q["word_chars"].alias("word_chars"),
        q["n_symbols"].alias("n_symbols"),
        (q["lines"]["n"] - q["lines"]["distinct"]).alias("n_dup_lines"),
        q["n_repeat_words"].alias("n_repeat_words"),
        q["lines"]["n"].alias("n_lines"),
        ((n < 50) | (100 * q["n_repeat_words"] > 50 * n)).alias("base_failed"),
    )
    return counted.withColumn(into, result).drop(words, whole, packed, many)


def shares(q: Column) -> dict[str, Column]:
    """The features that cutoffs are chosen for, each higher for worse texts."""
    n = F.greatest(q["n_words"], F.lit(1)).cast("double")
    chars = F.greatest(q["word_chars"], F.lit(1)).cast("double")
    return {
        "symbol_share": q["n_symbols"] / chars,
        "dup_line_share": q["n_dup_lines"] / F.greatest(q["n_lines"], F.lit(1)).cast("double"),
        "repeat_share": q["n_repeat_words"] / n,
        "word_chars_mean": q["word_chars"] / n,
        "short_words": n / chars,
    }


def log_factorial(x: Column) -> Column:
    """ln x! by Stirling's series at x + 9, to about 13 digits."""
    z = x + F.lit(9.0)
    series = (
        F.lit(1 / 12) / z
        - F.lit(1 / 360) / F.pow(z, F.lit(3))
        + F.lit(1 / 1260) / F.pow(z, F.lit(5))
        - F.lit(1 / 1680) / F.pow(z, F.lit(7))
    )
    product = x + 1.0
    for i in range(2, 9):
        product = product * (x + float(i))
    return (z - 0.5) * F.log(z) - z + F.lit(0.9189385332046727) + series - F.log(product)


def binomial_tail(k: Column, n: Column, share: float) -> Column:
    """P(at most k of n) for a chance of ``share`` each; 1 where k isn't below the mean.

    Terms are added from the k-th down, each from the one before; what lies beyond TERMS is
    replaced by a geometric sum that is larger, so a test based on it stays on the safe side.
    """
    kd, nd = k.cast("double"), n.cast("double")
    odds = (1 - share) / share
    top = (
        log_factorial(nd)
        - log_factorial(kd)
        - log_factorial(nd - kd)
        + kd * F.log(F.lit(share))
        + (nd - kd) * F.log(F.lit(1 - share))
    )

    def add(acc: Column, i: Column) -> Column:
        ratio = (kd - i + 1) / (nd - kd + i) * odds
        term = acc["term"] * ratio
        return F.struct(
            term.alias("term"), (acc["total"] + term).alias("total"), ratio.alias("ratio")
        )

    steps = F.sequence(F.lit(1), F.least(k, F.lit(TERMS)).cast("int"))
    one = F.lit(1.0)
    start = F.struct(one.alias("term"), one.alias("total"), F.lit(0.0).alias("ratio"))
    rest = lambda a: F.when(
        k > TERMS, a["term"] * a["ratio"] / (F.lit(1.0) - a["ratio"])
    ).otherwise(0.0)
    total = F.when(k < 1, one).otherwise(
        F.aggregate(steps, start, add, lambda a: a["total"] + rest(a))
    )
    return F.when(kd >= nd * share, 1.0).otherwise(F.least(F.lit(1.0), F.exp(top) * total))


def choose_cutoffs(
    judged: DataFrame,
    labels: DataFrame,
    allowed: float = ALLOWED,
    chance: float = CHANCE,
) -> DataFrame:
    """stratum, feature, cutoff of the chosen cutoffs; features without one have no row.

    judged: doc_id, stratum and the struct ``q``. All labelled documents that the base rules
    keep take part; a document with several labels is good only if all say so, labels without a
    value or an id are left out. The level of one test is the chance over the number of tests.
    """
    known = (
        labels.where("doc_id is not null and quality is not null")
        .groupBy(F.col("doc_id").cast("long").alias("doc_id"))
        .agg(F.min("quality").alias("good"))
    )
    values = shares(F.col("q"))
    # How many cutoffs of the grid a document is above: one row per document and feature.
    above = F.array(
        *[
            F.struct(
                F.lit(name).alias("feature"),
                sum((values[name] > c).cast("int") for c in grid).alias("above"),
            )
            for name, grid in GRID.items()
        ]
    )
    counts = (
        judged.where(~F.col("q.base_failed"))
        .join(known, "doc_id")
        .select("stratum", "good", F.inline(above))
        .groupBy("stratum", "feature", "above")
        .agg(
            F.sum((F.col("good") == 1).cast("long")).alias("good"),
            F.sum((F.col("good") != 1).cast("long")).alias("bad"),
        )
    )
    # From here on a few rows per stratum.
    number = max(map(len, GRID.values()))
    steps = counts.groupBy("stratum", "feature").agg(
        F.sum("good").alias("n"),
        *[
            # Who is above the i-th cutoff is above all stricter ones, which come after it.
            F.sum(F.when(F.col("above") >= number - i, F.col(side)).otherwise(0)).alias(
                f"{side}{i}"
            )
            for i in range(number)
            for side in ("good", "bad")
        ],
    )
    cutoffs = F.create_map(
        *[
            x
            for name, grid in GRID.items()
            for x in (F.lit(name), F.array(*[F.lit(c) for c in grid]))
        ]
    )
    each = steps.select(
        "stratum",
        "feature",
        "n",
        F.inline(
            F.array(
                *[
                    F.struct(
                        F.lit(i).alias("step"),
                        F.element_at(cutoffs[F.col("feature")], i + 1).alias("cutoff"),
                        F.col(f"good{i}").alias("k"),
                        F.col(f"bad{i}").alias("bad"),
                    )
                    for i in range(number)
                ]
            )
        ),
    )
    tests = sum(map(len, GRID.values()))
    strata = max(1, judged.select("stratum").distinct().count())
    tail = binomial_tail(F.col("k"), F.col("n"), allowed / len(GRID))
    passed = each.where((F.col("bad") > 0) & (tail <= F.lit(chance / (strata * tests))))
    best = F.max(F.struct(F.col("bad"), -F.col("step"), F.col("cutoff"))).alias("best")
    return (
        passed.groupBy("stratum", "feature")
        .agg(best)
        .select("stratum", "feature", F.col("best.cutoff").alias("cutoff"))
    )


def _verdict(judged: DataFrame, chosen: DataFrame) -> DataFrame:
    """judged plus ``kept``: base rules hold and no feature is above its stratum's cutoff."""
    limits = chosen.groupBy(F.col("stratum").alias("of")).agg(
        *[
            F.max(F.when(F.col("feature") == name, F.col("cutoff"))).alias(f"limit_{name}")
            for name in GRID
        ]
    )
    rejected = F.lit(False)
    for name, value in shares(F.col("q")).items():
        rejected = rejected | F.coalesce(value > F.col(f"limit_{name}"), F.lit(False))
    # One row per stratum that has a cutoff, so its size is that of the strata: rows, with their
    # texts, are not dealt by a stratum that may hold a third of them.
    return (
        judged.join(F.broadcast(limits), judged["stratum"] == limits["of"], "left")
        .withColumn("kept", ~F.col("q.base_failed") & ~rejected)
        .drop("of", *[f"limit_{n}" for n in GRID])
    )


def _stratum(docs: DataFrame) -> Column:
    return F.coalesce(F.col("lang"), F.lit("")) if "lang" in docs.columns else F.lit("")


def quality_rules(
    docs: DataFrame, labels: DataFrame, allowed: float = ALLOWED, chance: float = CHANCE
) -> DataFrame:
    """One row per document: counts, base_failed and kept.

    Missing and empty texts have no words and fail the base rules. Documents without a language
    form a stratum of their own. With no labels, or too few for a bound, the base rules alone
    decide. Repeated rows are judged alike; further columns are left out.
    """
    judged = base_features(
        docs.select(
            F.col("doc_id").cast("long").alias("doc_id"), "text", _stratum(docs).alias("stratum")
        )
    ).drop("text")
    judged = stored(judged)
    verdict = _verdict(judged, choose_cutoffs(judged, labels, allowed, chance))
    return verdict.select(
        "doc_id",
        *[
            F.col(f"q.{c}").alias(c)
            for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
        ],
        F.col("q.base_failed").alias("base_failed"),
        "kept",
    )


def keep_good(
    docs: DataFrame, labels: DataFrame, allowed: float = ALLOWED, chance: float = CHANCE
) -> DataFrame:
    """The rows that the quality rules keep, with all their columns.

    Rows with the same doc_id, text and stratum are judged alike. So counts are stored without the
    texts, and rows are found again by their id, text hash and stratum.
    """
    key, mark, group = (unused(docs, name) for name in ("_key", "_hash", "_stratum"))
    low = F.lit(-(1 << 63))
    keyed = docs.withColumns(
        {
            key: F.coalesce(F.col("doc_id").cast("long"), low),
            mark: F.xxhash64(F.coalesce(F.col("text"), F.lit(""))),
            group: _stratum(docs),
        }
    )
    rows = keyed.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.col(mark).alias("mark"),
        "text",
        F.col(group).alias("stratum"),
    )
    judged = stored(base_features(rows).drop("text"))
    verdict = _verdict(judged, choose_cutoffs(judged, labels, allowed, chance))
    kept = verdict.where("kept").select(
        F.coalesce("doc_id", low).alias(key), F.col("mark").alias(mark), F.col("stratum").alias(group)
    )
    return keyed.join(kept.distinct(), [key, mark, group], "left_semi").drop(key, mark, group)
