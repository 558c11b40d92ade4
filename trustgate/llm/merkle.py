"""A Merkle manifest of a dataset, built and read by time-forward processing.

Every row is a leaf. Per group, leaves stand in order and every ``ARITY`` consecutive nodes become
their parent's digest until one is left, the subroot; subroots in group order become the root in
the same way. A proof holds, from leaf to root, what stands beside a node in its run.

Time-forward processing: a node is labelled by level, group and place, and a digest is a message
to the label of the parent. The queue of messages is a stored table; its least labels are those of
one level, and the shuffle, which sorts on disk, delivers them ordered by label to their parents,
eight at most to each. Upward, messages are digests of children. Then the labels are swept in
reverse: a parent sends each child the proof from its own place on, and the child puts what stands
beside itself in front. Texts are read once; no message holds more than the way to the root.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from trustgate.llm.common import stored

ARITY = 8
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Rows of one partition that ``monotonically_increasing_id`` tells apart.
_ROW_BITS = 33


def _digest(value: Column) -> Column:
    return F.sha2(value.cast("binary"), 256)


def _field(value: Column) -> Column:
    """``-``, or the UTF-8 byte count, ``:`` and the value; integers in decimal."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_digest(columns: dict[str, Column]) -> Column:
    return _digest(F.concat(*[_field(c) for c in columns.values()]))


def _levels(most: int) -> int:
    """Levels above the leaves of a group with so many."""
    levels = 0
    while most > 1:
        most, levels = -(-most // ARITY), levels + 1
    return levels


def _numbered(nodes: DataFrame, order: list[Column]) -> DataFrame:
    """The nodes with ``place`` in their group, from 0, and ``n``, the group's size.

    Nodes are sorted by group and order over ranges, so a group that holds a third of them has
    many tasks; a range then starts where the group's rows in the ranges before it end.
    """
    spark = nodes.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    keys = [F.col("grp").asc_nulls_first(), *order]
    at = F.monotonically_increasing_id()
    placed = stored(
        nodes.repartitionByRange(parts, *keys)
        .sortWithinPartitions(*keys)
        .withColumns(
            {
                "_range": F.shiftright(at, _ROW_BITS),
                "_at": at.bitwiseAND(F.lit((1 << _ROW_BITS) - 1)),
            }
        )
    )
    # A row per range and group in it: no more than ranges and groups together.
    pieces = placed.groupBy("_range", "grp").agg(F.count("*").alias("rows"), F.min("_at").alias("low"))
    group = Window.partitionBy("grp")
    before = group.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    starts = pieces.select(
        F.col("_range").alias("r"),
        F.col("grp").alias("g"),
        (F.coalesce(F.sum("rows").over(before), F.lit(0)) - F.col("low")).alias("shift"),
        F.sum("rows").over(group).alias("n"),
    )
    same = (F.col("_range") == F.col("r")) & F.col("grp").eqNullSafe(F.col("g"))
    return placed.join(starts, same).select(
        *nodes.columns, (F.col("_at") + F.col("shift")).alias("place"), "n"
    )


def _runs(nodes: DataFrame, own: list[str]) -> DataFrame:
    """Parents of nodes in groups of several: ``grp``, ``place``, ``n``, digest and children.

    A child is its digest and the columns ``own``, in order of place.
    """
    parent = F.floor(F.col("place") / ARITY).cast("long")
    child = F.struct("place", "digest", *own)
    return (
        nodes.where("n > 1")
        .groupBy("grp", parent.alias("up"), F.ceil(F.col("n") / ARITY).cast("long").alias("n"))
        .agg(F.sort_array(F.collect_list(child)).alias("children"))
        .select(
            "grp",
            F.col("up").alias("place"),
            "n",
            _digest(F.array_join(F.col("children.digest"), "")).alias("digest"),
            "children",
        )
    )


def _beside(children: Column, i: Column) -> Column:
    """What stands left and right of the i-th child (from 0) in its run, each as one string."""
    digests = children["digest"]
    return F.struct(
        F.array_join(F.slice(digests, F.lit(1), i), "").alias("left"),
        F.array_join(F.slice(digests, i + 2, F.size(digests)), "").alias("right"),
    )


_PROOF = "array<struct<left:string,right:string>>"


def _tree(nodes: DataFrame, own: list[str]) -> tuple[DataFrame, DataFrame]:
    """Roots (``grp``, ``digest``) of the groups, and every node's columns ``own`` with ``proof``.

    nodes: ``grp``, ``digest``, ``place``, ``n`` and the columns ``own``.
    """
    most = nodes.agg(F.max("n")).first()[0] or 0
    levels = [nodes]
    for k in range(_levels(most)):
        levels.append(stored(_runs(levels[-1], [] if k else own)))
    roots = [level.where("n = 1").select("grp", "digest") for level in levels]

    def ended(k: int) -> DataFrame:
        """Nodes of a level that are their group's root."""
        nothing = F.array().cast(_PROOF).alias("proof")
        return levels[k].where("n = 1").select("grp", "place", *([] if k else own), nothing)

    # The reverse sweep: a node's proof is what stands beside it, then its parent's proof.
    proofs = ended(len(levels) - 1)
    for k in range(len(levels) - 1, 0, -1):
        parents, ways = levels[k], proofs.select(
            F.col("grp").alias("_grp"), F.col("place").alias("_place"), F.col("proof").alias("_proof")
        )
        same = parents["grp"].eqNullSafe(ways["_grp"]) & (parents["place"] == ways["_place"])
        sent = parents.join(ways, same).select(
            "grp", "children", "_proof", F.posexplode("children").alias("i", "child")
        )
        below = sent.select(
            "grp",
            F.col("child.place").alias("place"),
            *[F.col(f"child.{c}").alias(c) for c in ([] if k > 1 else own)],
            F.concat(F.array(_beside(F.col("children"), F.col("i"))), "_proof").alias("proof"),
        )
        proofs = below.unionByName(ended(k - 1))
        proofs = stored(proofs) if k > 1 else proofs
    return stored(reduce(DataFrame.unionByName, roots)), proofs


def manifest(docs: DataFrame, tampered: Column | None = None) -> DataFrame:
    """Per row: doc_id, leaf, other (the leaf of the row as it may have been tampered with),
    subroot, root and ``proof``, the pairs of strings left and right of the way to the root.

    ``tampered``: the text to verify instead, the row's own where NULL; by default none differs.
    Missing values are ``-`` in a leaf. Rows stand by language (bytewise, missing first), then
    doc_id (missing first); rows of one id by their leaves, so wholly equal rows are neighbours
    with equal digests. An empty table has no rows; a single row is subroot and root at once.
    Further columns are not part of the leaf.
    """
    columns = {name: F.col(name) for name in FIELDS}
    tampered = F.lit(None).cast("string") if tampered is None else tampered
    other = leaf_digest({**columns, "text": tampered})
    leaves = stored(
        docs.select(
            F.col("lang").cast("string").alias("grp"),
            F.col("doc_id").cast("long").alias("doc_id"),
            leaf_digest(columns).alias("digest"),
            F.when(tampered.isNotNull(), other).alias("other"),
            F.monotonically_increasing_id().alias("no"),
        )
    )
    order = [F.col("doc_id").asc_nulls_first(), F.col("digest"), F.col("no")]
    own = ["doc_id", "other"]
    placed = _numbered(leaves, order).select("grp", "digest", "place", "n", *own)
    # A row's own digest goes along to the end.
    own = [*own, "leaf"]
    subroots, ways = _tree(stored(placed.withColumn("leaf", F.col("digest"))), own)

    groups = _numbered(
        subroots.select(F.lit(0).alias("grp"), F.col("grp").alias("lang"), F.col("digest")),
        [F.col("lang").asc_nulls_first()],
    )
    groups = stored(groups.withColumn("subroot", F.col("digest")))
    root, upper = _tree(groups, ["lang", "subroot"])
    # One row per language: stored, so that Spark sees its size when it joins it to the leaves.
    upper = stored(
        upper.join(root.select("grp", F.col("digest").alias("root")), "grp").select(
            "lang", "subroot", "root", F.col("proof").alias("upper")
        )
    )
    return ways.join(upper, ways["grp"].eqNullSafe(upper["lang"])).select(
        "doc_id",
        "leaf",
        F.coalesce("other", "leaf").alias("other"),
        "subroot",
        "root",
        F.concat("proof", "upper").alias("proof"),
    )


def folded(leaf: Column, proof: Column) -> Column:
    """The root that a leaf and a proof lead to."""
    return F.aggregate(
        proof, leaf, lambda acc, step: _digest(F.concat(step["left"], acc, step["right"]))
    )


def proof_digest(proof: Column) -> Column:
    """Of all siblings on the way, from the leaf up, left to right."""
    return _digest(
        F.array_join(F.transform(proof, lambda s: F.concat(s["left"], s["right"])), "")
    )


def lower_case(text: Column) -> Column:
    """A-Z alone in lower case."""
    return F.translate(text, _UPPER, _LOWER)


def verify_manifest(docs: DataFrame) -> DataFrame:
    """Every row's way to the root, and whether its text, tampered with for a third, verifies.

    Where 3 divides the checksum of the decimal doc_id (of the empty string for a missing one),
    the text's A-Z become lower case before verification.
    """
    number = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary"))
    tampered = F.when(number % 3 == 0, lower_case(F.col("text")))
    rows = manifest(docs, tampered)
    checked = rows.withColumn("folded_root", folded(F.col("other"), F.col("proof")))
    return checked.select(
        "doc_id",
        "leaf",
        "subroot",
        "root",
        proof_digest(F.col("proof")).alias("proof_sha256"),
        "folded_root",
        (F.col("folded_root") == F.col("root")).alias("verified"),
    )
