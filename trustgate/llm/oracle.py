"""SQL counterparts of queries, for an independent engine over the same tables."""

from __future__ import annotations

from trustgate.llm import merkle

#: Levels of a tree that the text spells out: 8 ** 7 leaves of a language, 8 ** 2 languages.
LEAF_LEVELS, GROUP_LEVELS = 7, 2


def _field(value: str) -> str:
    text = f"CAST({value} AS VARCHAR)"
    return f"coalesce(CAST(octet_length(encode({text})) AS VARCHAR) || ':' || {text}, '-')"


def _leaf(text: str) -> str:
    return f"sha256({' || '.join([*[_field(f) for f in merkle.FIELDS[:-1]], _field(text)])})"


def _crc32(text: str) -> str:
    """The checksum of an ASCII text, byte by byte through the list ``t`` of the table ``crc``."""
    codes = f"list_transform(string_split({text}, ''), lambda x: CAST(ascii(x) AS BIGINT))"
    step = "lambda a, x: xor(a >> 8, t[(xor(a, x) & 255) + 1])"
    given = f"CASE WHEN {text} = '' THEN [] ELSE {codes} END"
    return f"xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), {given}), {step}), 4294967295)"


def _crc_table() -> str:
    """One row with the 256 values of the checksum's polynomial."""
    value = "CAST(i AS BIGINT)"
    rounds = "SELECT i, " + value + " AS v FROM range(256) r(i)"
    for _ in range(8):
        rounds = (
            "SELECT i, CASE WHEN v & 1 = 1 THEN xor(v >> 1, 3988292384) ELSE v >> 1 END AS v"
            f" FROM ({rounds})"
        )
    return f"crc AS MATERIALIZED (SELECT list(v ORDER BY i) AS t FROM ({rounds}))"


def _runs(name: str, nodes: str, levels: int) -> list[str]:
    """Per level, the runs of nodes and their digests: tables ``<name>_run<k>``, ``<name>_node<k>``.

    nodes: g, i, d (digest) and n, the nodes of the group on that level.
    """
    out = [f"{name}_node0 AS MATERIALIZED ({nodes})"]
    for k in range(levels):
        out.append(
            f"{name}_run{k} AS MATERIALIZED (SELECT g, i // 8 AS p, list(d ORDER BY i) AS l,"
            f" any_value(n) AS n FROM {name}_node{k} WHERE n > 1 GROUP BY g, i // 8)"
        )
        out.append(
            f"{name}_node{k + 1} AS MATERIALIZED (SELECT g, p AS i,"
            f" sha256(array_to_string(l, '')) AS d, (n + 7) // 8 AS n FROM {name}_run{k})"
        )
    roots = " UNION ALL ".join(f"SELECT g, d FROM {name}_node{k} WHERE n = 1" for k in range(levels + 1))
    out.append(f"{name}_root AS MATERIALIZED ({roots})")
    return out


def _way(name: str, levels: int, place: str, group: str) -> tuple[str, list[str], list[str]]:
    """Joins from a node to the runs on its way, and what stands left and right on each."""
    joins, left, right = "", [], []
    for k in range(levels):
        run, size = f"{name}{k}", 8**k
        at = f"({place} // {size}) % 8"
        joins += (
            f" LEFT JOIN {name}_run{k} {run} ON {run}.g IS NOT DISTINCT FROM {group}"
            f" AND {run}.p = {place} // {8 * size}"
        )
        left.append(f"coalesce(array_to_string({run}.l[1:{at}], ''), '')")
        right.append(f"coalesce(array_to_string({run}.l[{at} + 2:], ''), '')")
    return joins, left, right


def merkle_manifest() -> str:
    upper, lower = merkle._UPPER, merkle._LOWER
    number = _crc32("coalesce(CAST(doc_id AS VARCHAR), '')")
    leaves = (
        "SELECT doc_id, lang AS g, "
        f"{_leaf('text')} AS d, CASE WHEN {number} % 3 = 0 THEN {_leaf('low')} END AS other"
        f" FROM (SELECT *, translate(text, '{upper}', '{lower}') AS low FROM documents, crc)"
    )
    placed = (
        "SELECT *, row_number() OVER (PARTITION BY g ORDER BY doc_id NULLS FIRST, d) - 1 AS i,"
        " count(*) OVER (PARTITION BY g) AS n FROM leaves"
    )
    groups = (
        "SELECT 0 AS g, row_number() OVER (ORDER BY encode(g) NULLS FIRST) - 1 AS i, d,"
        " count(*) OVER () AS n, g AS lang FROM leaf_root"
    )
    joins, left, right = _way("leaf", LEAF_LEVELS, "p.i", "p.g")
    top_joins, top_left, top_right = _way("lang", GROUP_LEVELS, "t.i", "t.g")
    # The fold is built step by step, so that no step's text holds the ones before twice.
    steps = []
    lefts, rights = left + top_left, right + top_right
    for k in range(len(lefts)):
        steps.append(
            f"SELECT *, CASE WHEN s{k} THEN sha256(l{k} || f{k} || r{k}) ELSE f{k} END AS f{k + 1}"
        )
    runs = [f"leaf{k}" for k in range(LEAF_LEVELS)] + [f"lang{k}" for k in range(GROUP_LEVELS)]
    columns = ", ".join(
        f"{run}.l IS NOT NULL AS s{k}, {a} AS l{k}, {b} AS r{k}"
        for k, (run, a, b) in enumerate(zip(runs, lefts, rights, strict=True))
    )
    inner = (
        f"SELECT p.doc_id, p.d AS leaf, coalesce(p.other, p.d) AS f0, t.d AS subroot,"
        f" (SELECT d FROM lang_root) AS root, {columns}"
        f" FROM placed p JOIN lang_node0 t ON t.lang IS NOT DISTINCT FROM p.g{joins}{top_joins}"
    )
    for step in steps:
        inner = f"{step} FROM ({inner})"
    value = f"f{len(lefts)}"
    proof = " || ".join(f"l{k} || r{k}" for k in range(len(lefts)))
    tables = [
        _crc_table(),
        f"leaves AS MATERIALIZED ({leaves})",
        f"placed AS MATERIALIZED ({placed})",
        *_runs("leaf", "SELECT g, i, d, n FROM placed", LEAF_LEVELS),
        *_runs("lang", groups, GROUP_LEVELS),
    ]
    return (
        f"WITH {', '.join(tables)} SELECT doc_id, leaf, subroot, root,"
        f" sha256({proof}) AS proof_sha256, {value} AS folded_root, {value} = root AS verified"
        f" FROM ({inner})"
    )


ORACLE_SQL: dict[str, str] = {"op13_merkle_manifest": merkle_manifest()}
