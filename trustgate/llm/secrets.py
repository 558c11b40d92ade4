"""Secret scan with linking of the parts of a credential.

Strong parts are secrets on their own: assignments, access keys, long hexadecimal strings. Weak
parts are harmless alone: a user name, a mixed character string, an address. Parts of a text
lie in scopes (stretches without an empty line); an interval join inside a scope puts each part
together with the parts whose interval, widened by ``reach`` code points, overlaps it. A weak
part is reported only if a complementary part is joined to it: an identifier or an endpoint
needs a secret, a weak secret needs an identifier other than the one whose value it is. Links are
all joined pairs of identifier and secret, with each endpoint that is joined to the secret. Parts
of one kind hardly overlap, so ``reach`` bounds a part's partners and links grow with the text.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_left, bisect_right
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame

from trustgate.llm.common import id_and_text, map_texts, texts_of

#: Order of kinds within one start; the first three are the strong ones.
KINDS = ("assign", "access", "hex", "ident", "blob", "endpoint")
ORDER = {kind: i for i, kind in enumerate(KINDS)}

ASSIGN = re.compile(
    r"""(?ai)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
#: A run below 16 characters can't hold a match, so this equals taking runs and dropping short ones.
HEX = re.compile(r"[0-9a-f]{16,}")
IDENT = re.compile(
    r"""(?ai)\b(?:user(?:name)?|login|account|client_?id|key_?id)["']?\x20*[:=]\x20*["']?"""
    r"""([A-Za-z0-9@._+-]{3,})"""
)
BLOB = re.compile(r"[A-Za-z0-9+/_-]{20,}={0,2}")
ENDPOINT = re.compile(r"""(?a)\b[a-z][a-z0-9+.-]{1,15}://[^\s"'<>]{3,}""")
SCOPE_END = re.compile(r"\n[ \t\r]*\n")

REACH = 300


class Part(NamedTuple):
    start: int
    end: int
    kind: str


class Finding(NamedTuple):
    spans: list[Part]
    links: list[tuple[Part, Part, Part | None]]


def strong_parts(text: str) -> list[Part]:
    """The base matches, by kind; a cheap test for a needed character comes first."""
    parts = []
    if ":" in text or "=" in text:
        parts += [Part(*m.span(), "assign") for m in ASSIGN.finditer(text) if len(m[2]) >= 12]
    if "AKIA" in text:
        parts += [
            Part(*m.span(), "access") for m in ACCESS.finditer(text) if m.end() - m.start() >= 18
        ]
    parts += [Part(*m.span(), "hex") for m in HEX.finditer(text)]
    return parts


def _mixed(value: str) -> bool:
    return (
        any(c.isdigit() for c in value)
        and any(c.islower() for c in value)
        and any(c.isupper() for c in value)
    )


def weak_parts(text: str, strong: list[Part]) -> list[Part]:
    """Candidates that count only next to others; those inside a strong part are that part."""
    found = []
    if ":" in text or "=" in text:
        found += [Part(*m.span(), "ident") for m in IDENT.finditer(text)]
    # Without an identifier no weak secret can be linked, without a secret nothing else can.
    if found or any(p.kind == "access" for p in strong):
        found += [Part(*m.span(), "blob") for m in BLOB.finditer(text) if _mixed(m[0])]
    if "://" in text and (strong or found):
        found += [Part(*m.span(), "endpoint") for m in ENDPOINT.finditer(text)]
    taken = Intervals(strong)
    return [p for p in found if taken.nearest(p, 0) is None]


class Intervals:
    """Parts ordered by start, with the running maximum of their ends for overlap search."""

    def __init__(self, parts: list[Part]):
        self.parts = sorted(parts)
        self.starts = [p.start for p in self.parts]
        self.ends: list[int] = []
        for p in self.parts:
            self.ends.append(max(p.end, self.ends[-1]) if self.ends else p.end)

    def nearest(self, part: Part, reach: int) -> Part | None:
        """The closest part whose interval, widened by reach, overlaps; the earlier one on ties."""
        last = bisect_left(self.starts, part.end + reach)
        after = bisect_left(self.starts, part.start)
        best, gap = None, reach + 1
        if after < last:
            best, gap = self.parts[after], max(0, self.starts[after] - part.end)
        # Going left, ends only shrink in their running maximum: stop where none can be closer.
        i = after - 1
        while i >= 0 and part.start - self.ends[i] <= min(gap, reach):
            away = max(0, part.start - self.parts[i].end)
            if away <= min(gap, reach) and self.parts[i].end + reach > part.start:
                best, gap = self.parts[i], away
                if away == 0:
                    break
            i -= 1
        return best


    def near(self, part: Part, reach: int) -> list[Part]:
        """All parts whose interval, widened by reach, overlaps, by start."""
        found = []
        i = bisect_left(self.starts, part.end + reach) - 1
        while i >= 0 and self.ends[i] + reach > part.start:
            if self.parts[i].end + reach > part.start:
                found.append(self.parts[i])
            i -= 1
        return found[::-1]


def _complements(secret: Part, idents: Intervals, reach: int) -> list[Part]:
    """Identifiers joined to a secret; a weak secret is no complement of one that it overlaps."""
    found = idents.near(secret, reach)
    if secret.kind != "blob":
        return found
    return [p for p in found if p.end <= secret.start or secret.end <= p.start]


def link(text: str, reach: int = REACH) -> Finding:
    """All reported spans of a text and the links between them."""
    strong = strong_parts(text)
    weak = weak_parts(text, strong)
    if not weak and not any(p.kind == "access" for p in strong):
        return Finding(sorted(strong, key=_place), [])
    cuts = [m.start() for m in SCOPE_END.finditer(text)]
    scopes: dict[int, list[Part]] = {}
    for p in strong + weak:
        scopes.setdefault(bisect_right(cuts, p.start), []).append(p)
    spans, links = list(strong), []
    for parts in scopes.values():
        idents = Intervals([p for p in parts if p.kind in ("access", "ident")])
        ends = Intervals([p for p in parts if p.kind == "endpoint"])
        pairs = {
            p: _complements(p, idents, reach) for p in parts if p.kind in ("assign", "hex", "blob")
        }
        blobs = [p for p, joined in pairs.items() if p.kind == "blob" and joined]
        secrets = Intervals([p for p in parts if p.kind in ("assign", "hex")] + blobs)
        linked = {ident for joined in pairs.values() for ident in joined}
        spans += blobs
        spans += [p for p in parts if p.kind == "ident" and p in linked]
        spans += [p for p in parts if p.kind == "endpoint" and secrets.near(p, reach)]
        for secret in secrets.parts:
            if pairs[secret]:
                near = ends.near(secret, reach) or [None]
                links += [(ident, secret, end) for ident in pairs[secret] for end in near]
    return Finding(sorted(spans, key=_place), links)


def _place(part: Part) -> tuple[int, int, int]:
    return part.start, ORDER[part.kind], part.end


def _joined(parts: list[Part]) -> str:
    return ",".join(f"{p.kind}:{p.start}:{p.end}" for p in parts)


SCHEMA = (
    "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string,"
    " n_weak long, links string"
)


def scan_secrets(docs: DataFrame, reach: int = REACH) -> DataFrame:
    """One row per document: counts of strong kinds, all spans, and the links between parts.

    Spans are ``kind:start:end`` in code points, end exclusive, by start and then kind; links
    are ``identifier>secret`` or ``identifier>secret>endpoint``. A missing or empty text has no
    span. Repeated rows, also with the same id, each get their own row; a missing id stays
    missing; further columns of the input are left out.
    """

    def make():
        def work(batch: pa.RecordBatch) -> pa.RecordBatch:
            rows = []
            for doc_id, text in zip(
                batch.column("doc_id").to_pylist(), texts_of(batch), strict=True
            ):
                found = link(text, reach)
                base = [p for p in found.spans if ORDER[p.kind] < 3]
                kinds = [p.kind for p in base]
                rows.append(
                    (
                        doc_id,
                        kinds.count("assign"),
                        kinds.count("access"),
                        kinds.count("hex"),
                        hashlib.sha256(_joined(base).encode()).hexdigest(),
                        _joined(found.spans),
                        len(found.spans) - len(base),
                        ",".join(">".join(_joined([p]) for p in x if p) for x in found.links),
                    )
                )
            columns = [list(c) for c in zip(*rows, strict=True)]
            kinds = [pa.int64()] * 4 + [pa.string()] * 2 + [pa.int64(), pa.string()]
            return pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, kinds, strict=True)],
                names=[f.split()[0] for f in SCHEMA.split(", ")],
            )

        return work

    return map_texts(id_and_text(docs), make, SCHEMA)


MARK = "[SECRET]"


def redact(text: str, reach: int = REACH) -> str:
    """The text with every reported secret replaced by a mark; overlapping spans become one."""
    spans = [p for p in link(text, reach).spans if p.kind != "endpoint"]
    if not spans:
        return text
    out, at = [], 0
    end = -1
    for p in spans:
        if p.start >= end:
            if end >= 0:
                at = end
            out += [text[at : p.start], MARK]
        end = max(end, p.end)
    out.append(text[end:])
    return "".join(out)


def redact_documents(docs: DataFrame, reach: int = REACH) -> DataFrame:
    """The same rows and columns, secrets in ``text`` replaced, ``n_chars`` counted again.

    Rows without a secret come out unchanged, a missing text stays missing.
    """

    def make():
        def work(batch: pa.RecordBatch) -> pa.RecordBatch:
            texts = texts_of(batch)
            clean = [t if t is None else redact(t, reach) for t in texts]
            columns = dict(zip(batch.schema.names, batch.columns, strict=True))
            columns["text"] = pa.array(clean, batch.schema.field("text").type)
            if "n_chars" in columns:
                old = columns["n_chars"].to_pylist()
                columns["n_chars"] = pa.array(
                    [
                        n if a is b or a == b else len(b)
                        for n, a, b in zip(old, texts, clean, strict=True)
                    ],
                    batch.schema.field("n_chars").type,
                )
            return pa.RecordBatch.from_arrays(list(columns.values()), names=list(columns))

        return work

    return map_texts(docs, make, docs.schema)
