"""Links between the parts of a credential against brute force."""

from __future__ import annotations

import random

from trustgate.llm import secrets


def test_every_joined_pair_is_a_link():
    hexa = "0123456789abcdef" * 2
    text = f"user=bob9 login=amy7 {hexa} https://a.example.com/x https://b.example.com/y"
    found = secrets.link(text)
    shown = {tuple(p and text[p.start : p.end] for p in x) for x in found.links}
    want = {
        (ident, hexa, f"https://{end}")
        for ident in ("user=bob9", "login=amy7")
        for end in ("a.example.com/x", "b.example.com/y")
    }
    assert shown == want and len(found.links) == len(want)
    rng = random.Random(2)
    pieces = ["user=bob9", hexa, "AKIA" + "Q" * 16, "Aa1" + "zY" * 12, "ftp://h.ex/y", "\n\n"]
    for _ in range(200):
        text = " ".join(rng.choice(pieces) + " x" * rng.randint(0, 20) for _ in range(12))
        found = secrets.link(text, 30)
        linked = {p for x in found.links for p in x[:2]}
        assert {p for p in found.spans if p.kind in ("ident", "blob")} <= linked
        cuts = [m.start() for m in secrets.SCOPE_END.finditer(text)]
        pairs = {
            (a, b)
            for a in found.spans
            for b in found.spans
            if a.kind in ("ident", "access")
            and b.kind in ("assign", "hex", "blob")
            and a.start < b.end + 30
            and b.start < a.end + 30
            and sum(c <= a.start for c in cuts) == sum(c <= b.start for c in cuts)
        }
        assert {x[:2] for x in found.links} == pairs


def test_an_identifier_is_no_complement_of_itself():
    for lone in ("client_id=Ab3dEf6hIj9kLm2nOp5q", "client_id=Ab3dEf6hIj9kLm2nOp5q=="):
        assert not secrets.link(lone).spans
        assert secrets.redact(f"see {lone} there") == f"see {lone} there"
        assert secrets.link(f"user=bob9 {lone}").links
