"""Cut texts where no pre-token of the byte-level pattern can cross.

The pattern's matches hold white space only at their start: an optional space before letters,
digits or signs, or a run of white space alone. So a place between a character that is not white
space and a space always ends one match and begins the next, whatever follows. Encoding the
pieces between such places one by one gives the ids of the whole text. Pieces repeat, so a worker
remembers them. A plain pre-token taken alone is one pre-token again, so both share one memory.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

#: White space before a space: there a text isn't cut.
BLANK = re.compile(r"\s ")
#: A place where a text may be cut lies after the first character of a match.
PLACE = re.compile(r"\S ")
#: Characters of a text that are cut into pieces at once; a longer text is taken part by part.
PART = 1 << 20
#: Pieces and pre-tokens of one generation of a worker's memory.
ENTRIES = 800_000
#: Letters on which all character tables agree, and signs that end a plain piece; a run of signs
#: is one match.
LIMIT = "\u0250"
LETTERS = "".join(filter(str.isalpha, map(chr, range(ord(LIMIT)))))
SIGNS = ".,;:!?#*$%&|<>"
#: Plain: letters, maybe after a space and before signs; more of them after single line ends.
PLAIN = re.compile(f" ?[{LETTERS}]+[{SIGNS}]*(?:\n[{LETTERS}]+[{SIGNS}]*)*")
PLAIN_TOKEN = re.compile(f" ?[{LETTERS}]+|[{SIGNS}]+|\n")
#: A comma or stop behind anything but these letters and digits may belong to a longer match, and a
#: line end before white space too; texts that have such are cut at spaces alone.
RUN_ON = [re.compile(p) for p in (rf",(?<=[^{LETTERS}0-9],)", rf"\.(?<=[^{LETTERS}0-9]\.)", r"\n\s")]
#: Longer ones are encoded without being remembered.
LONGEST = 64
#: Marks of keys met before, one byte each; two keys may share one.
MARKS = 1 << 22


def cut(text: str) -> list[str]:
    """Pieces whose concatenation is the text."""
    if text[:1] != " " and not BLANK.search(text) and "\0" not in text:
        return text.replace(" ", "\0 ").split("\0") if text else []
    parts = text.split(" ")
    out = [parts[0]]
    for p in parts[1:]:
        last = out[-1]
        if last and not last[-1].isspace():
            out.append(f" {p}")
        else:
            out[-1] = f"{last} {p}"
    return out if out != [""] else []


def cut_signs(text: str) -> list[str]:
    """Pieces as of ``cut``, with commas, stops and line ends that end a word as pieces of their own.

    So a word is looked up and remembered alike whatever follows it. A piece may be empty.
    """
    if text[:1] == " " or BLANK.search(text) or "\0" in text or any(p.search(text) for p in RUN_ON):
        return cut(text)
    marked = text.replace(" ", "\0 ").replace(",\0", "\0,\0").replace(".\0", "\0.\0")
    return marked.replace(".\n", "\0.\0\n\0").split("\0") if text else []


def parts(text: str, size: int) -> Iterator[str]:
    """Parts of about ``size`` characters, cut between pieces."""
    start = 0
    while len(text) - start > size and (found := PLACE.search(text, start + size)):
        yield text[start : found.start() + 1]
        start = found.start() + 1
    yield text[start:] if start else text


class Memory(dict):
    """Key -> packed ids, filled on demand by ``encode``.

    Two generations bound its size: when the young one is full it becomes the old one, whose
    entries move back on use. Frequent keys stay, and results never depend on what is held.
    With ``recurring`` a key is kept from its second use on, so rare keys take no room.
    """

    def __init__(self, encode, limit: int, recurring: bool = False):
        super().__init__()
        self.encode, self.limit = encode, limit
        self.old: dict[str, bytes] = {}
        self.met = bytearray(MARKS) if recurring else None

    def __missing__(self, key: str) -> bytes:
        found = self.old.get(key)
        if found is None:
            found = self.encode(key)
            if len(key) > LONGEST:
                return found
            if self.met is not None:
                mark = hash(key) % MARKS
                if not self.met[mark]:
                    self.met[mark] = 1
                    return found
        if len(self) >= self.limit:
            self.old = dict(self)
            self.clear()
            if self.met is not None:
                self.met = bytearray(MARKS)
        self[key] = found
        return found


def _is_word(piece: str) -> bool:
    """Letters of the tables' common part alone, maybe after a space."""
    letters = piece[1:] if piece[:1] == " " else piece
    return letters.isalpha() and (letters.isascii() or max(letters) < LIMIT)


class TextMemory:
    """Ids of texts from the ids of their pieces and pre-tokens, which are remembered."""

    def __init__(self, split, encode, entries: int = ENTRIES, recurring: bool = False):
        """split: a piece's pre-tokens; encode: packed ids of a pre-token."""
        self.split, self.encode = split, encode
        self.known = Memory(self._piece, entries, recurring)

    def _piece(self, piece: str) -> bytes:
        if _is_word(piece):
            return self.encode(piece)
        word = piece.rstrip(SIGNS)
        if _is_word(word):
            return self.known[word] + self.known[piece[len(word) :]]
        if not PLAIN.fullmatch(piece):
            return b"".join(map(self.encode, self.split(piece)))
        tokens = PLAIN_TOKEN.findall(piece)
        if len(tokens) == 1:
            return self.encode(piece)
        return b"".join([self.known[t] for t in tokens])

    def ids(self, text: str) -> bytes:
        """Packed ids of a text."""
        some = (text,) if len(text) <= PART else parts(text, PART)
        return b"".join([b"".join(map(self.known.__getitem__, cut_signs(part))) for part in some])
