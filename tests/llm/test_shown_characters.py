"""How a tokenizer file shows the bytes of characters beyond ASCII."""

import numpy as np
import public_tokenizers

from trustgate.llm import token_files


def test_words_are_shown_character_by_character_as_the_library_shows_them():
    path = public_tokenizers.path("byte_bpe_50k.json")
    _, encode, tokenizer = token_files._library(path)
    letters = [c for c in map(chr, range(0x80, ord(token_files.LIMIT))) if c.isalpha()]
    words = [f" {c}ab{c}" for c in letters] + [" Жук", "日本", " \U0001d400"]
    for word in words:
        got = np.frombuffer(encode(word), "<u4").tolist()
        assert got == tokenizer.encode(word, add_special_tokens=False).ids
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    others = [b for b in range(256) if b not in plain]
    shown = token_files.ShownCharacters({b: 256 + i for i, b in enumerate(others)})
    held = len(shown)
    assert " éЖ".translate(shown) == "ĠÃ©Ðĸ"
    assert len(shown) == held
