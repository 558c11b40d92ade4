"""Token ids against the library where a text holds added tokens."""

from __future__ import annotations

import random

import public_tokenizers

from trustgate.llm import token_files


def test_added_tokens_are_found_inside_texts():
    from tokenizers import Tokenizer

    path = public_tokenizers.path("byte_bpe_50k.json")
    library = Tokenizer.from_file(path)
    assert token_files.encode_text("ab <|endoftext|> cd", path).tolist() == [397, 220, 50256, 22927]
    rng = random.Random(4)
    signs = ["<|endoftext|>", "<|endoftext", "|>", " ", "  ", "\n", "ab", " cd", "'s", "é", "7", "\0"]
    for _ in range(3000):
        text = "".join(rng.choices(signs, k=rng.randint(0, 12)))
        want = library.encode(text, add_special_tokens=False).ids
        assert token_files.encode_text(text, path).tolist() == want
