"""Commas, stops and line ends as pieces of their own: the library's ids, and fewer pieces."""

from __future__ import annotations

import random

import pytest

import public_tokenizers
from trustgate.llm import pieces, token_files

PATH = public_tokenizers.path("byte_bpe_50k.json")


def test_a_word_is_one_piece_whatever_follows_it():
    got = pieces.cut_signs("one two, two. two.\nTwo, 3, end.")
    assert [p for p in got if p] == [
        "one", " two", ",", " two", ".", " two", ".", "\n", "Two", ",", " 3", ",", " end.",
    ]


@pytest.mark.parametrize(
    "text",
    ["a ,, b", "a , b", "x), y", "... z", ",a", ". b", "a.\n b", "a.\n\nb", "a.\r\nb", "é, ü. ß.\nÄ",
     "字, 字. b", "é, x", "a, ", "a. ", "a.\n", "\n.\nb", "a_, b", "'s, 't. x", "²,  ½. y",
     "ʕ, x", "a. b, c", "a, b. c.\n\td", "a\0, b. c", " a, b", "", ",", "ŉ, ʼ. n"],
)
def test_ids_are_the_librarys(text):
    tokenizer = token_files._library(PATH)[2]
    assert "".join(pieces.cut_signs(text)).replace("\0", "") == text.replace("\0", "")
    want = tokenizer.encode(text, add_special_tokens=False).ids
    assert token_files.encode_text(text, PATH).tolist() == want


def test_ids_of_random_texts_are_the_librarys():
    rng, tokenizer = random.Random(9), token_files._library(PATH)[2]
    parts = ["ab", "É", "7", ",", ".", "\n", " ", ", ", ". ", ".\n", "'s", "!", "字", " ", "Zoë"]
    for _ in range(3000):
        text = "".join(rng.choices(parts, k=rng.randint(1, 14)))
        want = tokenizer.encode(text, add_special_tokens=False).ids
        assert token_files.encode_text(text, PATH).tolist() == want, text
