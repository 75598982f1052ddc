"""Long runs of one character: ids as the library gives them, and no crash."""

from __future__ import annotations

import numpy as np
import pytest
from tokenizers import Tokenizer

from tallyshelf.llm import tokens

PATH = tokens.public_file("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


@pytest.mark.parametrize("char", [" ", "\n", "\t", "a", "́", "!", " \n", "　"])
def test_two_million_characters(library, char):
    run = char * (2_000_000 // len(char))
    for text in (run, f"word {run} word"):
        assert np.frombuffer(tokens.load(PATH).ids(text), "<u4").tolist() == library.encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize("text", [
    "a" + " " * 999 + "b" + " " * 1000 + "c" + " " * 1001 + "d", " " * 1000, "a" + "\n" * 5000 + " b", "a" + " " * 5000 + "\tb",
    "<|endoftext|>" + "\n" * 1500 + "<|endoftext|>", "x" + " " * 2000 + "<|endoftext|>y", "a　" * 700 + " " * 1200 + "\x1c" + " " * 1200,
])
def test_cuts_at_runs(library, text):
    assert np.frombuffer(tokens.load(PATH).ids(text), "<u4").tolist() == library.encode(text, add_special_tokens=False).ids
