"""Pieces of several texts learned by one call of the merger, and kept by a worker from task to task."""

import os
import random
import shutil

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from threadloom.llm import token_ids

PATH = public_tokenizers.path("word_bpe_49k.json")
HARD = ["ΑΣ Σ", "İ ı", "\x00 a\x00", "<|endoftext|>x<|startoftext|> y", "²½ª µ ß", "\x1c\x85a\xa0b \xa0 \x85", "don't WE'LL 's ''s 'tis", "é É", "a" * 300, "日本 é x", "", None, " \n\t", "12a3", "\xa0", "Ġ Ċ ​"]


class Calls:
    """The merger, its calls counted."""

    def __init__(self, merger):
        self.merger, self.n = merger, 0

    def encode_ordinary(self, text):
        self.n += 1
        return self.merger.encode_ordinary(text)


def plain_texts(n):
    r = random.Random(5)
    return ["".join(chr(r.choice([32, 32, 39, r.randrange(48, 123), r.randrange(161, 256)])) for _ in range(120)) for _ in range(n)]


@pytest.mark.parametrize(("group", "at_once", "cache"), [(1, 1 << 16, 400_000), (50, 3, 6), (1 << 16, 7, 40), (1 << 16, 1 << 16, 40), (1 << 16, 1 << 16, 400_000)])
def test_texts_together_give_the_ids_of_the_library(monkeypatch, group, at_once, cache):
    monkeypatch.setattr(token_ids, "GROUP", group)
    monkeypatch.setattr(token_ids, "AT_ONCE", at_once)
    monkeypatch.setattr(token_ids, "CACHE", cache)
    texts = [*HARD, *plain_texts(60), *HARD]
    library, pieces = Tokenizer.from_file(PATH), token_ids.PieceIds(PATH)
    found = [np.frombuffer(x, pieces.dtype).tolist() for x in pieces.encode_all(texts)]
    assert found == [library.encode(t or "", add_special_tokens=False).ids for t in texts]
    assert len(pieces) <= cache
    assert list(pieces.encode_all([])) == []


def test_plain_pieces_are_merged_in_one_call():
    pieces = token_ids.PieceIds(PATH)
    pieces.merger = Calls(pieces.merger)
    texts = plain_texts(50)
    first = list(pieces.encode_all(texts))
    assert pieces.merger.n == 1
    assert list(pieces.encode_all(texts)) == first and pieces.merger.n == 1
    # a piece of another script or a special string does not send its neighbours another way
    list(pieces.encode_all(["newone ΑΣ <|endoftext|> newtwo newthree"]))
    assert pieces.merger.n == 2


def test_words_of_latin_text_are_those_of_the_pattern():
    pieces = token_ids.PieceIds(PATH)
    letters = [chr(c) for c in range(1, 256) if chr(c) not in " \t\n\v\f\r"]
    texts = [a + b for a in letters for b in letters]
    texts += [a + "'" + end + b for end in ("s", "t", "re", "ve", "m", "ll", "d", "r", "x") for a in "a1(' \xa0" for b in "a1)'"]
    for text in texts:
        text = text.lower()
        assert pieces.find_all(text) == pieces.find(text), repr(text)


def test_a_worker_keeps_its_pieces(tmp_path):
    path = str(shutil.copy(PATH, tmp_path / "vocabulary.json"))
    pieces = token_ids.piece_ids(path)
    assert token_ids.piece_ids(path) is pieces
    os.utime(path, ns=(1, 1))
    assert token_ids.piece_ids(path) is not pieces
