"""Token ids of whole texts, as the `tokenizers` library gives them for a lower-casing vocabulary with word ends.

Such a vocabulary never joins anything across white space, so a text is cut at ASCII white space and each piece is encoded
by itself and remembered. A piece of Latin-1 letters is merged by tiktoken's merger over the same merges, the word's end being
a byte of its own; any other piece (special strings, other scripts, NUL) goes to the library. Pieces of Latin-1 letters that
some texts have and that are not remembered yet are merged in one call. A worker keeps what it remembers from task to task.
"""

from __future__ import annotations

import functools
import json
import os
import re
from collections.abc import Iterable, Iterator
from itertools import batched, chain, islice

import numpy as np
import regex
import tiktoken

from .token_counts import byte_letters

#: Pieces that a worker remembers.
CACHE = 400_000
#: Longest piece that is remembered, in bytes.
LONGEST = 64
#: Characters of the texts whose pieces are learned together, about, and most of the pieces that are.
GROUP = 1 << 16
AT_ONCE = 1 << 16
END = "\x00"


def latin(pattern: str) -> str:
    """A pattern whose classes stand between brackets, for text of Latin-1 letters: `re` is faster than `regex` and knows no \\p."""
    for name in (r"\p{L}", r"\p{N}", r"\s"):
        pattern = pattern.replace(name, "".join(f"\\x{c:02x}" for c in range(256) if regex.match(name, chr(c))))
    return pattern


class PieceIds(dict):
    """Piece of text (UTF-8, no ASCII white space) -> its ids as little-endian integers of `dtype`."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        super().__init__()
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model, letters = spec["model"], byte_letters()
        suffix = model["end_of_word_suffix"]
        self.specials = [t["content"] for t in spec["added_tokens"]]
        self.library = Tokenizer.from_file(path)
        vocab = {s: i for s, i in model["vocab"].items() if s not in set(self.specials)}
        self.dtype = np.dtype("<u2" if max([*vocab.values(), *(t["id"] for t in spec["added_tokens"])]) < 65536 else "<u4")
        plain = lambda s: bytes(letters[c] for c in s)
        ranks = {plain(s.removesuffix(suffix)) + END.encode() if s.endswith(suffix) else plain(s): i for s, i in vocab.items()}
        # one word at a time, or many in a row, each with its end
        self.merger = tiktoken.Encoding("ends", pat_str=rf"[^{END}]+{END}", mergeable_ranks=ranks, special_tokens={})
        pattern = spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"]
        self.find = regex.compile(pattern).findall
        # a line feed, which no piece holds, stands between pieces and is a word and an id by itself
        self.find_all = re.compile(rf"{latin(pattern)}|\n").findall
        self.between = ranks[f"\n{END}".encode()]

    def plain(self, text: str) -> bool:
        """Of Latin-1 letters, without NUL and special strings."""
        if END in text or any(s in text for s in self.specials):
            return False
        try:
            text.encode("latin-1")
        except UnicodeEncodeError:
            return False
        return True

    def ids(self, piece: str) -> list[int]:
        if not self.plain(piece):
            return self.library.encode(piece, add_special_tokens=False).ids
        return [i for word in self.find(piece.lower()) for i in self.merger.encode_ordinary(word + END)]

    def __missing__(self, piece: bytes) -> bytes:
        out = np.array(self.ids(piece.decode()), self.dtype).tobytes()
        if len(piece) <= LONGEST:
            if len(self) >= CACHE:
                self.clear()
            self[piece] = out
        return out

    def learn(self, pieces: set[bytes]) -> None:
        """Remembers the plain ones of some unknown pieces by one call of the merger. The others and long ones are left to __missing__."""
        fresh = [p for p in pieces if len(p) <= LONGEST][:CACHE]
        text = b"\n".join(fresh).decode()
        if not self.plain(text):
            fresh = [p for p in fresh if self.plain(p.decode())]
            text = b"\n".join(fresh).decode()
        if not fresh:
            return
        if len(self) + len(fresh) > CACHE:
            self.clear()
        words = [*self.find_all(text.lower()), "\n", ""]
        ids = np.array(self.merger.encode_ordinary(END.join(words)), self.dtype)
        ends = (np.flatnonzero(ids == self.between) * self.dtype.itemsize).tolist()
        starts = [0, *(end + self.dtype.itemsize for end in ends[:-1])]
        raw = ids.tobytes()
        self.update(zip(fresh, [raw[a:b] for a, b in zip(starts, ends)], strict=True))

    def encode(self, text: str | None) -> bytes:
        return b"".join(map(self.__getitem__, text.encode().split())) if text else b""

    def learned(self, pieces: tuple[bytes, ...]) -> list[bytes]:
        found = list(map(self.get, pieces))
        if None in found:
            missing = [p for p, ids in zip(pieces, found) if ids is None]
            self.learn(set(missing))
            rest = map(self.__getitem__, missing)
            found = [next(rest) if ids is None else ids for ids in found]
        return found

    def encode_all(self, texts: Iterable[str | None]) -> Iterator[bytes]:
        """The ids of each text. The pieces of texts of about GROUP characters are learned together, those of a long text AT_ONCE at a time."""
        texts = iter(texts)
        while group := list(some(texts, GROUP)):
            cut = [text.encode().split() if text else [] for text in group]
            ids = chain.from_iterable(map(self.learned, batched(chain.from_iterable(cut), AT_ONCE)))
            for pieces in cut:
                yield b"".join(islice(ids, len(pieces)))


def some(texts: Iterator[str | None], size: int) -> Iterator[str | None]:
    """The next texts, until they have `size` characters together."""
    for text in texts:
        yield text
        size -= len(text or "")
        if size <= 0:
            return


@functools.lru_cache(maxsize=1)
def _kept(path: str, changed: int) -> PieceIds:
    return PieceIds(path)


def piece_ids(path: str) -> PieceIds:
    """The PieceIds of this process for a vocabulary file, so that the tasks of a worker build and learn once."""
    return _kept(path, os.stat(path).st_mtime_ns)
