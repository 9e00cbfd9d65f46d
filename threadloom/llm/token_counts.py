"""Token counts by the whole-token shortcut.

Before any text is read, `prove` finds which strings of the vocabulary come out of the merges as one token when they stand
alone. A pre-token that is such a string counts 1 by one dictionary look-up; only the rest is merged, and what has been
merged is remembered in a bounded cache. The counts are those of the `tokenizers` library.
"""

from __future__ import annotations

import json

import pyarrow as pa
import regex
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_batches

#: Merged pre-tokens that a worker remembers.
CACHE = 400_000


def byte_letters() -> dict[str, int]:
    """The printable letter that byte-level vocabularies write for each byte: itself if printable, else the next free code point from 256."""
    printable = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    rest = [b for b in range(256) if b not in printable]
    return {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(rest)}


def library_class(pattern: str) -> str:
    """The code points that the library's regex engine counts in a class, as a class of ranges: its Unicode version differs from Python's."""
    from tokenizers import Regex, pre_tokenizers

    split = pre_tokenizers.Split(Regex(pattern), "removed", invert=True)
    points = [c for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    found = sorted({ord(c) for i in range(0, len(points), 8192) for word, _ in split.pre_tokenize_str("".join(map(chr, points[i : i + 8192]))) for c in word})
    ranges: list[list[int]] = []
    for c in found:
        if ranges and ranges[-1][1] == c - 1:
            ranges[-1][1] = c
        else:
            ranges.append([c, c])
    return "".join(rf"\U{a:08X}-\U{b:08X}" for a, b in ranges)


def pre_token_pattern(letter: str, number: str) -> str:
    return rf"'s|'t|'re|'ve|'m|'ll|'d| ?[{letter}]+| ?[{number}]+| ?[^\s{letter}{number}]+|\s+(?!\S)|\s+"


class Merges:
    """Byte-pair merges of a vocabulary file of the tokenizers library."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self.specials = [t["content"] for t in spec["added_tokens"]]
        letters = byte_letters()
        special = set(self.specials)
        self.ids = {bytes(letters[c] for c in s): i for s, i in spec["model"]["vocab"].items() if s not in special}
        self.rank = {tuple(bytes(letters[c] for c in part) for part in pair): i for i, pair in enumerate(spec["model"]["merges"])}

    def merge(self, word: bytes) -> list[bytes]:
        """The plain definition: join the adjacent pair of lowest rank, the leftmost first, until none is left."""
        parts = [word[i : i + 1] for i in range(len(word))]
        while len(parts) > 1:
            best, at = min((self.rank.get(pair, len(self.rank)), i) for i, pair in enumerate(zip(parts, parts[1:])))
            if best == len(self.rank):
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return parts


def prove(path: str) -> dict[str, int]:
    """Tokens of each string of the vocabulary that stands alone: 1 where the merges arrive at it, and more for the few they never reach."""
    merges = Merges(path)
    found = {}
    for word in merges.ids:
        try:
            found[word.decode()] = len(merges.merge(word))
        except UnicodeDecodeError:
            pass  # a part of a character: no pre-token is this string
    return found


class Counter(dict):
    """Tokens of a pre-token: what was proven, else by merging, remembered."""

    def __init__(self, whole: dict[str, int], ranks: dict[bytes, int]):
        super().__init__(whole)
        self.whole = whole
        self.merger = tiktoken.Encoding("rest", pat_str=r"(?s).+", mergeable_ranks=ranks, special_tokens={})

    def __missing__(self, word: str) -> int:
        if len(self) >= CACHE + len(self.whole):
            self.clear()
            self.update(self.whole)
        n = len(self.merger.encode_ordinary(word))
        if len(word) <= 64:
            self[word] = n
        return n


def token_counts(docs: DataFrame, path: str, *, id_col: str = "doc_id", text_col: str = "text", limit: int = 512) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit for each row of docs.

    path: a byte-level vocabulary of the tokenizers library, the same on driver and executors. Special strings in a text are
    one token each, as the library has it. A null or empty text has 0 bytes and 0 tokens. Rows that repeat are counted each;
    a null id is kept; other columns of docs, whatever their names, are not read.
    """
    spark = docs.sparkSession
    merges = Merges(path)
    letter, number = library_class(r"\p{L}"), library_class(r"\p{N}")
    shared = spark.sparkContext.broadcast((prove(path), merges.ids, merges.specials, pre_token_pattern(letter, number)))
    state: dict = {}

    def counts(texts: list[str | None]) -> list[int]:
        if not state:
            whole, ranks, specials, exact = shared.value
            count = Counter(whole, ranks)
            quick, exact = regex.compile(pre_token_pattern(r"\p{L}", r"\p{N}")), regex.compile(exact)
            cut = regex.compile("|".join(map(regex.escape, specials))) if specials else None

            def one(text: str) -> int:
                try:
                    text.encode("latin-1")
                    find = quick.findall
                except UnicodeEncodeError:
                    find = exact.findall
                return sum(map(count.__getitem__, find(text)))

            def of(text: str | None) -> int:
                if not text:
                    return 0
                if any(s in text for s in specials):
                    parts = cut.split(text)
                    return sum(map(one, parts)) + len(parts) - 1
                return one(text)

            state["of"] = of
        return [state["of"](t) for t in texts]

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        n = pa.array(counts(batch.column(2).to_pylist()), pa.int64())
        return pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), n], ["doc_id", "n_bytes", "n_tokens"])

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.octet_length(text_col), F.lit(0)).cast("long").alias("n_bytes"), F.col(text_col).alias("text"))
    return map_batches(rows, work, "doc_id long, n_bytes long, n_tokens long").withColumn("over_limit", F.col("n_tokens") > limit)
