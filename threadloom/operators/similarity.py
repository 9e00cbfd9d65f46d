"""Matching-block similarity of texts, and an index that says which pairs cannot be similar."""

from __future__ import annotations

import difflib

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import RELAXED, Gate

#: Lengths of the grams that are indexed: few long ones for texts whose matches are long, short ones for the rest.
GRAMS = (8, 3)
_STEPS = [pow(0x9E3779B97F4A7C15, k, 1 << 64) for k in range(max(GRAMS))]


class Close:
    """A text that is compared with others: matching-block similarity, this text first (the measure is not symmetric). No built-in computes it.

    Three bounds come before it. Let M be the characters in matching blocks, a and b the lengths. Similar means 2 M > least (a + b), so M is at least m = least (a + b) / 2.

    1. Lengths: M is at most the shorter one.
    2. Grams. Between blocks that follow each other some character matches nothing, so there are at most a + b - 2 m + 1 blocks. A matcher that leaves out popular characters of the second
       text (those above one in a hundred, from 200 characters on) begins a block at none of them, so each block also holds one of the rare characters, and there are at most as many
       blocks as these. With k blocks at most, at least p = m - (q - 1) k places of either text begin a gram of q characters that lies in a block and hence stands in the
       other text too. Of the places of a text, at most (places - p) begin a gram that the other does not have; so of its distinct grams d at least d - (places - p) are common. Grams are
       bits of a long integer by their hash; two in one bit only make d smaller and what is common larger. A pair with fewer common bits than that cannot be similar.
    3. Blocks are a common subsequence, so the longest one bounds them; it is counted with a bit for each character, all at once in a long integer.
    """

    __slots__ = ("_at", "_bits", "full", "least", "n", "rare", "size", "text")

    def __init__(self, text: str, least: float):
        self.text, self.least, self.n = text, least, len(text)
        self._at: dict[str, int] | None = None
        codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
        self.rare = self.n
        if self.n >= 200:  # fixed values: how the matcher knows popular characters
            counts = np.unique(codes, return_counts=True)[1]
            self.rare = int(counts[counts <= self.n // 100 + 1].sum())
        # sixteen bits for a character
        self.size = max(10, (16 * self.n).bit_length())
        self._bits = {(q, self.size): self._bitmap(codes, q) for q in GRAMS}

    def _bitmap(self, codes: np.ndarray, q: int) -> int:
        places = self.n - q + 1
        if places <= 0:
            return 0
        h = np.zeros(places, np.uint64)
        for k in range(q):
            h += codes[k : k + places] * np.uint64(_STEPS[k])
        h ^= h >> np.uint64(29)
        h *= np.uint64(0xBF58476D1CE4E5B9)
        held = np.zeros(1 << self.size, bool)
        held[(h >> np.uint64(64 - 40)) & np.uint64((1 << self.size) - 1)] = True
        return int.from_bytes(np.packbits(held, bitorder="little").tobytes(), "little")

    def bits(self, q: int, size: int) -> int:
        """The grams as 2^size bits: those of a larger size, folded."""
        if (q, size) not in self._bits:
            whole = self.bits(q, size + 1)
            self._bits[q, size] = (whole >> (1 << size)) | (whole & ((1 << (1 << size)) - 1))
        return self._bits[q, size]

    def common(self, other: str, needed: float = 0.0) -> int:
        """Length of the longest common subsequence; or, once it cannot come above `needed`, a bound of it that does not either."""
        if self._at is None:
            self._at = {}
            for i, c in enumerate(self.text):
                self._at[c] = self._at.get(c, 0) | 1 << i
            self.full = (1 << self.n) - 1
        row, full, at, m, n = self.full, self.full, self._at, self.n, len(other)
        for first in range(0, n, 64):
            for c in other[first : first + 64]:
                hit = row & at.get(c, 0)
                row = ((row + hit) | (row - hit)) & full
            left = n - min(first + 64, n)
            if (found := m - row.bit_count()) + left <= needed:
                return found + left
        return m - row.bit_count()

    def may_match(self, other: Close) -> bool:
        """False only for pairs that are not similar, by lengths and grams."""
        both = self.n + other.n
        if not both:
            return True
        if 2.0 * min(self.n, other.n) <= self.least * both:
            return False
        least = int(self.least * both / 2.0)
        blocks = min(other.rare, both - 2 * least + 1)
        size = min(self.size, other.size)
        for q in GRAMS:
            places = least - (q - 1) * blocks
            if places <= 0:
                continue
            mine, theirs = self.bits(q, size), other.bits(q, size)
            common = (mine & theirs).bit_count()
            for text, held in ((self, mine), (other, theirs)):
                if common < held.bit_count() - (text.n - q + 1 - places):
                    return False
        return True

    def to(self, other: Close | str) -> bool:
        other = other if isinstance(other, Close) else Close(other, self.least)
        both = self.n + other.n
        if not both:
            return 1.0 > self.least
        if not self.may_match(other) or 2.0 * self.common(other.text, self.least * both / 2.0) <= self.least * both:
            return False
        return difflib.SequenceMatcher(None, self.text, other.text).ratio() > self.least


def similar_pairs(rows: DataFrame, text_col: str = "text", seq: str = "seq", *, gate: Gate = RELAXED, reach: int | None = None) -> DataFrame:
    """(new, old) of rows within `reach` places of each other, by a dense place, whose similarity exceeds the gate's.

    rows need a dense `place`. Runs of 4 x reach places are compared within, together with the reach places before them, so a text travels to two tasks at most and pairs of texts to none. Null
    counts as empty.
    """
    reach = reach or gate.history
    run, least = 4 * reach, gate.similarity
    block = F.floor(F.col("place") / run)
    later = F.floor((F.col("place") + reach) / run)
    blocks = F.explode(F.array_distinct(F.array(block, later)))
    placed = rows.select(F.col(seq).cast("long").alias("seq"), F.col("place").cast("long").alias("place"), F.coalesce(F.col(text_col), F.lit("")).alias("text"), blocks.alias("block"))

    def compared(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("place")
        first = int(pdf["block"].iloc[0]) * run
        held: list[tuple[int, int, Close]] = []
        found = []
        for place, s, text in zip(pdf["place"].tolist(), pdf["seq"].tolist(), pdf["text"]):
            held = [x for x in held if x[0] >= place - reach]
            close = Close(text.lower().strip(), least)
            if place >= first:
                found += [(s, x[1]) for x in held if close.to(x[2])]
            held.append((place, s, close))
        return pd.DataFrame(found, columns=["new", "old"], dtype="int64")

    return placed.groupBy("block").applyInPandas(compared, "new long, old long")
