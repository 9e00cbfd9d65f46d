"""Lempel-Ziv phrase fingerprints.

A text's UTF-8 bytes are parsed into phrases, each the longest phrase known so far with one byte more. The set of phrases is hashed and its
`SIZE` least hashes are the signature; the share of equal hashes among the least of two signatures' union estimates the Jaccard likeness of
their phrase sets, which moves with how well one text compresses the other.
"""

from __future__ import annotations

import hashlib
import json
from bisect import bisect_right
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import BATCH_ROWS

#: Hashes of a signature.
SIZE = 128
#: Bytes of text of a range about, so that a task's share stays the same when the input grows; sampled rows for each range.
RANGE_BYTES, DRAWN = 32 << 20, 40


def parse(data: bytes, known: dict[bytes, int], at: int = 0) -> dict[bytes, int]:
    """Goes on parsing at a position; known maps each phrase to its end, in order of discovery.

    Known phrases are closed under prefixes, so the longest match is looked for from a guess, upwards or downwards, not from one byte.
    """
    n, guess = len(data), 3
    while at < n:
        end = at + guess
        if data[at:end] in known:
            end += 1
            while end <= n and data[at:end] in known:
                end += 1
            if end > n:
                break  # what is left is a known phrase
        else:
            end = min(end, n)
            while end - 1 > at and data[at : end - 1] not in known:
                end -= 1
        known[data[at:end]] = end
        guess = end - at
        at = end
    return known


def hashes(phrases: list[bytes]) -> np.ndarray:
    x = np.fromiter(map(crc32, phrases), np.uint32, len(phrases))
    x = (x ^ (x >> np.uint32(16))) * np.uint32(0x7FEB352D)
    x = (x ^ (x >> np.uint32(15))) * np.uint32(0x846CA68B)
    return x ^ (x >> np.uint32(16))


def least(values: np.ndarray) -> np.ndarray:
    if len(values) > SIZE:
        # more than SIZE, since two phrases may have one hash
        values = np.partition(values, min(2 * SIZE, len(values) - 1))[: 2 * SIZE]
    return np.unique(values)[:SIZE]


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    if not len(a) or not len(b):
        return float(len(a) == len(b))
    union = np.union1d(a, b)[:SIZE]
    return float(np.isin(union, np.intersect1d(a, b, assume_unique=True), assume_unique=True).sum() / len(union))


class Parsed:
    """A document with its phrases (each with its end, in order of discovery) and their hashes."""

    def __init__(self, doc_id: int | None, text: str | None):
        self.doc_id, self.text = doc_id, text or ""
        self.known = parse(self.text.encode(), {})
        self.hashes = hashes(list(self.known))
        self.signature = least(self.hashes)

    def edited(self, following: str) -> tuple[str, np.ndarray]:
        """The text whose last third is replaced by as many characters of the following one, and its signature. Phrases that end before the change stay;
        the others are taken out, so this is asked once."""
        third = len(self.text) // 3
        if not third:
            return self.text, self.signature
        kept = self.text[: len(self.text) - third]
        text = kept + following[:third]
        same = bisect_right(list(self.known.values()), len(kept.encode()))
        while len(self.known) > same:
            self.known.popitem()
        at = next(reversed(self.known.values())) if same else 0
        fresh = list(parse(text.encode(), self.known, at))[same:]
        return text, least(np.concatenate([self.hashes[:same], hashes(fresh)]))


def _cuts(keys: DataFrame, ranges: int, rows: int, top: tuple[int | None, int]) -> list[tuple[int | None, int]]:
    """The greatest key (doc_id, tie) of each range, ascending: keys of the table, the last one being its greatest. From a sample by hash of about DRAWN rows for each range."""
    every = max(1, rows // (DRAWN * ranges))
    drawn = keys.where(F.pmod(F.xxhash64(F.lit(5), "doc_id", "tie"), F.lit(every)) == 0).distinct().toArrow()
    held = sorted(zip(drawn["doc_id"].to_pylist(), drawn["tie"].to_pylist()), key=_order)
    cuts = [held[i * len(held) // ranges] for i in range(1, ranges)] if held else []
    return [k for i, k in enumerate(cuts) if k != top and (not i or k != cuts[i - 1])] + [top]


def _order(key: tuple[int | None, int]) -> tuple:
    return key[0] is not None, key[0] or 0, key[1]


def _literal(keys: list, kind: str) -> Column:
    """A constant column of keys or of lists of keys."""
    return F.from_json(F.lit(json.dumps(keys)), kind)


def _range(key: Column, cuts: list[tuple[int | None, int]]) -> Column:
    """How many cuts are below a key (a struct; null ids are the smallest); found in two steps, so that many cuts cost little."""
    named = [{"doc_id": i, "tie": t} for i, t in cuts]
    step = max(1, int(len(cuts) ** 0.5))
    groups = [named[i : i + step] for i in range(0, len(named), step)]
    kind = "struct<doc_id:bigint,tie:bigint>"
    full = F.size(F.filter(_literal([g[-1] for g in groups], f"array<{kind}>"), lambda c: c < key))
    inside = F.try_element_at(_literal(groups, f"array<array<{kind}>>"), full + 1)
    return full * step + F.coalesce(F.size(F.filter(inside, lambda c: c < key)), F.lit(0))


FIELDS = [("doc_id", pa.int64()), ("n_chars", pa.int64()), ("edited_sha256", pa.string()), ("fingerprint", pa.string()), ("edited_fingerprint", pa.string()), ("near_edited", pa.float64()), ("near_next", pa.float64())]


def lz_fingerprints(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next for each row of docs.

    The next document has the next smaller id, null ids being the smallest; rows that share an id go by a hash of their texts, the greatest first; after the last comes
    the first, so a single row is its own next. A null text is empty; an empty text has an empty fingerprint, which is like (1.0)
    another empty one and unlike (0.0) any other. An empty table gives no rows. Other columns are not read.

    Texts are shuffled once, to ranges of (id, hash of the text), so rows that share an id are spread. The greatest key of each range is known before, and its row goes,
    as the one that follows, to the range above too; so no task sees all ids. Rows alike in id and text meet in one task, which works out the first of them only.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"), F.xxhash64(F.coalesce(F.col(text_col), F.lit(""))).alias("tie"))
    keys = rows.select("doc_id", "tie", F.octet_length("text").alias("n"))
    found = keys.agg(F.count("*").alias("rows"), F.sum("n").alias("bytes"), F.max(F.struct("doc_id", "tie")).alias("top")).first()
    ranges = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-(found["bytes"] or 0) // RANGE_BYTES))
    cuts = _cuts(keys.select("doc_id", "tie"), ranges, found["rows"], tuple(found["top"]) if found["rows"] else (None, 0))
    key = F.struct("doc_id", "tie")
    # by inline, so that the place of a row is worked out once
    rows = rows.select("*", F.inline(F.array(F.struct(_range(key, cuts).alias("own")))))
    heads = _literal([{"doc_id": i, "tie": t} for i, t in cuts], "array<struct<doc_id:bigint,tie:bigint>>")
    head = F.try_element_at(heads, F.col("own") + 1).eqNullSafe(key)
    at = F.array(F.struct(F.col("own").alias("range"), F.lit(False).alias("copy")))
    twice = F.array_append(at, F.struct(((F.col("own") + 1) % len(cuts)).alias("range"), F.lit(True).alias("copy")))
    rows = rows.select("doc_id", "text", "tie", F.inline(F.when(head, twice).otherwise(at)))
    rows = rows.repartitionById(len(cuts), F.col("range")).sortWithinPartitions("copy", F.col("doc_id").desc_nulls_last(), F.col("tie").desc())
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, alike, out = None, None, []

        def hexed(signature: np.ndarray) -> str:
            return signature.astype(">u4").tobytes().hex()

        for batch in batches:
            for doc_id, text, copy in zip(*(batch.column(i).to_pylist() for i in range(3))):
                if last is None and copy:
                    continue  # a further row of the following key
                if last is not None and not copy and doc_id == last.doc_id and (text or "") == last.text:
                    # the same row again: what follows it is itself
                    alike = alike or Parsed(doc_id, text).edited(last.text)
                    out.append((doc_id, len(last.text), hashlib.sha256(alike[0].encode()).hexdigest(), hexed(last.signature), hexed(alike[1]), likeness(last.signature, alike[1]), 1.0))
                    continue
                now = Parsed(doc_id, text)
                if last is not None:
                    edited, signature = last.edited(now.text)
                    out.append((last.doc_id, len(last.text), hashlib.sha256(edited.encode()).hexdigest(), hexed(last.signature), hexed(signature), likeness(last.signature, signature), likeness(last.signature, now.signature)))
                last, alike = None if copy else now, None
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, kind) for c, (_, kind) in zip(zip(*out), FIELDS)], [name for name, _ in FIELDS])
                out = []

    return rows.select("doc_id", "text", "copy").mapInArrow(run, "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double")
