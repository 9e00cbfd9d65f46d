"""Line deduplication by a log-template tree.

A line goes down a tree of fixed depth: its number of tokens, then its leading tokens, fields that vary (tokens with a digit) being generalised to one
mark. At the leaf it belongs to the template of all its generalised tokens, and, if it is long enough, to the templates that keep only one half of its positions (front, back, even, odd) and
leave the others open, so lines that differ in some words are one template too. A template that stands in enough documents is recurring, and its lines are dropped
from all documents but the first.

A template is a key of 64 bits and a check of 32 more, so that unlike templates do not meet in a corpus of 10^12 lines; the tree is counted by one aggregation with partial sums
in each batch: no leaf, however full, meets in one task.
"""

from __future__ import annotations

import re
import struct
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import BATCH_ROWS, cut

MARK = "<*>"
#: Leading tokens of a path; literal tokens of a template at least; tokens of a line from which half of the positions may be open, and literal tokens of such a half.
DEPTH, LITERAL, LONG, HALF_LITERAL = 2, 3, 12, 5
#: Characters of a script without spaces from which one token is a line like others; documents that any other line of one word must stand in, since such a line may be an answer or a heading.
UNSPACED_LONG, WORD_DOCS = 8, 10
#: Thai, Lao, Tibetan, Burmese, Khmer, kana, Han.
_UNSPACED = re.compile("[\u0e00-\u0fff\u1000-\u109f\u1780-\u17ff\u3040-\u30ff\u3400-\u9fff\uf900-\ufaff\U00020000-\U0003ffff]")
#: Stands for the first document of a template that only documents without an id have.
NOBODY = -(1 << 63)
_DIGIT = re.compile(r"\d")
_SIGNED = struct.Struct("<qi")


def template_keys(line: str) -> list[tuple[int, int]]:
    """(key, check) of a line's templates; none for a blank line or one word (see word_keys). A line of two or three tokens stands for itself."""
    tokens = line.lower().split()
    n = len(tokens)
    if n == 0 or n == 1 and len(_UNSPACED.findall(tokens[0])) < UNSPACED_LONG:
        return []
    literal = n
    if _DIGIT.search(line):
        general = [MARK if _DIGIT.search(t) else t for t in tokens]
        literal = n - general.count(MARK)
        # a line of almost nothing but numbers is no template: it stands for itself
        tokens = general if literal >= LITERAL else tokens
    path = f"{n}\n" + "\n".join(tokens[:DEPTH])
    found = [_key(f"{path}\nall\n", tokens)]
    if n >= LONG and literal >= HALF_LITERAL:
        half = (n + 1) // 2
        for name, part in (("front", tokens[:half]), ("back", tokens[half:]), ("even", tokens[::2]), ("odd", tokens[1::2])):
            if len(part) - part.count(MARK) >= HALF_LITERAL:
                found.append(_key(f"{path}\n{name}\n", part))
    return found


def word_keys(line: str) -> list[tuple[int, int]]:
    """(key, check) of a line of one word; none for others."""
    tokens = line.lower().split()
    return [_key("1\nword\n", tokens)] if len(tokens) == 1 and not template_keys(line) else []


def _key(path: str, tokens: list[str]) -> tuple[int, int]:
    return _SIGNED.unpack_from(xxhash.xxh3_128_digest(path + " ".join(tokens)))


def recurring_templates(docs: DataFrame, *, min_docs: int = 2, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """key, check, n (documents), first (smallest id that has it; null if none has an id) of the templates that at least min_docs documents have; of lines of one word, WORD_DOCS at least."""
    docs.sparkSession.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            seen: dict[tuple[int, int], list] = {}
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                lines = text.split("\n")
                words = {k for line in lines for k in word_keys(line)}
                for key in words | {k for line in lines for k in template_keys(line)}:
                    if key in seen:
                        entry = seen[key]
                        entry[0] += 1
                        entry[1] = doc_id if entry[1] is None else entry[1] if doc_id is None else min(entry[1], doc_id)
                    else:
                        seen[key] = [1, doc_id, key in words]
            if seen:
                keys, checks = zip(*seen)
                yield pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), pa.array(checks, pa.int32()), pa.array([e[0] for e in seen.values()], pa.int64()), pa.array([e[1] for e in seen.values()], pa.int64()), pa.array([e[2] for e in seen.values()], pa.bool_())], ["key", "check", "n", "first", "word"])

    rows = docs.where(F.col(text_col).isNotNull()).select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    counts = rows.mapInArrow(count, "key long, check int, n long, first long, word boolean").groupBy("key", "check").agg(F.sum("n").alias("n"), F.min("first").alias("first"), F.max("word").alias("word"))
    return cut(counts.where(F.col("n") >= F.when(F.col("word"), max(min_docs, WORD_DOCS)).otherwise(min_docs)).drop("word"), "templates")


def deduplicated_lines(docs: DataFrame, *, min_docs: int = 2, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_lines, n_dropped, clean_text for each row of docs.

    A line is dropped if any of its templates is recurring and has its first occurrence in a document of another id; a document without an id is never the
    first. Blank lines always stay, lines of one word unless WORD_DOCS documents have them. A null text has no lines and stays null. Rows that share an id and text get equal results. An empty
    table gives no rows. Other columns are not read.

    Recurring templates grow with the corpus, so they are never sent to all executors: the keys of all lines are joined with them, at every size.
    """
    spark = docs.sparkSession
    found = recurring_templates(docs, min_docs=min_docs, id_col=id_col, text_col=text_col)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    schema = "doc_id long, n_lines long, n_dropped long, clean_text string"
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)
    found = found.select("key", "check", F.coalesce("first", F.lit(NOBODY)).alias("first"))

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = [(i, h, at, *k) for i, h, t in zip(*(batch.column(c).to_pylist() for c in range(3))) for at, line in enumerate((t or "").split("\n")) for k in template_keys(line) + word_keys(line)]
            if out:
                kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int32())
                yield pa.RecordBatch.from_arrays([pa.array(c, kind) for c, kind in zip(zip(*out), kinds)], ["doc_id", "hash", "at", "key", "check"])

    lines = rows.select("doc_id", F.xxhash64("text").alias("hash"), "text").mapInArrow(spread, "doc_id long, hash long, at long, key long, check int")
    lost = lines.join(found, ["key", "check"]).where(~F.col("doc_id").eqNullSafe(F.col("first"))).groupBy(F.col("doc_id").alias("of"), "hash").agg(F.collect_set("at").alias("lost"))
    marked = rows.join(lost, F.col("doc_id").eqNullSafe(F.col("of")) & (F.xxhash64("text") == F.col("hash")), "left").select("doc_id", "text", "lost")

    def drop(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for i, text, at in zip(*(batch.column(c).to_pylist() for c in range(3))):
                out.append(_cleaned(i, text, set(at or ())))
            yield _batch(out)

    return marked.mapInArrow(drop, schema)


def _cleaned(doc_id: int | None, text: str | None, lost: set[int]) -> tuple:
    if text is None:
        return doc_id, 0, 0, None
    lines = text.split("\n")
    kept = [line for at, line in enumerate(lines) if at not in lost]
    return doc_id, len(lines), len(lines) - len(kept), "\n".join(kept)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows)) or [(), (), (), ()]
    return pa.RecordBatch.from_arrays([pa.array(c, kind) for c, kind in zip(columns, (pa.int64(), pa.int64(), pa.int64(), pa.string()))], ["doc_id", "n_lines", "n_dropped", "clean_text"])
