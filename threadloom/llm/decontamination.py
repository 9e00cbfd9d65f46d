"""Benchmark decontamination: token windows of documents that a set of benchmark n-grams holds. DataFrame operations only.

Every window of an item is an n-gram of the set. A window can only stand where its longest word stands, so the scan looks up each document
word among these gate words, forms the windows that a hit allows, looks each up in the n-gram set and so verifies it word by word.
Both look-ups are broadcast joins. A set beyond SET_BYTES is cut into blocks of that size, and the documents are scanned once for each: a document's words are
never shuffled, at any size of the set.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import ascii_lower, cut, small

SEPARATORS = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
#: Bytes of grams that are broadcast at once.
SET_BYTES = 32 << 20


def words_of(text: Column) -> Column:
    """The words [^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+ of a text whose A-Z are made lower case. Null and empty texts have none."""
    return F.coalesce(F.array_remove(F.split(ascii_lower(text), SEPARATORS), ""), F.array().cast("array<string>"))


def gram_set(benchmark: DataFrame, width: int, id_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """item, gram (words joined by spaces), n_words, gate (the gram's longest word) and gate_at (its place) of each window of each item."""
    items = benchmark.select(F.col(id_col).cast("string").alias("item"), words_of(F.col(text_col)).alias("words")).where("item IS NOT NULL AND size(words) > 0")
    n = F.least(F.size("words"), F.lit(width))
    grams = items.select("item", F.explode(F.transform(F.sequence(F.lit(1), F.size("words") - n + 1), lambda i: F.slice("words", i, n))).alias("words")).distinct()
    gate = F.array_max(F.transform("words", lambda w, i: F.struct(F.length(w).alias("n"), w.alias("word"), i.alias("at"))))
    return grams.select("item", F.array_join("words", " ").alias("gram"), F.size("words").alias("n_words"), gate.alias("gate")).select("item", "gram", "n_words", F.col("gate.word").alias("gate"), F.col("gate.at").alias("gate_at"))


def occurrences(docs: DataFrame, benchmark: DataFrame, *, width: int = 10, id_col: str = "doc_id", text_col: str = "text", set_bytes: int = SET_BYTES) -> DataFrame:
    """doc_id, key (a hash of the text), start, n_words, item: every occurrence of a window in a document, words from 0; each once."""
    grams = cut(gram_set(benchmark, width).withColumn("hash", F.xxhash64("gram")), "grams")
    blocks = max(1, -(-(grams.agg(F.sum(F.octet_length("gram") + F.octet_length("item") + 64)).first()[0] or 0) // set_bytes))
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(text_col).alias("key"), words_of(F.col(text_col)).alias("words"))
    found = None
    for block in range(blocks):
        here = grams.where(F.pmod("hash", F.lit(blocks)) == block)
        gates = F.broadcast(here.select("gate", "gate_at", "n_words").distinct())
        placed = rows.select("doc_id", "key", "words", F.posexplode("words").alias("at", "word")).join(gates, F.col("word") == F.col("gate"))
        start = F.col("at") - F.col("gate_at")
        windows = placed.where((start >= 0) & (start + F.col("n_words") <= F.size("words"))).select("doc_id", "key", start.alias("start"), F.array_join(F.slice("words", F.greatest(start + 1, F.lit(1)), F.col("n_words")), " ").alias("gram"))
        hit = windows.join(F.broadcast(here.select("gram", "n_words", "item")), "gram").select("doc_id", "key", "start", "n_words", "item")
        found = hit if found is None else found.unionByName(hit)
    return found.distinct()


def _covered(spans: Column) -> Column:
    """Words that sorted (start, end) spans cover."""
    begin = F.struct(F.lit(0).alias("upto"), F.lit(0).cast("long").alias("n"))
    step = lambda acc, s: F.struct(F.greatest(acc["upto"], s["end"]).alias("upto"), (acc["n"] + F.greatest(s["end"] - F.greatest(acc["upto"], s["start"]), F.lit(0))).alias("n"))
    return F.aggregate(spans, begin, step, lambda acc: acc["n"])


def hits(docs: DataFrame, benchmark: DataFrame, *, width: int = 10, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, key, spans (sorted), items (sorted) of the documents that hold a window, in a table of its own."""
    found = occurrences(docs, benchmark, width=width, id_col=id_col, text_col=text_col)
    spans = F.array_sort(F.collect_set(F.struct(F.col("start"), (F.col("start") + F.col("n_words")).alias("end"))))
    return cut(found.groupBy("doc_id", "key").agg(spans.alias("spans"), F.array_sort(F.collect_set("item")).alias("items")), "hits")


def decontamination(docs: DataFrame, benchmark: DataFrame, *, width: int = 10, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256, contaminated, spans for each row of docs.

    A window is `width` consecutive words of an item, or all of an item of fewer. Null and empty texts have no words; items without an id or words
    have no windows, and items that share an id are one. Rows that share an id and a text get equal results. Empty tables of either kind give no hits.
    Other columns, whatever their names, are not read.
    """
    found = hits(docs, benchmark, width=width, id_col=id_col, text_col=text_col).select(F.col("doc_id").alias("of"), F.col("key").alias("of_key"), "spans", "items")
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(text_col).alias("key"), F.size(words_of(F.col(text_col))).cast("long").alias("n_words"))
    # both sides are narrow, and what a document holds has no bound, so this is no broadcast
    rows = rows.join(found, F.col("doc_id").eqNullSafe(F.col("of")) & (F.col("key") == F.col("of_key")), "left")
    items = F.coalesce("items", F.array().cast("array<string>"))
    n_hit = F.coalesce(_covered(F.col("spans")), F.lit(0)).cast("long")
    return rows.select("doc_id", "n_words", n_hit.alias("n_hit"), F.size(items).cast("long").alias("n_items"), F.sha2(F.array_join(items, ","), 256).alias("items_sha256"), F.col("items").isNotNull().alias("contaminated"), "spans")


def _joined(docs: DataFrame, found: DataFrame, id_col: str, text_col: str, how: str) -> DataFrame:
    """docs joined with found (doc_id, key and more). What is broadcast is counted: rows, and the elements of their arrays."""
    extra = F.size("spans") if "spans" in found.columns else F.lit(0)
    n = found.agg(F.sum(extra + 1)).first()[0] or 0
    found = found.select(F.col("doc_id").alias("__of"), F.col("key").alias("__key"), *(F.col(c).alias(f"__{c}") for c in found.columns if c not in ("doc_id", "key")))
    return docs.join(small(found, n), docs[id_col].cast("long").eqNullSafe(F.col("__of")) & (F.xxhash64(docs[text_col]) == F.col("__key")), how)


def remove_documents(docs: DataFrame, benchmark: DataFrame, *, width: int = 10, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of docs, all columns, that hold no window."""
    return _joined(docs, hits(docs, benchmark, width=width, id_col=id_col, text_col=text_col).select("doc_id", "key"), id_col, text_col, "left_anti")


def remove_spans(docs: DataFrame, benchmark: DataFrame, *, width: int = 10, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of docs, all columns, whose texts have lost the words that a window covers; what stands between words stays."""
    rows = _joined(docs, hits(docs, benchmark, width=width, id_col=id_col, text_col=text_col).select("doc_id", "key", "spans"), id_col, text_col, "left")
    word = SEPARATORS.replace("[", "[^", 1)
    pieces = F.regexp_extract_all(F.col(text_col), F.lit(f"{word}|{SEPARATORS}"), F.lit(0))
    lead = F.when(F.col(text_col).rlike(f"^{word}"), 0).otherwise(1)
    hit = lambda i: F.exists("__spans", lambda s: (s["start"] * 2 + lead <= i) & (i < s["end"] * 2 + lead - 1) & ((i - lead) % 2 == 0))
    text = F.when(F.col("__spans").isNull(), F.col(text_col)).otherwise(F.array_join(F.transform(pieces, lambda p, i: F.when(hit(i), F.lit("")).otherwise(p)), ""))
    return rows.withColumn(text_col, text).drop("__of", "__key", "__spans")
