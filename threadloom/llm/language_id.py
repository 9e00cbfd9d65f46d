"""Language identification by nearest centroids.

A text becomes counts of hashed byte n-grams (1 to 4 bytes of its lower-cased letters and what parts them), damped, weighted by inverse document
frequency and normalised. Each language has several centroids, found by spherical k-means; the nearest centroid by cosine names the language. A text
is rejected if its cosine is below a limit for its size, that is how many different n-grams it has (a word said a thousand times is a short text), or below a part of the limit for all of them. The limit is where nearly all noise of that size
is below, words of letters drawn by chance from many scripts and from the training texts; but never above what nearly all training texts and pieces of that size have, by a margin. Sizes
and languages with too few training texts take the limits of all languages together. Limits rise with the size.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import BATCH_ROWS, in_fold, map_batches

#: Buckets of the n-gram hash.
DIMS = 8192
GRAMS = (1, 2, 3, 4)
#: Bounds of the fit: labelled texts for each language at most and at least, in all, bytes of one and of all; centroids of a language. Every language is learned.
PER_LANGUAGE, FEWEST, SAMPLE, SAMPLE_BYTES, TOTAL_BYTES, CENTROIDS = 800, 8, 6000, 100_000, 64 << 20, 4
#: The share of noise of each kind that is rejected where texts allow it; the share of training texts that may be, and what part of their cosine is the most that a limit takes.
NOISE, LOW, MARGIN = 0.95, 0.01, 0.9
#: Texts or pieces that a limit of its own takes for a size; sizes (log2 of different n-grams); lengths (log2 of n-grams) of pieces and noise; pieces of all languages and noise of a kind for each length; the part of a limit that a
#: text of as many n-grams, different or not, must reach.
NEAR, SIZES, LENGTHS, PIECES, NOISES, REPEATED = 40, 14, range(3, 17), 400, 40, 0.3
#: First letters and how many, of the scripts that noise is drawn from, besides the letters of the training texts.
SCRIPTS = ((0x61, 26), (0xE0, 24), (0x430, 32), (0x3B1, 25), (0x5D0, 27), (0x627, 36), (0x905, 53), (0xE01, 46), (0xAC00, 2000), (0x3041, 83), (0x4E00, 4000))
#: Every ASCII byte that is no letter becomes a space.
_LETTERS = bytes(c if c >= 128 or 97 <= c <= 122 else 32 for c in range(256))
_PIECE = 1 << 20


def gram_counts(text: str) -> np.ndarray:
    """Counts of hashed n-grams of a whole text, worked on in pieces of bounded size."""
    data = np.frombuffer((" " + text.lower() + " ").encode().translate(_LETTERS), np.uint8).astype(np.uint32)
    out = np.zeros(DIMS, np.int64)
    for n in GRAMS:
        for at in range(0, len(data) - n + 1, _PIECE):
            part = data[at : at + _PIECE + n - 1]
            m = len(part) - n + 1
            code = part[:m].copy()
            for i in range(1, n):
                code |= part[i : i + m] << np.uint32(8 * i)
            code = code * np.uint32(0x9E3779B1) + np.uint32(n * 0x85EBCA6B & 0xFFFFFFFF)
            code ^= code >> np.uint32(15)
            out += np.bincount((code * np.uint32(0x2C1B3C6D)) >> np.uint32(32 - 13), minlength=DIMS)
    return out


def has_letter(text: str | None) -> bool:
    return bool(text) and any(map(str.isalpha, text))


@dataclass
class LanguageModel:
    languages: list[str]
    idf: np.ndarray
    centroids: np.ndarray  # a row each
    owner: np.ndarray  # language of each centroid
    least: np.ndarray  # least cosine allowed, by language and size

    def vectors(self, counts: np.ndarray) -> np.ndarray:
        out = np.log1p(counts).astype(np.float32) * self.idf
        return out / np.maximum(np.linalg.norm(out, axis=-1, keepdims=True), 1e-9)

    def predict(self, texts: list[str | None]) -> list[tuple[str, float, bool]]:
        """(language, score, rejected) of each text; ("und", 0.0, True) for null and without a letter."""
        out: list[tuple[str, float, bool]] = [("und", 0.0, True)] * len(texts)
        here = [i for i, t in enumerate(texts) if has_letter(t)] if self.languages else []
        for first in range(0, len(here), 64):
            some = here[first : first + 64]
            counts = np.stack([gram_counts(texts[i]) for i in some])
            cosines = self.vectors(counts) @ self.centroids.T
            best = np.full((len(some), len(self.languages)), -1.0)
            for j, language in enumerate(self.owner):
                best[:, language] = np.maximum(best[:, language], cosines[:, j])
            size, length = _sizes(counts), np.log2(counts.sum(axis=1) + 1).astype(int).clip(0, SIZES - 1)
            for row, i in enumerate(some):
                order = np.argsort(-best[row], kind="stable")
                top, second = best[row, order[0]], best[row, order[1]] if len(order) > 1 else 0.0
                score = float(np.clip(max(top, 0) / max(max(top, 0) + max(second, 0), 1e-9), 0, 1))
                limits = self.least[order[0]]
                out[i] = (self.languages[order[0]], score, bool(top < max(limits[size[row]], REPEATED * limits[length[row]])))
        return out


def _sizes(counts: np.ndarray) -> np.ndarray:
    """log2 of a text's different n-grams."""
    return np.log2(np.count_nonzero(counts, axis=-1) + 1).astype(int).clip(0, SIZES - 1)


def _centroids(vectors: np.ndarray, k: int, rounds: int = 12) -> np.ndarray:
    """Spherical k-means from the farthest-first start; without chance."""
    chosen = [int(np.argmax(vectors @ vectors.mean(axis=0)))]
    near = vectors @ vectors[chosen[0]]
    while len(chosen) < min(k, len(vectors)):
        chosen.append(int(np.argmin(near)))
        near = np.maximum(near, vectors @ vectors[chosen[-1]])
    centres = vectors[chosen]
    for _ in range(rounds):
        at = np.argmax(vectors @ centres.T, axis=1)
        sums = np.stack([vectors[at == j].sum(axis=0) if (at == j).any() else centres[j] for j in range(len(centres))])
        centres = sums / np.maximum(np.linalg.norm(sums, axis=1, keepdims=True), 1e-9)
    return centres


def fit(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> LanguageModel:
    """Learns from text and lang of the rows outside the held-out fold, lang not null. Document frequencies come from all of them; centroids from a sample of
    at most PER_LANGUAGE texts of a language and SAMPLE in all (but FEWEST of each), of at most SAMPLE_BYTES each and about TOTAL_BYTES in all, chosen by a hash. All languages are learned, with
    128 KB each in the model, but for one whose texts are all longer than SAMPLE_BYTES."""
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"), F.col(lang_col).cast("string").alias("lang"))
    rows = rows.where(~in_fold(F.col("doc_id")) & F.col("lang").isNotNull() & F.col("text").isNotNull())
    fits = F.octet_length("text") <= SAMPLE_BYTES
    sums = rows.groupBy("lang").agg(F.count("*").alias("n"), F.coalesce(F.avg(F.when(fits, F.octet_length("text"))), F.lit(0.0)).alias("bytes"))
    found = {r.lang: r for r in sums.collect()}  # a row for each language
    counts = {k: r.n for k, r in found.items()}
    languages = sorted(counts)
    if not languages:
        return LanguageModel([], np.ones(DIMS, np.float32), np.zeros((0, DIMS), np.float32), np.zeros(0, int), np.zeros((0, SIZES)))

    def present(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, seen = 0, np.zeros(DIMS, np.int64)
        for batch in batches:
            for text in batch.column(0).to_pylist():
                seen += gram_counts(text) > 0
                n += 1
        if n:
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(DIMS + 1)), pa.array(np.append(seen, n))], ["dim", "n"])

    docs.sparkSession.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)
    frequency = np.zeros(DIMS + 1)
    for r in rows.select("text").mapInArrow(present, "dim long, n long").groupBy("dim").agg(F.sum("n").alias("n")).collect():
        frequency[r.dim] = r.n
    idf = np.log((1 + frequency[-1]) / (1 + frequency[:-1])).astype(np.float32) + 0.05

    each = max(FEWEST, min(PER_LANGUAGE, SAMPLE // len(languages)))
    draw = F.pmod(F.xxhash64(F.lit(7), "doc_id", "text"), F.lit(1 << 30)) / F.lit(float(1 << 30))
    most = {k: max(FEWEST, min(each, int(TOTAL_BYTES / len(languages) / max(r.bytes, 1)))) for k, r in found.items()}
    share = F.try_element_at(F.create_map(*(x for k, n in counts.items() for x in (F.lit(k), F.lit(1.5 * most[k] / n + 20 / n)))), F.col("lang"))
    some = rows.where((draw < share) & fits).select("lang", draw.alias("draw"), "text").toPandas()
    model = LanguageModel(languages, idf, np.zeros((0, DIMS), np.float32), np.zeros(0, int), np.zeros((len(languages), SIZES)))
    centres, owner, samples = [], [], {}
    for i, language in enumerate(languages):
        texts = [t for t in some[some.lang == language].sort_values(["draw", "text"]).text[: most[language]] if has_letter(t)]
        if not texts:
            continue
        mine = _centroids(model.vectors(np.stack([gram_counts(t) for t in texts])), CENTROIDS)
        centres.append(mine)
        owner += [i] * len(mine)
        samples[i] = texts
    model.centroids, model.owner = np.concatenate(centres) if centres else model.centroids, np.array(owner, int)
    if not centres:
        model.languages = []
        return model
    model.least = _limits(model, samples)
    return model


def _cosines(model: LanguageModel, texts: list[str], centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sizes and nearest cosines."""
    sizes, cosines = [np.zeros(0, int)], [np.zeros(0)]
    for first in range(0, len(texts), 64):
        counts = np.stack([gram_counts(t) for t in texts[first : first + 64]])
        sizes.append(_sizes(counts))
        cosines.append((model.vectors(counts) @ centroids.T).max(axis=1))
    return np.concatenate(sizes), np.concatenate(cosines)


def _limits(model: LanguageModel, samples: dict[int, list[str]]) -> np.ndarray:
    """The least cosine by language and size."""
    each = max(NEAR // len(LENGTHS) + 1, PIECES // len(samples))
    allowed, whole = {}, [[] for _ in range(SIZES)]
    for i, texts in samples.items():
        pieces = [p for s in LENGTHS for p in (_piece(t, s, k) for k, t in enumerate((texts * each)[:each])) if has_letter(p)]
        sizes, cosines = _cosines(model, texts + pieces, model.centroids[model.owner == i])
        own = [cosines[sizes == s] for s in range(SIZES)]
        allowed[i] = np.array([MARGIN * np.quantile(c, LOW) if len(c) >= NEAR else np.nan for c in own])
        for s in range(SIZES):
            whole[s].append(own[s])
    whole = [np.concatenate(c) for c in whole]
    common = np.array([MARGIN * np.quantile(c, LOW) if len(c) >= NEAR else np.nan for c in whole])
    noise = _noise_limits(model, sorted({c for texts in samples.values() for t in texts for c in t.lower() if c.isalpha()}))
    out = np.zeros((len(model.languages), SIZES))
    for i, own in allowed.items():
        own = np.where(np.isnan(own), common, own)
        for s in range(1, SIZES):  # sizes without texts take what the one below them allows
            own[s] = own[s - 1] if np.isnan(own[s]) else own[s]
        # a limit is never above what any larger size allows, so that it rises
        own = np.minimum.accumulate(np.nan_to_num(own)[::-1])[::-1]
        out[i] = np.minimum(own, noise)
    return out


def _noise_limits(model: LanguageModel, letters: list[str]) -> np.ndarray:
    """By size the cosine that NOISE of the words drawn from each script stay below."""
    rng = np.random.default_rng(7)
    scripts = [[chr(first + i) for i in range(n) if chr(first + i).isalpha()] for first, n in SCRIPTS] + [letters]
    found = np.zeros((len(scripts), SIZES))
    for k, script in enumerate(scripts):
        texts = []
        for length in LENGTHS:
            want = int(2 ** (length + 0.5) / len(GRAMS) / max(1, len("".join(script[:50]).encode()) / min(50, len(script))))
            for _ in range(NOISES if length < 13 else NOISES // 4):
                drawn = rng.integers(0, len(script), max(want, 2))
                ends = set(np.cumsum(rng.integers(2, 10, len(drawn))).tolist())
                texts.append("".join(script[c] + (" " if at in ends else "") for at, c in enumerate(drawn)))
        sizes, cosines = _cosines(model, texts, model.centroids)
        found[k] = [np.quantile(cosines[sizes == s], NOISE) if (sizes == s).sum() >= 8 else 0.0 for s in range(SIZES)]
    return np.maximum.accumulate(found.max(axis=0))


def _piece(text: str, size: int, k: int) -> str:
    """A piece of a text with some 2 ** (size + 0.5) n-grams, from a word's beginning; the k-th place of it, spread over the text."""
    want = int(2 ** (size + 0.5) / len(GRAMS))
    at = k * 7919 % max(len(text) - want, 1)
    at = text.find(" ", at) + 1 if at else 0
    return text[at : at + want]


def predictor(docs: DataFrame, model: LanguageModel):
    """A column function: text -> struct(lang_pred, score, rejected)."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    docs.sparkSession.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)

    @F.pandas_udf("struct<lang_pred:string,score:double,rejected:boolean>")
    def predict(texts: pd.Series) -> pd.DataFrame:
        return pd.DataFrame(shared.value.predict([t if isinstance(t, str) else None for t in texts]), columns=["lang_pred", "score", "rejected"])

    return predict


def language_id(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """doc_id, held_out, lang_pred, score, rejected for each row of docs.

    A null text or one without a letter is `und` with score 0 and rejected; so is every text if nothing can be learned. A null id is
    held out. Ties go to the language that sorts first. Repeated rows are predicted each; an empty table gives no rows. Other columns are not read.
    """
    model = fit(docs, id_col=id_col, text_col=text_col, lang_col=lang_col)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = shared.value.predict(batch.column(2).to_pylist())
        columns = [pa.array(c, kind) for c, kind in zip(zip(*found), (pa.string(), pa.float64(), pa.bool_()))]
        return pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *columns], ["doc_id", "held_out", "lang_pred", "score", "rejected"])

    doc_id = F.col(id_col).cast("long")
    return map_batches(docs.select(doc_id.alias("doc_id"), in_fold(doc_id).alias("held_out"), F.col(text_col).alias("text")), work, "doc_id long, held_out boolean, lang_pred string, score double, rejected boolean")


def accepted(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """The rows of docs, all columns, whose language is not rejected."""
    predict = predictor(docs, fit(docs, id_col=id_col, text_col=text_col, lang_col=lang_col))
    rejected: Column = predict(docs[text_col])["rejected"]
    return docs.where(~rejected)
