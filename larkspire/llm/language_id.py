"""Language identification: sparse multinomial logistic regression on TF-IDF character n-grams.

Document frequencies are counted over all training documents. The weights are fitted with the follow-the-regularised-leader
rule (per-coordinate rates, elastic-net penalty) on a bounded sample of them, and a temperature fitted on a part of that
sample kept apart calibrates the probabilities.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larkspire.llm.common import held_out, map_arrow, map_chunks
from larkspire.llm.sampling import stratified

BUCKETS = 1 << 15
ORDERS = (1, 2, 3)
#: Training documents taken of each language, at most about so many.
SAMPLE_PER_LANGUAGE = 800
UNKNOWN = "und"


def has_letter(text: str | None) -> bool:
    return bool(text) and any(map(str.isalpha, text))


def ngram_counts(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of the text's character n-grams, and how often each occurs."""
    codes = np.frombuffer(text.lower().encode("utf-32-le", "replace"), np.uint32)
    found, value = [], None
    for order in range(1, max(ORDERS) + 1):
        if len(codes) < order:
            break
        value = codes + np.uint32(order) if value is None else value[:-1] * np.uint32(0x9E3779B1) + codes[order - 1 :]
        if order in ORDERS:
            found.append((value * np.uint32(0x85EBCA6B)) >> np.uint32(17))
    counts = np.bincount(np.concatenate(found), minlength=BUCKETS)
    at = np.flatnonzero(counts)
    return at, counts[at]


def features(at: np.ndarray, counts: np.ndarray, idf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The text's TF-IDF vector, of length 1, from its ngram_counts()."""
    values = (1 + np.log(counts)) * idf[at]
    norm = np.sqrt(values @ values)
    return at, values / norm if norm else values


def fit_ftrl(rows: list, labels: np.ndarray, classes: int, epochs: int = 3, alpha: float = 0.5, beta: float = 1.0, l1: float = 0.02, l2: float = 0.02) -> np.ndarray:
    """Weights (buckets, classes). w = 0 where |z| <= l1, else -(z - sign(z) l1) / ((beta + sqrt(n)) / alpha + l2)."""
    z, n = np.zeros((BUCKETS, classes)), np.zeros((BUCKETS, classes))

    def weights(zs, ns):
        return np.where(np.abs(zs) <= l1, 0.0, -(zs - np.sign(zs) * l1) / ((beta + np.sqrt(ns)) / alpha + l2))

    random = np.random.default_rng(7)
    for _ in range(epochs):
        for i in random.permutation(len(rows)):
            at, x = rows[i]
            zs, ns = z[at], n[at]
            w = weights(zs, ns)
            p = np.exp((s := x @ w) - s.max())
            p /= p.sum()
            p[labels[i]] -= 1
            g = x[:, None] * p[None, :]
            g2 = g * g
            z[at] = zs + g - (np.sqrt(ns + g2) - np.sqrt(ns)) / alpha * w
            n[at] = ns + g2
    return weights(z, n)


def fit_temperature(scores: np.ndarray, labels: np.ndarray) -> float:
    """The temperature with the least cross-entropy on scores that the weights weren't fitted on."""
    if not len(labels):
        return 1.0

    def loss(t: float) -> float:
        s = scores / t
        s = s - s.max(1, keepdims=True)
        return float(np.mean(np.log(np.exp(s).sum(1)) - s[np.arange(len(labels)), labels]))

    return float(min(np.geomspace(0.02, 10, 120), key=loss))


@dataclass
class LanguageModel:
    languages: list[str]
    idf: np.ndarray
    weights: np.ndarray
    temperature: float

    def predict(self, text: str | None) -> tuple[str, float]:
        """The language and its calibrated probability; `und` and 0 for a text without a letter, or without a model."""
        if not self.languages or not has_letter(text):
            return UNKNOWN, 0.0
        at, x = features(*ngram_counts(text), self.idf)
        s = (x @ self.weights[at]) / self.temperature
        p = np.exp(s - s.max())
        best = int(p.argmax())
        return self.languages[best], float(p[best] / p.sum())


def document_frequencies(docs: DataFrame) -> tuple[np.ndarray, int]:
    """Over all rows of docs (text): the documents that hold each bucket, and the number of documents with text."""

    def run(batches):
        total, n = np.zeros(BUCKETS, np.int64), 0
        for batch in batches:
            for text in batch.column(0).to_pylist():
                if text:
                    total[ngram_counts(text)[0]] += 1
                    n += 1
        at = np.flatnonzero(total)
        yield pa.record_batch([pa.array(np.append(at, -1).astype(np.int32)), pa.array(np.append(total[at], n))], names=["bucket", "n"])

    out, n = np.zeros(BUCKETS, np.int64), 0
    for r in map_arrow(docs, run, "bucket int, n bigint").groupBy("bucket").agg(F.sum("n").alias("n")).collect():  # one row for each bucket
        if r["bucket"] < 0:
            n = r["n"]
        else:
            out[r["bucket"]] = r["n"]
    return out, n


def sampled_counts(docs: DataFrame) -> list[tuple]:
    """(doc_id, lang, buckets, counts) of the sampled documents with a letter: at most BUCKETS counts each, not their texts."""

    def run(t: pa.RecordBatch) -> pa.RecordBatch:
        texts = t.column(2).to_pylist()
        rows = [i for i, x in enumerate(texts) if has_letter(x)]
        made = [ngram_counts(texts[i]) for i in rows]
        more = [pa.array([m[k].tolist() for m in made], pa.list_(pa.int32())) for k in (0, 1)]
        return pa.record_batch([*(t.column(k).take(pa.array(rows, pa.int64())) for k in (0, 1)), *more], names=["doc_id", "lang", "at", "counts"])

    schema = f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, lang string, at array<int>, counts array<int>"
    rows = map_chunks(docs.select("doc_id", F.col("lang").cast("string").alias("lang"), F.col("text").cast("string").alias("text")), run, schema).collect()
    return sorted((r["doc_id"], r["lang"], r["at"], r["counts"]) for r in rows)


def train(docs: DataFrame, per_language: int = SAMPLE_PER_LANGUAGE) -> LanguageModel:
    """Fit on docs (doc_id, text, lang), all of which are training rows. Every lang is learned, for 0.26 MB of weights each."""
    docs = docs.where(F.col("lang").isNotNull())
    frequency, n = document_frequencies(docs.select("text"))
    idf = np.log((1 + n) / (1 + frequency)) + 1
    chosen, counts = stratified(docs, "lang", "doc_id", per_language)
    languages = sorted(counts)
    ids = chosen.select("doc_id").distinct()
    rows = sampled_counts(docs.join(F.broadcast(ids), "doc_id", "left_semi")) if languages else []
    if not rows:
        return LanguageModel([], idf, np.zeros((BUCKETS, 1)), 1.0)
    number = {x: i for i, x in enumerate(languages)}
    labels = np.array([number[lang] for _, lang, _, _ in rows])
    made = [features(np.array(at, np.int64), np.array(n), idf) for _, _, at, n in rows]
    apart = np.arange(len(rows)) % 5 == 4
    apart &= np.isin(labels, labels[~apart])  # a language with all its rows there would not be learned
    weights = fit_ftrl([m for m, a in zip(made, apart) if not a], labels[~apart], len(languages))
    scores = np.array([x @ weights[at] for (at, x), a in zip(made, apart) if a]).reshape(-1, len(languages))
    return LanguageModel(languages, idf, weights, fit_temperature(scores, labels[apart]))


def identify(docs: DataFrame, model: LanguageModel) -> DataFrame:
    """One row per input row of docs (doc_id, text): doc_id, lang_pred, score.

    A null text, or one without a letter, is `und` with score 0, as is everything if there was nothing to learn from.
    Equal texts get equal results. An empty table gives an empty result. Other columns are not read.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)  # BUCKETS * (languages + 1) doubles

    def run(t: pa.RecordBatch) -> pa.RecordBatch:
        rows = [shared.value.predict(x) for x in t.column(1).to_pylist()]
        return pa.record_batch([t.column(0), pa.array([r[0] for r in rows], pa.string()), pa.array([r[1] for r in rows], pa.float64())], names=["doc_id", "lang_pred", "score"])

    return map_chunks(docs.select("doc_id", "text"), run, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, lang_pred string, score double")


def identify_held_out(docs: DataFrame, per_language: int = SAMPLE_PER_LANGUAGE) -> DataFrame:
    """Train on the rows of docs that aren't held out, and predict all: doc_id, held_out, lang_pred, score."""
    model = train(docs.where(~held_out(F.col("doc_id"))).select("doc_id", "text", "lang"), per_language)
    return identify(docs, model).select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")
