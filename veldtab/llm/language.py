"""Language identification: multinomial logistic regression on TF-IDF of hashed character n-grams.

Document frequencies of the n-grams come from all training rows. Weights are learned by follow-the-regularised-leader with
L1 and L2 penalties on a bounded sample of training rows (``FIT_ROWS`` different ones at most, those of the smallest hashes), in one task; a fifth of
the sample is held back to fit the temperature that calibrates the probabilities. The model has a fixed size: ``2**BITS`` weights
per language. Scoring adds up weights over the positions of a text, piece by piece, so long texts need no more memory.

Null texts and texts without a letter are ``und`` with score 0, and so is every text where there is no training row. Rows
without a language are scored but never learned from. Ties go to the language first in alphabetical order. Repeated rows
get equal answers. Empty tables give empty results; extra columns are dropped.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from veldtab.llm.common import id_bucket, map_batches, table
from veldtab.llm.quality import sampled

ORDERS = (1, 2, 3)
BITS = 16
FIT_ROWS = 8_000
EPOCHS = 2
ALPHA, BETA, L1, L2 = 0.5, 1.0, 0.05, 0.05
#: Term frequencies are shares of a text's n-grams times this.
SCALE = 100.0
PIECE = 1 << 20
UNKNOWN = "und"


def _hashes(text: str) -> Iterator[np.ndarray]:
    """Hashed n-grams of the lower-cased text between two spaces, a piece of the text at a time."""
    codes = np.frombuffer(f" {text.lower()} ".encode("utf-32-le", "replace"), np.uint32).astype(np.uint64)
    longest = max(ORDERS)
    for at in range(0, len(codes), PIECE):
        part = codes[at:at + PIECE + longest - 1]
        mine = min(PIECE, len(codes) - at)
        key = np.zeros(len(part), np.uint64)
        for order in range(1, longest + 1):
            n = len(part) - order + 1
            if n <= 0:
                break
            key = key[:n] * np.uint64(0x100000001B3) + part[order - 1:order - 1 + n] + np.uint64(order)
            if order in ORDERS:
                yield ((key[:mine] * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - BITS)).astype(np.int64)


def has_letter(text: str | None) -> bool:
    return any(map(str.isalpha, text or ""))


def term_shares(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Distinct features of a text and their shares of all its n-grams."""
    counts = np.zeros(1 << BITS, np.int64)
    for h in _hashes(text):
        counts += np.bincount(h, minlength=1 << BITS)
    at = np.flatnonzero(counts)
    return at, counts[at] * (SCALE / counts[at].sum())


def document_frequencies(texts: DataFrame) -> np.ndarray:
    """Rows that hold each feature, and as a last entry all rows with a letter; ``texts`` has one column."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((1 << BITS) + 1, np.int64)
        for batch in batches:
            for text in batch.column(0).to_pylist():
                if has_letter(text):
                    seen = np.zeros(len(total), bool)
                    for h in _hashes(text):
                        seen[h] = True
                    seen[-1] = True
                    total += seen
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], ["at", "n"])

    out = np.zeros((1 << BITS) + 1, np.int64)
    for row in texts.mapInArrow(run, "at long, n long").groupBy("at").agg(F.sum("n").alias("n")).collect():
        out[row["at"]] = row["n"]
    return out


def inverse(frequencies: np.ndarray) -> np.ndarray:
    return np.log((1 + frequencies[-1]) / (1 + frequencies[:-1])) + 1


class Leader:
    """Follow-the-regularised-leader state of a multinomial logistic regression."""

    def __init__(self, classes: int):
        self.z = np.zeros((1 << BITS, classes))
        self.n = np.zeros((1 << BITS, classes))
        self.bias = np.zeros(classes)
        self.bias_n = np.full(classes, 1.0)

    def weights(self, at=slice(None)) -> np.ndarray:
        z, n = self.z[at], self.n[at]
        return np.where(np.abs(z) <= L1, 0.0, -(z - np.sign(z) * L1) / ((BETA + np.sqrt(n)) / ALPHA + L2))

    def learn(self, at: np.ndarray, value: np.ndarray, label: int) -> None:
        w = self.weights(at)
        p = softmax(value @ w + self.bias)
        p[label] -= 1.0
        g = value[:, None] * p[None, :]
        n = self.n[at]
        self.z[at] += g - (np.sqrt(n + g * g) - np.sqrt(n)) / ALPHA * w
        self.n[at] = n + g * g
        self.bias_n += p * p
        self.bias -= 0.1 * p / np.sqrt(self.bias_n)


def softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


def fit_temperature(logits: np.ndarray, labels: np.ndarray) -> float:
    """The divisor of the logits with the least log-loss, by golden section over its logarithm."""
    def loss(log_t: float) -> float:
        x = logits / math.exp(log_t)
        top = x.max(axis=1)
        return float((np.log(np.exp(x - top[:, None]).sum(axis=1)) + top - x[np.arange(len(labels)), labels]).mean())

    low, high, ratio = math.log(0.05), math.log(200.0), (math.sqrt(5) - 1) / 2
    for _ in range(60):
        a, b = high - ratio * (high - low), low + ratio * (high - low)
        low, high = (low, b) if loss(a) < loss(b) else (a, high)
    return math.exp((low + high) / 2)


class LanguageModel:
    """Languages, weights with the inverse document frequencies multiplied in, biases and temperature."""

    def __init__(self, languages: list[str], weights: np.ndarray, bias: np.ndarray, temperature: float):
        self.languages, self.weights, self.bias, self.temperature = languages, weights, bias, temperature

    def logits(self, text: str) -> np.ndarray:
        total, n = np.zeros(len(self.languages)), 0
        for h in _hashes(text):
            total += np.bincount(h, minlength=1 << BITS) @ self.weights if len(h) > 1 << BITS else np.take(self.weights, h, axis=0).sum(axis=0)
            n += len(h)
        return total * (SCALE / max(1, n)) + self.bias

    def predict(self, text: str | None) -> tuple[str, float]:
        if not self.languages or not has_letter(text):
            return UNKNOWN, 0.0
        p = softmax(self.logits(text) / self.temperature)
        best = int(p.argmax())
        return self.languages[best], float(p[best])


def fit_language(docs: DataFrame, training: Column, text_col: str = "text", lang_col: str = "lang", fit_rows: int = FIT_ROWS) -> LanguageModel:
    """Learn from the rows of ``docs`` that meet ``training`` and have a language."""
    rows = docs.where(training & F.col(lang_col).isNotNull()).select(F.col(text_col).alias("text"), F.col(lang_col).cast("string").alias("lang"))
    frequencies = document_frequencies(rows.select("text"))
    weight = inverse(frequencies)
    some = sampled(rows, fit_rows, "text", "lang").select("text", "lang")

    def train(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        data = [(*term_shares(text), lang) for batch in batches for text, lang in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()) if has_letter(text)]
        if not data:
            return
        data.sort(key=lambda d: (len(d[0]), d[2], float(d[1][0]), int(d[0][0]), int(d[0][-1])))
        order = np.random.default_rng(0).permutation(len(data))
        languages = sorted({d[2] for d in data})
        label = {lang: i for i, lang in enumerate(languages)}
        held = max(1, len(data) // 5) if len(data) > 20 else 0
        leader = Leader(len(languages))
        for epoch in range(EPOCHS):
            for i in order[held:]:
                at, value, lang = data[i]
                leader.learn(at, value * weight[at], label[lang])
        w = leader.weights()
        logits = np.array([(value * weight[at]) @ w[at] + leader.bias for at, value, _ in (data[i] for i in order[:held])])
        temperature = fit_temperature(logits, np.array([label[data[i][2]] for i in order[:held]])) if held else 1.0
        w *= weight[:, None]
        used = np.flatnonzero(w.any(axis=1))
        ends = np.arange(len(used) + 1, dtype=np.int32) * len(languages)
        packed = pa.ListArray.from_arrays(pa.array(ends), pa.array(w[used].ravel()))
        yield pa.RecordBatch.from_arrays([pa.array(used), packed, pa.array([""] * len(used))], ["at", "weights", "languages"])
        last = [[-1], [[*leader.bias.tolist(), temperature]], ["\n".join(languages)]]
        yield pa.RecordBatch.from_arrays([pa.array(last[0], pa.int64()), pa.array(last[1], pa.list_(pa.float64())), pa.array(last[2])], ["at", "weights", "languages"])

    fitted = some.repartition(1).mapInArrow(train, "at long, weights array<double>, languages string").collect()
    head = next((r for r in fitted if r["at"] == -1), None)
    if head is None:
        return LanguageModel([], np.zeros((1 << BITS, 0)), np.zeros(0), 1.0)
    languages = head["languages"].split("\n")
    weights = np.zeros((1 << BITS, len(languages)))
    for r in fitted:
        if r["at"] >= 0:
            weights[r["at"]] = r["weights"]
    return LanguageModel(languages, weights, np.array(head["weights"][:-1]), head["weights"][-1])


def identify(docs: DataFrame, model: LanguageModel, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, lang_pred, score) per row."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batch: pa.RecordBatch, m: LanguageModel) -> dict:
        found = [m.predict(t) for t in batch.column(1).to_pylist()]
        return {"doc_id": batch.column(0), "lang_pred": [f[0] for f in found], "score": [f[1] for f in found]}

    source = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    return map_batches(source, f"doc_id {source.schema['doc_id'].dataType.simpleString()}, lang_pred string, score double", run, lambda: shared.value)


def op7_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = F.coalesce(id_bucket(F.col("doc_id"), 3) == 1, F.lit(False))
    model = fit_language(docs, ~held_out)
    return identify(docs, model).select("doc_id", held_out.alias("held_out"), "lang_pred", "score")
