"""Toxicity: FTRL-proximal logistic regression over hashed word n-grams and skip-grams.

Features of a text are the presence of its lower-cased words and their beginnings of ``STEMS`` letters (inflected insults share
one), of pairs of neighbouring words and of pairs with one word between, hashed into ``2**BITS`` coordinates. Every coordinate
has a learning rate of its own; the L1 penalty keeps a coordinate at zero until its gradients add up to more, so the
fitted model is a short list of coordinates and weights, which is what tasks get.

Learning uses at most ``FIT_ROWS`` labelled documents: those of the smallest hashes of the id and then of the text, equal texts of equal label
once, in one task. The ids are chosen from the labels alone, so documents are not shuffled. Scoring covers all rows and
whole texts, piece by piece; presence is counted once per text, so a long text is not more toxic for its length.

Null, empty and wordless texts have no feature but the bias. Rows without a label are scored but never learned from; where
an id has several labels or rows, each counts once. Without any row to learn from, every score is one half. Equal texts get
equal scores; empty tables give empty results; extra columns are dropped.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from veldtab.llm.common import id_bucket, map_batches, table
from veldtab.llm.quality import sampled

BITS = 22
STEMS = (4, 6)
FIT_ROWS = 16_000
EPOCHS = 6
ALPHA, BETA, L1, L2 = 1.0, 1.0, 5.0, 0.1
LEAST_SCORE = 0.3
#: Words taken at once, and words whose hashes a task remembers.
PIECE, REMEMBERED = 1 << 16, 1 << 20
_WORD = re.compile(r"\w+")
_STEP = np.uint64(0x9E3779B97F4A7C15)
_PAIR, _SKIP = np.uint64(0xC2B2AE3D27D4EB4F), np.uint64(0x165667B19E3779F9)


class Hashes:
    """Hashes of words and of their beginnings, remembered within a task."""

    def __init__(self):
        self.known: dict[str, bytes] = {}

    def of(self, words: list[str]) -> np.ndarray:
        """One row of unsigned hashes per word: the word, then each beginning."""
        if len(self.known) > REMEMBERED:
            self.known.clear()
        known = self.known
        for word in set(words).difference(known):
            forms = [word, *[f"{k}\x00{word[:k]}" for k in STEMS]]
            known[word] = b"".join(xxhash.xxh64_digest(f.encode("utf-8", "replace"))[::-1] for f in forms)
        return np.frombuffer(b"".join(map(known.__getitem__, words)), "<u8").reshape(-1, 1 + len(STEMS))


def _pieces(text: str) -> Iterator[list[str]]:
    """Words of the lower-cased text, ``PIECE`` at a time, each piece led by the last two words of the one before."""
    text = text.lower()
    if len(text) <= PIECE:
        yield _WORD.findall(text)
        return
    words = (m[0] for m in _WORD.finditer(text))
    lead: list[str] = []
    while part := list(islice(words, PIECE)):
        yield lead + part
        lead = (lead + part)[-2:]


def coordinates(text: str | None, hashes: Hashes) -> Iterator[np.ndarray]:
    """Hashed features of a text; a feature can come more than once."""
    shift = np.uint64(64 - BITS)
    for words in _pieces(text or ""):
        if not words:
            continue
        h = hashes.of(words)
        one = h[:, 0]
        parts = [h.ravel(), one[:-1] * _PAIR + one[1:], one[:-2] * _SKIP + one[2:]]
        yield ((np.concatenate(parts) * _STEP) >> shift).astype(np.int64)


def features(text: str | None, hashes: Hashes) -> np.ndarray:
    """The distinct features of a text."""
    parts = [np.unique(c) for c in coordinates(text, hashes)]
    return np.unique(np.concatenate(parts)).astype(np.int32) if parts else np.empty(0, np.int32)


class Proximal:
    """State of follow-the-regularised-leader: sums of adjusted and of squared gradients per coordinate."""

    def __init__(self):
        self.z = np.zeros(1 << BITS)
        self.n = np.zeros(1 << BITS)
        self.bias, self.bias_n = 0.0, 1.0

    def weights(self, at) -> np.ndarray:
        z = self.z[at]
        return np.where(np.abs(z) <= L1, 0.0, (np.sign(z) * L1 - z) / ((BETA + np.sqrt(self.n[at])) / ALPHA + L2))

    def learn(self, at: np.ndarray, label: float) -> None:
        w = self.weights(at)
        g = sigmoid(self.bias + float(w.sum())) - label
        n = self.n[at]
        self.z[at] += g - (np.sqrt(n + g * g) - np.sqrt(n)) / ALPHA * w
        self.n[at] = n + g * g
        self.bias_n += g * g
        self.bias -= ALPHA * g / math.sqrt(self.bias_n)


def sigmoid(x: float) -> float:
    return 1 / (1 + math.exp(-max(-30.0, min(30.0, x))))


class ToxicityModel:
    """The coordinates whose weight is not zero, their weights, and the bias."""

    def __init__(self, at: np.ndarray, weight: np.ndarray, bias: float):
        self.at, self.weight, self.bias = at, weight, bias

    def dense(self) -> np.ndarray:
        out = np.zeros(1 << BITS, np.float32)
        out[self.at] = self.weight
        return out


def score(text: str | None, dense: np.ndarray, bias: float, hashes: Hashes) -> float:
    """Probability of label 1; only features with a weight are looked at twice."""
    hits = [c[dense[c] != 0] for c in coordinates(text, hashes)]
    hits = np.unique(np.concatenate(hits)) if hits else np.empty(0, np.int64)
    return sigmoid(bias + float(dense[hits].sum(dtype=np.float64)))


def fit_toxicity(docs: DataFrame, labels: DataFrame, training: Column, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", fit_rows: int = FIT_ROWS) -> ToxicityModel:
    """Learn from the labelled rows whose id meets ``training``, a condition on a column ``doc_id``."""
    known = labels.select(F.col(id_col).alias("doc_id"), (F.col(label_col) > 0).cast("string").alias("label")).dropna().where(training)
    chosen = sampled(known.select(F.col("doc_id").cast("string").alias("key"), "label"), fit_rows, "key", "label").select("key", "label")
    # at most fit_rows rows of an id and a label, so they can be sent to every task
    rows = docs.select(F.col(id_col).cast("string").alias("key"), F.col(text_col).alias("text")).join(F.broadcast(chosen), "key")
    some = sampled(rows, fit_rows, "text", "label").select("text", F.expr("int(label = 'true')"), "hash").repartition(1).sortWithinPartitions("hash")

    def train(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, data = Hashes(), []
        for batch in batches:
            data += [(features(t, hashes), y) for t, y in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())]
        if not data:
            return
        leader = Proximal()
        share = (sum(y for _, y in data) + 0.5) / (len(data) + 1)
        leader.bias = math.log(share / (1 - share))
        for epoch in range(EPOCHS):
            for i in np.random.default_rng(epoch).permutation(len(data)):
                leader.learn(*data[i])
        weight = leader.weights(slice(None))
        used = np.flatnonzero(weight)
        yield pa.RecordBatch.from_arrays([pa.array(np.append(used, -1)), pa.array(np.append(weight[used], leader.bias))], ["at", "weight"])

    fitted = some.mapInArrow(train, "at long, weight double").toArrow()
    at, weight = fitted.column(0).to_numpy(), fitted.column(1).to_numpy()
    used = at >= 0
    return ToxicityModel(at[used], weight[used], float(weight[~used][0]) if len(at) else 0.0)


def score_toxicity(docs: DataFrame, model: ToxicityModel, id_col: str = "doc_id", text_col: str = "text", least: float = LEAST_SCORE) -> DataFrame:
    """(doc_id, score, predicted) per row: predicted is 1 from a score of ``least`` on."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def prepare() -> tuple:
        return shared.value.dense(), shared.value.bias, Hashes()

    def run(batch: pa.RecordBatch, state: tuple) -> dict:
        return {"doc_id": batch.column(0), "score": [score(t, *state) for t in batch.column(1).to_pylist()]}

    source = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    scored = map_batches(source, f"doc_id {source.schema['doc_id'].dataType.simpleString()}, score double", run, prepare)
    return scored.withColumn("predicted", (F.col("score") >= least).cast("int"))


def op13_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = F.coalesce(id_bucket(F.col("doc_id"), 4) == 2, F.lit(False))
    model = fit_toxicity(docs, table(spark, sf_dir, "labels"), ~held_out)
    return score_toxicity(docs, model).select("doc_id", held_out.alias("held_out"), "score", "predicted")
