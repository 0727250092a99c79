"""Quality classifier from weak labels.

1. Overlapping heuristic labellers vote on every document: 1 for sound, -1 for junk, 0 for no opinion.
2. Expectation-maximisation over the counts of vote patterns (at most 3 to the power of the labellers, over all rows)
   estimates how often each labeller gives each vote in either class, and so the posterior of every pattern.
3. Posteriors label a bounded sample of texts (``fit_rows`` at most: those of the smallest hashes; equal texts count once, so
   no text can fill the sample or outweigh the others), on which a linear scorer over hashed words, word shapes and repeats is fitted by AdaGrad in one task. Its ``2**BITS`` weights score all rows.

Nulls and empty texts get no vote but the labeller's for emptiness (junk) and are judged like any other row.
Repeated rows get equal scores. An empty table gives an empty result, and with no row to fit on every score is the posterior's prior of one half.
Extra columns are dropped by ``score_quality`` and kept by ``keep_quality``; nothing is judged by id, source or label.
"""

from __future__ import annotations

import math
import operator
import re
from collections import Counter
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from veldtab.llm.common import as_bytes, map_batches, packed, table, unpacked

BITS = 18
FIT_ROWS = 12_000
EPOCHS = 4
_SYMBOLS = b"*%&$#|~^<>{}[]\\=+_@`"
_UPPER = bytes(range(65, 91))
_PLAIN = re.compile(rb"[^\W\d_]+[.,;:?!]?\Z".replace(rb"\W\d_", rb"\x00-\x40\x5B-\x60\x7B-\x7F"))
_LETTERS = bytes.maketrans(bytes(range(256)), bytes(65 if 65 <= c <= 90 else 97 if 97 <= c <= 122 or c >= 128 else 48 if 48 <= c <= 57 else c for c in range(256)))


def _share(n: float, of: float) -> float:
    return n / of if of else 0.0


class Facts:
    """What the labellers look at."""

    def __init__(self, text: bytes):
        self.words = words = text.split()
        self.n = n = len(words)
        size = len(text)
        self.symbols = _share(size - len(text.translate(None, _SYMBOLS)), size)
        self.capitals = _share(size - len(text.translate(None, _UPPER)), size)
        self.shouts = _share(text.count(b"!"), n)
        self.counts = Counter(words)
        self.same = _share(sum(map(operator.eq, words, words[1:])), n)
        self.top = _share(max(self.counts.values(), default=0), n)
        self.distinct = _share(len(self.counts), n)
        self.plain = _share(sum(c for w, c in self.counts.items() if _PLAIN.match(w)), n)
        self.length = _share(size, n)


#: name -> vote from the facts of a text
LABELLERS = {
    "empty": lambda f: -1 if f.n == 0 else 0,
    "symbols": lambda f: -1 if f.symbols > 0.03 and f.n > 4 else 0,
    "separators": lambda f: -1 if _share(f.counts[b"|"] + f.counts[b"-"] + f.counts[b"*"], f.n) > 0.1 else 0,
    "shouting": lambda f: -1 if f.n > 4 and (f.capitals > 0.3 or f.shouts > 0.15) else 0,
    "stutter": lambda f: -1 if f.n > 9 and f.same > 0.15 else 0,
    "monotony": lambda f: -1 if f.n > 29 and (f.top > 0.3 or f.distinct < 0.05) else 0,
    "plain words": lambda f: 1 if f.n and f.plain > 0.8 else -1 if f.n > 9 and f.plain < 0.5 else 0,
    "running text": lambda f: 1 if f.n and (f.same < 0.1 or f.n < 20 and f.same < 0.2) and (f.symbols < 0.01 or f.n < 20 and f.symbols < 0.03) and (f.capitals < 0.3 or f.n < 4) else 0,
}


def votes(facts: Facts) -> str:
    """One character per labeller: + sound, - junk, 0 no opinion."""
    return "".join("-0+"[labeller(facts) + 1] for labeller in LABELLERS.values())


def em(patterns: dict[str, int], rounds: int = 100) -> tuple[dict[str, float], list[dict]]:
    """Posterior of soundness for each pattern, and for each labeller its vote rates in both classes.

    Each class gives votes independently; rates start from a majority of the votes and are smoothed by half a count.
    """
    if not patterns:
        return {}, []
    keys = sorted(patterns)
    weight = np.array([patterns[k] for k in keys], float)
    code = np.array([["-0+".index(c) for c in k] for k in keys])
    onehot = np.eye(3)[code]
    lean = (code - 1).sum(axis=1)
    sound = np.where(lean > 0, 0.95, np.where(lean < 0, 0.05, 0.5))
    for _ in range(rounds):
        both = np.stack((1 - sound, sound))
        prior = (both @ weight + 1) / (weight.sum() + 2)
        rates = np.einsum("cp,p,plv->clv", both, weight, onehot) + 0.5
        rates /= rates.sum(axis=2, keepdims=True)
        log = np.log(prior)[:, None] + np.einsum("plv,clv->cp", onehot, np.log(rates))
        new = 1 / (1 + np.exp(np.clip(log[0] - log[1], -500, 500)))
        if np.abs(new - sound).max() < 1e-9:
            break
        sound = new
    names = list(LABELLERS)
    return dict(zip(keys, sound.tolist())), [{"labeller": names[i], "junk": rates[0, i].tolist(), "sound": rates[1, i].tolist()} for i in range(len(names))]


def features(facts: Facts) -> tuple[np.ndarray, np.ndarray]:
    """Hashed words, shapes of words and repeats: damped counts scaled to unit length, and a constant.

    A shape is a word with its letters and digits written as classes and runs shortened."""
    mask = (1 << BITS) - 2
    index: Counter = Counter()
    shapes: Counter = Counter()
    for word, n in facts.counts.items():
        index[crc32(word) & mask | 1] += n
        shape = word.translate(_LETTERS)
        shapes[shape[:1] + shape[1:2] + shape[-3:]] += n
    n = max(1, facts.n)
    at = [0] + list(index) + [crc32(s, 7) & mask | 1 for s in shapes] + [crc32(b"same", 9) & mask | 1, crc32(b"distinct", 9) & mask | 1]
    words = np.log1p(np.fromiter(index.values(), float, len(index)))
    norm = math.sqrt(float(words @ words)) or 1.0
    value = np.concatenate(([1.0], words / norm, np.fromiter(shapes.values(), float, len(shapes)) / n, [facts.same, facts.distinct]))
    return np.array(at, np.int64), value


def fit_scorer(rows: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray, epochs: int = EPOCHS, rate: float = 0.5) -> np.ndarray:
    """Weights of a logistic scorer for soft labels, by AdaGrad in a fixed order."""
    weights, squares = np.zeros(1 << BITS), np.full(1 << BITS, 1e-8)
    order = np.random.default_rng(0)
    for _ in range(epochs):
        for i in order.permutation(len(rows)).tolist():
            at, value = rows[i]
            p = 1 / (1 + math.exp(-max(-30.0, min(30.0, float(weights[at] @ value)))))
            slope = (p - labels[i]) * value
            squares[at] += slope * slope
            weights[at] -= rate * slope / np.sqrt(squares[at])
    return weights


def sampled(docs: DataFrame, most: int, *columns: str) -> DataFrame:
    """At most ``most`` rows with different values of the columns, those of the smallest hashes, with the hash as ``hash``; other columns are dropped.

    Equal values meet on the map side, so a frequent value costs its task no more than a rare one. Null counts as empty.
    """
    hashed = docs.select(*columns, F.xxhash64(*[F.coalesce(F.col(c).cast("binary"), F.lit(b"")) for c in columns]).alias("hash"))
    cut = hashed.select("hash").distinct().orderBy("hash").limit(most).agg(F.max("hash").alias("cut")).first()["cut"]
    if cut is None:
        return hashed.limit(0)
    return hashed.where(F.col("hash") <= cut).dropDuplicates(["hash"])


class QualityModel:
    """Posteriors of vote patterns, rates of the labellers and weights of the scorer."""

    def __init__(self, posterior: dict[str, float], rates: list[dict], weights: np.ndarray | None):
        self.posterior, self.rates, self.weights = posterior, rates, weights


def fit_quality(docs: DataFrame, text_col: str = "text", fit_rows: int = FIT_ROWS) -> QualityModel:
    """Fit labeller rates on all rows and the scorer on a sample of at most ``fit_rows`` different texts."""
    source = docs.select(F.col(text_col).cast("binary").alias("text"))
    voted = map_batches(source, "votes string", lambda batch: {"votes": [votes(Facts(t)) for t in as_bytes(batch.column(0))]})
    posterior, rates = em({r["votes"]: r["n"] for r in voted.groupBy("votes").agg(F.count(F.lit(1)).alias("n")).collect()})

    def train(batches):
        rows, labels = [], []
        for batch in batches:
            for text in as_bytes(batch.column(0)):
                facts = Facts(text)
                rows.append(features(facts))
                labels.append(posterior[votes(facts)])
        if rows:
            weights = fit_scorer(rows, np.array(labels))
            used = np.flatnonzero(weights)
            yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(weights[used])], ["at", "weight"])

    some = sampled(source, fit_rows, "text").repartition(1).sortWithinPartitions("hash").select("text")
    fitted = some.mapInArrow(train, "at long, weight double").toArrow()
    if not fitted.num_rows:
        return QualityModel(posterior, rates, None)
    weights = np.zeros(1 << BITS)
    weights[fitted.column(0).to_numpy()] = fitted.column(1).to_numpy()
    return QualityModel(posterior, rates, weights)


def _scored(df: DataFrame, model: QualityModel) -> DataFrame:
    """Add votes, posterior and score to rows with a binary ``text``, which goes."""
    shared = df.sparkSession.sparkContext.broadcast((model.posterior, model.weights))
    kept = [c for c in df.columns if c != "text"]

    def run(batch: pa.RecordBatch, state) -> dict:
        posterior, weights = state
        patterns, scores = [], []
        for text in as_bytes(batch.column("text")):
            facts = Facts(text)
            patterns.append(votes(facts))
            if weights is None:
                scores.append(0.5)
                continue
            at, value = features(facts)
            scores.append(1 / (1 + math.exp(-max(-30.0, min(30.0, float(weights[at] @ value))))))
        return {c: batch.column(c) for c in kept} | {"votes": patterns, "posterior": [posterior.get(p, 0.5) for p in patterns], "score": scores}

    schema = df.select(*kept).schema.add("votes", "string").add("posterior", "double").add("score", "double")
    return map_batches(df, schema, run, lambda: shared.value)


def score_quality(docs: DataFrame, model: QualityModel, id_col: str = "doc_id", text_col: str = "text", least: float = 0.5) -> DataFrame:
    """(doc_id, votes, posterior, score, keep) per row: ``keep`` where the scorer gives at least ``least``."""
    scored = _scored(docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("binary").alias("text")), model)
    return scored.withColumn("keep", F.col("score") >= least)


def keep_quality(docs: DataFrame, model: QualityModel, text_col: str = "text", least: float = 0.5) -> DataFrame:
    """The rows whose score is at least ``least``, with their own columns."""
    return unpacked(_scored(packed(docs, F.col(text_col).cast("binary").alias("text")), model).where(F.col("score") >= least))


def op8_weak_label_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return score_quality(docs, fit_quality(docs))
