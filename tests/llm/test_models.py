"""Context-tree scores, language identification, weak-label quality, raked mixing."""

import math
import zlib
from collections import Counter
from functools import lru_cache

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.llm.conftest import ODD
from veldtab.llm import context_tree, language, mixing, quality
from veldtab.llm.common import id_bucket, table

SMALL, SF = "/root/testdata/sf0.001", "/root/testdata/sf0.01"
LOWER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))


def brute_context_tree(train, texts, depth):
    """log10 probabilities by the plain recursion: estimates and weighted probabilities node by node, all in logarithms."""
    counts = Counter()
    for t in train:
        s = b"\xff" * depth + t + b"\xff"
        for i in range(depth, len(s)):
            for k in range(8):
                node = (1 << k) | s[i] >> (8 - k)
                for d in range(depth + 1):
                    counts[node, s[i - d:i], s[i] >> (7 - k) & 1] += 1
    children = {}
    for node, context, _ in counts:
        if context:
            children.setdefault((node, context[1:]), set()).add(context)

    def log_kt(a, b):
        return math.lgamma(a + .5) + math.lgamma(b + .5) - math.lgamma(a + b + 1) - math.log(math.pi)

    @lru_cache(None)
    def parts(node, context):
        own = log_kt(counts[node, context, 0], counts[node, context, 1])
        return own, sum(weighted(node, c) for c in children.get((node, context), ()))

    @lru_cache(None)
    def weighted(node, context):
        own, below = parts(node, context)
        return own if len(context) == depth else np.logaddexp(own, below) - math.log(2)

    def predict(node, context, bit):
        p = None
        for d in range(depth, -1, -1):
            c = context[len(context) - d:]
            n = counts[node, c, 0] + counts[node, c, 1]
            kt = (counts[node, c, bit] + .5) / (n + 1)
            if p is None:
                p = kt
            else:
                own, below = parts(node, c)
                share = 1 / (1 + math.exp(min(700, max(-700, below - own))))
                p = share * kt + (1 - share) * p
        return p

    out = []
    for t in texts:
        s = b"\xff" * depth + t + b"\xff"
        out.append(sum(math.log10(predict((1 << k) | s[i] >> (8 - k), s[i - depth:i], s[i] >> (7 - k) & 1)) for i in range(depth, len(s)) for k in range(8)))
    return out


@pytest.mark.parametrize("materialise", [False, True])
def test_context_tree_like_the_recursion(spark, odd, materialise):
    docs = odd.where("length(text) < 1000 OR text IS NULL")
    rows = [(d[0], (d[1] or "").encode().translate(LOWER)) for d in ODD if len(d[1] or "") < 1000]
    learned = [t for i, t in rows if i is None or zlib.crc32(str(i).encode()) % 10]
    scores = dict(zip((t for _, t in rows), brute_context_tree(learned, [t for _, t in rows], context_tree.DEPTH)))
    words = Counter(w for t in learned for w in t.split() + [b""])
    n, v = sum(words.values()), len(words)
    texts = {i: t for i, t in rows}
    got = context_tree.score_texts(docs, id_bucket(F.col("doc_id"), 10) != 0, materialise=materialise).collect()
    assert len(got) == len(rows)
    for r in got:
        tokens = texts[r.doc_id].split() + [b""]
        assert r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 10 == 0)
        assert (r.n_tokens, r.n_known, r.train_tokens) == (len(tokens), sum(w in words for w in tokens), n)
        assert r.base_score == pytest.approx(sum(math.log10((words[w] + .1) / (n + .1 * (v + 1))) for w in tokens), rel=1e-9)
        assert r.score == pytest.approx(scores[texts[r.doc_id]], rel=1e-6)


def test_context_tree_beats_words_on_held_out_rows(spark):
    got = context_tree.op1_context_tree_scores(spark, SF).where("held_out").agg(F.sum("score").alias("s"), F.sum("base_score").alias("b")).first()
    assert got.s > got.b


def test_context_tree_without_rows(spark, odd, none):
    assert context_tree.score_texts(none, F.lit(True)).count() == 0
    rows = context_tree.score_texts(odd.where("length(text) < 1000"), F.lit(False)).collect()
    assert all(r.train_tokens == 0 and r.n_known == 0 and r.held_out for r in rows)
    assert all(r.score == pytest.approx(-8 * math.log10(2) * (len(next(d[1] for d in ODD if d[0] == r.doc_id).encode()) + 1)) for r in rows)


def test_language(spark, odd, none):
    rows = language.op7_language(spark, SF).join(table(spark, SF, "documents").select("doc_id", "lang"), "doc_id").collect()
    held = [r for r in rows if r.held_out]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in rows)
    right = sum(r.lang == r.lang_pred for r in held) / len(held)
    assert right > 0.98 and abs(sum(r.score for r in held) / len(held) - right) < 0.03 and all(0 <= r.score <= 1 for r in rows)
    model = language.fit_language(table(spark, SMALL, "documents"), F.lit(True))
    strange = {r.doc_id: r for r in language.identify(odd, model).collect()}
    assert [i for i in (1, 2, 3) if strange[i].lang_pred != "und"] == [] and all(strange[i].lang_pred in model.languages for i in (4, 6, 7, 8, None))
    assert language.identify(none, model).count() == 0
    nothing = language.fit_language(none, F.lit(True))
    assert {(r.lang_pred, r.score) for r in language.identify(odd, nothing).collect()} == {("und", 0.0)}


def test_pieces_of_long_texts_add_up(monkeypatch):
    text = "Some longer text, dealt out in pieces. " * 30
    whole = language.term_shares(text)
    monkeypatch.setattr(language, "PIECE", 37)
    parts = language.term_shares(text)
    assert (whole[0] == parts[0]).all() and np.allclose(whole[1], parts[1])


def test_labeller_rates_are_recovered():
    rng = np.random.default_rng(0)
    names, n = len(quality.LABELLERS), 20_000
    sound = rng.random(n) < 0.8
    rate = np.linspace(0.65, 0.95, names)
    right = rng.random((n, names)) < rate
    votes = Counter("".join("+" if a == b else "-" for a in row) for row, b in ((r == s, True) for r, s in zip(right, sound)))
    posterior, rates = quality.em(votes)
    for r, want in zip(rates, rate):
        assert r["sound"][2] == pytest.approx(want, abs=0.03) and r["junk"][0] == pytest.approx(want, abs=0.06)
    assert quality.em({}) == ({}, [])


def test_quality(spark, odd, none):
    docs = table(spark, SF, "documents")
    model = quality.fit_quality(docs)
    rows = quality.score_quality(docs, model).join(table(spark, SF, "labels"), "doc_id").collect()
    junk, sound = [r.keep for r in rows if r.quality == 0], [r.keep for r in rows if r.quality == 1]
    assert sum(junk) / len(junk) < 0.03 and sum(sound) / len(sound) > 0.99
    strange = {r.doc_id: r for r in quality.score_quality(odd, model).collect()}
    assert not strange[1].keep and not strange[2].keep and not strange[6].keep and strange[4].keep and strange[None].keep
    kept = quality.keep_quality(odd, model)
    assert kept.columns == odd.columns and kept.count() == quality.score_quality(odd, model).where("keep").count()
    assert quality.score_quality(none, model).count() == 0
    assert {r.score for r in quality.score_quality(odd, quality.fit_quality(none)).collect()} == {0.5}


def test_mixing_meets_given_targets(spark):
    docs = table(spark, SF, "documents")
    targets = {"lang": spark.createDataFrame([("en", 1.0), ("de", 2.0), ("fr", 1.0), ("xx", 9.0)], "value string, share double")}
    rows = mixing.mix(docs, targets, budget_share=0.3).join(docs.select("doc_id", "lang"), "doc_id").collect()
    mass = Counter()
    for r in rows:
        mass[r.lang] += r.weight * r.n_tokens
    total = sum(mass.values())
    assert mass["es"] == 0 and [round(mass[x] / total, 6) for x in ("en", "de", "fr")] == [0.25, 0.5, 0.25]
    assert sum(r.probability * r.n_tokens for r in rows) == pytest.approx(0.3 * sum(r.n_tokens for r in rows), rel=1e-6)
    assert all(not r.sampled for r in rows if r.lang == "es") and len(rows) == docs.count()


def test_mixing_odd_rows(spark, odd, none):
    rows = mixing.mix(odd).collect()
    assert len(rows) == len(ODD) and {r.n_tokens for r in rows if r.doc_id in (1, 2, 3)} == {0}
    assert len({(r.probability, r.sampled) for r in rows if r.doc_id == 4}) == 1
    kept = mixing.sample_mix(odd, budget_share=2.0)
    assert kept.columns == odd.columns and kept.count() == sum(1 for r in rows if r.weight > 0)
    assert mixing.mix(none).count() == 0


def test_packed_rows_come_back():
    rng = np.random.default_rng(0)
    for values in (np.empty(0, np.int64), np.array([0]), rng.integers(0, 1 << 48, 1000), rng.integers(0, 3, 70_000)):
        assert (context_tree.unpack(context_tree.pack(values)) == values).all()
        assert (context_tree.unpack_rising(context_tree.pack_rising(np.sort(values))) == np.sort(values)).all()
    for words in ([b""], [b"", b"a", "ü".encode()], [b"x" * 100_000, b"y"]):
        assert context_tree.unpack_words(context_tree.pack_words(words)) == words
    gram = rng.integers(0, 1 << 48, 1000)
    assert (context_tree.as_grams(context_tree.as_keys(gram)) == gram).all()
