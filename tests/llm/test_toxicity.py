"""Operator 13: held-out accuracy, sparsity, bounds and odd input."""

from zlib import crc32

import numpy as np
from pyspark.sql import functions as F

from veldtab.llm import toxicity
from veldtab.llm.common import table

SF = "/root/testdata/sf0.1"


def test_held_out_accuracy(spark):
    rows = {r.doc_id: r for r in toxicity.op13_toxicity(spark, SF).collect()}
    docs, labels = table(spark, SF, "documents"), table(spark, SF, "labels").collect()
    assert len(rows) == docs.count()
    assert all(r.held_out == (crc32(str(i).encode()) % 4 == 2) and 0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for i, r in rows.items())
    held = [(rows[x.doc_id].predicted, x.toxic) for x in labels if rows[x.doc_id].held_out]
    caught = np.mean([p for p, y in held if y == 1])
    false = np.mean([p for p, y in held if y == 0])
    assert caught >= 0.85 and false <= 0.01, (caught, false)


def test_labels_of_held_out_rows_change_nothing(spark):
    sf = "/root/testdata/sf0.01"
    docs, labels = table(spark, sf, "documents"), table(spark, sf, "labels")
    training = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 != 2
    turned = labels.withColumn("toxic", F.when(training, F.col("toxic")).otherwise(1 - F.col("toxic")))
    a, b = (toxicity.fit_toxicity(docs, x, training) for x in (labels, turned))
    assert a.bias == b.bias and (a.at == b.at).all() and (a.weight == b.weight).all()
    assert 0 < len(a.at) < 20_000


def test_odd_rows(spark, odd, none):
    labels = spark.createDataFrame([(4, 1), (4, 0), (5, 1), (8, None), (9, 0), (99, 1), (None, 1), (1, 0)], "doc_id long, toxic int")
    for known in (labels, labels.limit(0)):
        model = toxicity.fit_toxicity(odd, known, F.lit(True))
        rows = toxicity.score_toxicity(odd, model).collect()
        assert len(rows) == odd.count() and all(0 <= r.score <= 1 for r in rows)
        assert len({r.score for r in rows if r.doc_id in (1, 2, 3)}) == 1 and len({r.score for r in rows if r.doc_id in (4, 5)}) == 1
    assert {r.score for r in rows} == {0.5}
    model = toxicity.fit_toxicity(none, labels, F.lit(True))
    assert model.bias == 0 and toxicity.score_toxicity(none, model).count() == 0


def test_sample_is_bounded(spark):
    docs = spark.range(400).select(F.lit(7).cast("long").alias("doc_id"), F.concat(F.lit("text "), (F.col("id") % 3).cast("string")).alias("text"))
    labels = spark.range(400).select(F.col("id").alias("doc_id"), (F.col("id") % 2).cast("int").alias("toxic"))
    model = toxicity.fit_toxicity(docs, labels, F.lit(True), fit_rows=100)
    assert toxicity.score_toxicity(docs, model).count() == 400


def test_pieces_see_the_same_features():
    text = " ".join(f"w{k % 977}" for k in range(3 * toxicity.PIECE // 2))
    words = text.split()
    hashes = toxicity.Hashes()
    short = [toxicity.features(" ".join(words[a:a + 1000]), hashes) for a in range(0, len(words) - 2, 998)]
    assert (toxicity.features(text, hashes) == np.unique(np.concatenate(short))).all()
    assert len(toxicity.features(None, hashes)) == len(toxicity.features(" .,! ", hashes)) == 0


def test_l1_keeps_rare_coordinates_at_zero():
    leader = toxicity.Proximal()
    for _ in range(200):
        leader.learn(np.array([1, 2], np.int32), 1.0)
        leader.learn(np.array([1, 3], np.int32), 0.0)
    leader.learn(np.array([4], np.int32), 1.0)
    w = leader.weights(np.array([1, 2, 3, 4]))
    assert w[1] > 1 and w[2] < -1 and w[3] == 0 and abs(w[0]) < 0.5
