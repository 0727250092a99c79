"""Samples that a classifier is fitted on stay bounded and varied where one text fills the table."""

from pyspark.sql import functions as F

from tests.llm.test_models import SF
from veldtab.llm import language, quality
from veldtab.llm.common import table


def skewed(spark):
    docs = table(spark, SF, "documents").select("text", "lang")
    return docs.unionByName(spark.range(3000).select(F.lit(None).cast("string").alias("text"), F.lit("en").alias("lang")))


def test_sample_is_bounded_and_equal_texts_count_once(spark):
    both = skewed(spark)
    for most in (1, 50, 200):
        got = [r.text for r in quality.sampled(both, most, "text").collect()]
        assert len(got) == most == len({t or "" for t in got})
    assert quality.sampled(both, 10**6, "text").count() == both.select(F.coalesce("text", F.lit(""))).distinct().count()
    assert quality.sampled(both.limit(0), 10, "text").count() == 0


def test_null_texts_do_not_move_the_scorer(spark):
    docs = table(spark, SF, "documents")
    plain, full = quality.fit_quality(docs, fit_rows=300), quality.fit_quality(skewed(spark), fit_rows=300)
    sound = [r.doc_id for r in table(spark, SF, "labels").where("quality = 1").collect()]
    kept = [quality.score_quality(docs, m).where(F.col("doc_id").isin(sound) & F.col("keep")).count() for m in (plain, full)]
    assert min(kept) > 0.98 * len(sound)


def test_language_sample_is_bounded(spark):
    rows = skewed(spark).withColumn("text", F.coalesce("text", F.lit("One sentence that stands in thousands of rows.")))
    assert quality.sampled(rows, 100, "text", "lang").count() == 100
    model = language.fit_language(rows, F.lit(True), fit_rows=300)
    docs = table(spark, SF, "documents").where("text is not null and lang is not null").limit(200).collect()
    right = [model.predict(r.text)[0] == r.lang for r in docs if language.has_letter(r.text)]
    assert sum(right) > 0.9 * len(right)
