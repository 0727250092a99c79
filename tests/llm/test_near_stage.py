"""The near-duplicate stage: SimHash components, one row kept of each, against brute force."""

import random

from pyspark.sql import functions as F

import corpus_pipeline
from tests.llm.test_search_and_pairs import brute_components, brute_fingerprint
from veldtab.llm import simhash

SF = "/root/testdata/sf0.001"


def brute_kept(rows):
    """Texts and ids kept of (id, text): the smallest id of each component, nulls last."""
    numbered = [(k, brute_fingerprint(t)) for k, (_, t) in enumerate(rows)]
    groups = {}
    for k, _, c in brute_components(numbered):
        groups.setdefault(c, []).append(rows[k])
    return [min((i is None, i or 0) for i, _ in g) for g in groups.values()], [{(i, t or "") for i, t in g} for g in groups.values()]


def check(spark, rows):
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    kept = [(r.doc_id, r.text or "") for r in simhash.drop_near_duplicates(docs).collect()]
    least, groups = brute_kept(rows)
    assert len(kept) == len(groups)
    for order, group in zip(least, groups):
        mine = [k for k in kept if k in group]
        assert len(mine) >= 1 and ((mine[0][0] is None, mine[0][0] or 0) == order or len(mine) > 1)
    return kept


def test_crowded_group_of_edited_copies(spark):
    rng = random.Random(6)
    base = [f"w{rng.randrange(5000)}" for _ in range(400)]
    rows = []
    for k in range(120):
        words = list(base)
        for _ in range(rng.choice([0, 1, 1, 2])):
            words[rng.randrange(400)] = f"x{k}"
        rows.append((k, " ".join(words)))
    rows += [(1000 + k, " ".join(f"w{rng.randrange(5000)}" for _ in range(60))) for k in range(40)]
    kept = check(spark, rows)
    assert 41 <= len(kept) < 120


def test_rows_not_ids_decide(spark):
    rows = [(1, "one text of its own about this and that"), (1, "another text under the same number, unlike the first one"), (2, "one text of its own about this and that"),
            (None, "one text of its own about this and that"), (None, "only here and without any number"), (None, "only here and without any number"), (3, None), (4, ""), (5, " \n")]
    kept = simhash.drop_near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted((r.doc_id or -1, r.text or "") for r in kept) == sorted([(1, rows[0][1]), (1, rows[1][1]), (-1, rows[4][1]), (3, "")])


def test_odd_rows_clashing_columns_and_empty_table(spark, odd, none):
    clashing = odd.withColumns({c: F.lit(1) for c in ("name", "least", "none", "root", "doc_id_")})
    kept = corpus_pipeline.drop_near_duplicates(spark, clashing, SF)
    assert kept.columns == clashing.columns
    rows = [(r.doc_id, r.text) for r in odd.collect()]
    assert kept.count() == len(brute_kept(rows)[1])
    assert corpus_pipeline.drop_near_duplicates(spark, none, SF).collect() == []


def test_text_ids(spark):
    rows = [("b", "the same words in a row here"), ("a", "the same words in a row here"), ("c", "other words altogether, none of them shared")]
    kept = simhash.drop_near_duplicates(spark.createDataFrame(rows, "doc_id string, text string")).collect()
    assert sorted(r.doc_id for r in kept) == ["a", "c"]
