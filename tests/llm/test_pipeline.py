"""Each stage of the pipeline against brute force over what its predecessor kept."""

import re

import corpus_pipeline
from tests.llm.test_counts_and_scans import brute_spans
from tests.llm.test_search_and_pairs import brute_components, brute_fingerprint, brute_windows
from veldtab.llm import mixing
from veldtab.llm.common import table
from veldtab.sources.storage import write_through

SF = "/root/testdata/sf0.001"


def test_stages(spark):
    docs = table(spark, SF, "documents")
    columns, quality = docs.columns, {r.doc_id: r.quality for r in table(spark, SF, "labels").collect()}
    bench = [tuple(r) for r in table(spark, SF, "benchmark").select("item_id", "text").collect()]
    kept = [docs]
    for name, stage in corpus_pipeline.STAGES:
        kept.append(write_through(stage(spark, kept[-1], SF), f"test-{name}"))
        assert kept[-1].columns == columns
    rows = [{r.doc_id: r for r in df.collect()} for df in kept]
    assert all(set(b) <= set(a) for a, b in zip(rows, rows[1:]))
    assert {quality[i] for i in set(rows[0]) - set(rows[1]) if i in quality} == {0} and 0 not in {quality[i] for i in rows[1] if i in quality}
    components = brute_components([(i, brute_fingerprint(r.text)) for i, r in sorted(rows[1].items())])
    assert set(rows[2]) == {c for _, _, c in components}
    assert set(rows[3]) == {i for i, r in rows[2].items() if not brute_windows(r.text, bench)[1]}
    assert set(rows[4]) == set(rows[3])
    for i, r in rows[4].items():
        assert not brute_spans(r.text) and r.n_chars == len(r.text)
        assert r == rows[3][i] if not brute_spans(rows[3][i].text) else "<redacted>" in r.text
    drawn = {r.doc_id for r in mixing.mix(kept[4]).collect() if r.sampled}
    assert set(rows[5]) == drawn and all(rows[5][i] == rows[4][i] for i in drawn)


def test_run_is_the_stages(spark):
    out = corpus_pipeline.run(spark, SF)
    assert out.columns == table(spark, SF, "documents").columns and 20 < out.count() < 200
    assert not any(re.search("AKIA[A-Z0-9]{14}", r.text or "") for r in out.collect())
