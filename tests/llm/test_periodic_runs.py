"""Operator 12 against a plain search over all periods."""

import random
from hashlib import sha256
from zlib import crc32

import numpy as np
import pytest

from tests.llm.conftest import ODD
from veldtab.llm import periodic_runs
from veldtab.llm.common import table

SF = "/root/testdata/sf0.001"


def plain_runs(x, least=12):
    found = []
    for q in range(1, len(x) // 2 + 1):
        i = 0
        while i + q < len(x):
            if x[i] != x[i + q]:
                i += 1
                continue
            j = i
            while j + q < len(x) and x[j] == x[j + q]:
                j += 1
            n = j - i + q
            if n >= max(least, 2 * q) and not any(all(x[k] == x[k + z] for k in range(i, i + n - z)) for z in range(1, q)):
                found.append((i, n, q))
            i = j
    return sorted(found, key=lambda r: (r[0], r[2]))


@pytest.mark.parametrize("least", [2, 3, 5, 12])
def test_runs(least):
    rng = random.Random(least)
    for _ in range(700):
        n, k = rng.randint(0, 70), rng.choice([1, 2, 2, 3, 5])
        x = [rng.randrange(k) for _ in range(n)]
        if n > 6 and rng.random() < 0.5:
            a, p = rng.randrange(n), 1 + rng.randrange(9)
            x = x[:a] + [x[min(n - 1, a + (i - a) % p)] for i in range(a, n)]
        assert periodic_runs.runs_of(np.array(x, np.int64), least) == plain_runs(x, least), x


def plain(doc_id, text):
    words = (text or "").encode().split()
    n = len(words)
    if doc_id is not None and n:
        h = crc32(str(doc_id).encode())
        g = h // 10
        if h % 10 == 0:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    runs = plain_runs(words) if n <= 3000 else None
    return words, runs


def test_query_rows(spark, odd, none):
    docs = table(spark, SF, "documents").select("doc_id", "text").unionByName(odd.select("doc_id", "text"))
    edited = periodic_runs.with_planted_periods(docs)
    rows = periodic_runs.digests(periodic_runs.periodic_runs(edited)).collect()
    assert len(rows) == docs.count()
    want, planted = [], 0
    for r in docs.collect():
        words, runs = plain(r.doc_id, r.text)
        planted += words != (r.text or "").encode().split()
        if runs is None:
            assert len(set(words)) == 1 or r.doc_id != 6, "only the unary text is too long for the plain search"
            runs = [(0, len(words), 1)] if len(set(words)) == 1 else periodic_runs.runs_of(periodic_runs.numbered(words))
        gone = {k for s, n, q in runs for k in range(s + q, s + n)}
        best = min(runs, key=lambda x: (-x[1], x[0], x[2]), default=None)
        want.append((str(r.doc_id), len(runs), *([best[0], best[1], best[2], 1000 * best[1] // best[2]] if best else [None] * 4),
                     sha256("".join(f"{s},{n},{q}\n" for s, n, q in runs).encode()).hexdigest(),
                     sha256(b" ".join(w for k, w in enumerate(words) if k not in gone)).hexdigest()))
    got = [(str(r.doc_id), r.n_runs, r.start, r.length, r.period, r.exponent_milli, r.runs_sha256, r.collapsed_sha256) for r in rows]
    assert sorted(map(repr, got)) == sorted(map(repr, want)) and planted > 5
    assert periodic_runs.periodic_runs(none).count() == 0


def test_operator_returns_runs_and_text(spark, odd):
    rows = periodic_runs.periodic_runs(odd.withColumnRenamed("doc_id", "n").withColumnRenamed("text", "t"), "n", "t").collect()
    assert len(rows) == len(ODD)
    long = next(r for r in rows if r.doc_id == 6)
    assert [tuple(x) for x in long.runs] == [(0, 30_000, 1)] and long.collapsed == "word"
    assert {r.collapsed for r in rows if r.doc_id in (1, 2, 3)} == {""}


def test_query(spark):
    out = periodic_runs.op12_periodic_runs(spark, SF)
    assert out.dtypes == [("doc_id", "bigint"), ("n_runs", "bigint"), ("start", "bigint"), ("length", "bigint"), ("period", "bigint"),
                          ("exponent_milli", "bigint"), ("runs_sha256", "string"), ("collapsed_sha256", "string")]
    assert out.count() == table(spark, SF, "documents").count()
