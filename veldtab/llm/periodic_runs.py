"""Runs of periodic words: maximal stretches that repeat with a smallest period, found by descending longest common prefixes.

A run is a stretch of consecutive words with smallest period q whose length is at least ``least`` and at least 2 q, and which no
neighbouring word extends. Per text:

1. Texts in which no window of ``least`` / 2 words occurs twice have no run, since the run's first word and the one a period
   later have at least so many words in common. Window hashes decide that; equal windows have equal hashes, so no text is lost.
2. The other texts get a suffix array by prefix doubling and the longest common prefixes (LCP) of its neighbours.
3. Kruskal: classes of suffixes are united in order of decreasing LCP by union-find. A class keeps its positions in order; the smaller is
   merged into the larger. Two positions that become neighbours at distance d <= LCP share exactly LCP words, so the words from
   the first on have smallest period d over d + LCP words: a seed. It is the run itself where the word before does not
   repeat, and every run has exactly one such seed.

Words are the stretches without ASCII white space; texts are taken whole, each in one task, and nothing is shuffled. A null, empty or blank text
has no words and no runs. Repeated rows and ids get equal answers, null ids are kept, an empty table gives an
empty result, extra columns are dropped. Ties: runs are listed by start, then period. Very long texts need memory
in proportion to their own words.
"""

from __future__ import annotations

from bisect import bisect_left

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from veldtab.llm.common import as_bytes, map_batches, table

#: Least length of a run in words.
LEAST = 12
#: From so many positions on, two ordered sets are merged by sorting instead of one insertion each.
INSERTED = 8
_STEP = np.uint64(0x9E3779B97F4A7C15)
_RUNS = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))


def numbered(words: list[bytes]) -> np.ndarray:
    """Words as numbers, equal for equal words."""
    seen: dict[bytes, int] = {}
    return np.array([seen.setdefault(w, len(seen)) for w in words], np.int64)


def repeats_window(codes: np.ndarray, width: int) -> bool:
    """Whether the hash of some window of ``width`` words occurs twice."""
    count = len(codes) - width + 1
    if count < 2:
        return False
    mixed = (codes.astype(np.uint64) + np.uint64(1)) * _STEP
    mixed ^= mixed >> np.uint64(29)
    total = np.zeros(count, np.uint64)
    for k in range(width):
        total = total * _STEP + mixed[k:k + count]
    total.sort()
    return bool((total[1:] == total[:-1]).any())


def suffix_array(codes: np.ndarray) -> np.ndarray:
    """Start positions of the suffixes in lexicographic order, by prefix doubling."""
    n = len(codes)
    rank, width = np.unique(codes, return_inverse=True)[1].astype(np.int64) + 1, 1
    while True:
        key = rank * (n + 1)
        key[:n - width] += rank[width:]
        order = np.argsort(key, kind="stable")
        ranked = key[order]
        fresh = np.empty(n, np.int64)
        fresh[order] = np.cumsum(np.concatenate(([True], ranked[1:] != ranked[:-1])))
        rank, width = fresh, 2 * width
        if rank.max() == n or width >= n:
            return order


def common_prefixes(codes: list[int], order: list[int]) -> list[int]:
    """LCP of each suffix with the next one in lexicographic order."""
    n = len(codes)
    after = [-1] * n
    for a, b in zip(order, order[1:]):
        after[a] = b
    out, shared = [0] * n, 0
    for i in range(n):
        j = after[i]
        if j < 0:
            shared = 0
            continue
        most = n - max(i, j)
        while shared < most and codes[i + shared] == codes[j + shared]:
            shared += 1
        out[i] = shared
        if shared:
            shared -= 1
    return [out[i] for i in order[:-1]]


def _merge(few: list[int], many: list[int]) -> list[tuple[int, int]]:
    """Put the ordered positions ``few`` into ``many``; the pairs of the two sets that are neighbours afterwards."""
    pairs, last, at = [], len(few) - 1, 0
    places = []
    for k, x in enumerate(few):
        at = bisect_left(many, x, at)
        places.append(at)
        if at and (not k or many[at - 1] > few[k - 1]):
            pairs.append((many[at - 1], x))
        if at < len(many) and (k == last or many[at] < few[k + 1]):
            pairs.append((x, many[at]))
    if len(few) > INSERTED:
        many += few
        many.sort()
    else:
        for k, x in enumerate(few):
            many.insert(places[k] + k, x)
    return pairs


def runs_of(codes: np.ndarray, least: int = LEAST) -> list[tuple[int, int, int]]:
    """(start, length, period) of every run of a sequence of numbers, by start, then period."""
    half = (least + 1) // 2
    if not repeats_window(codes, half):
        return []
    suffixes = suffix_array(codes)
    values, order = codes.tolist(), suffixes.tolist()
    shared = np.array(common_prefixes(values, order), np.int64)
    wanted = np.flatnonzero(shared >= half)
    wanted = wanted[np.argsort(-shared[wanted], kind="stable")]
    parent = list(range(len(order)))
    positions: list = [[p] for p in order]
    found = []
    for edge, common in zip(wanted.tolist(), shared[wanted].tolist()):
        a, b = edge, edge + 1
        while parent[a] != a:
            parent[a] = a = parent[parent[a]]
        while parent[b] != b:
            parent[b] = b = parent[parent[b]]
        if len(positions[a]) < len(positions[b]):
            a, b = b, a
        for p, q in _merge(positions[b], positions[a]):
            d = q - p
            if d <= common and d + common >= least and (not p or values[p - 1] != values[q - 1]):
                found.append((p, d + common, d))
        parent[b], positions[b] = a, None
    return sorted(found, key=lambda r: (r[0], r[2]))


def collapsed(words: list[bytes], runs: list[tuple[int, int, int]]) -> bytes:
    """The words without those that a run repeats, joined by spaces."""
    if not runs:
        return b" ".join(words)
    depth = np.zeros(len(words) + 1, np.int64)
    for start, length, period in runs:
        depth[start + period] += 1
        depth[start + length] -= 1
    kept = np.flatnonzero(np.cumsum(depth[:-1]) == 0)
    return b" ".join([words[k] for k in kept.tolist()])


def periodic_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: int = LEAST) -> DataFrame:
    """(doc_id, runs, collapsed) per row: runs as an array of (start, length, period), and the text with each repeat left out."""
    if least < 2:
        raise ValueError("a run has two words at least")

    def run(batch: pa.RecordBatch) -> dict:
        runs, texts = [], []
        for text in as_bytes(batch.column(1)):
            words = text.split()
            found = runs_of(numbered(words), least) if len(words) >= least else []
            runs.append([{"start": s, "length": n, "period": q} for s, n, q in found])
            texts.append(collapsed(words, found))
        return {"doc_id": batch.column(0), "runs": pa.array(runs, _RUNS), "collapsed": pa.array(texts, pa.binary())}

    source = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    return map_batches(source, f"doc_id {source.schema['doc_id'].dataType.simpleString()}, "
                               "runs array<struct<start:long,length:long,period:long>>, collapsed string", run)


def with_planted_periods(docs: DataFrame) -> DataFrame:
    """(doc_id, text): in a tenth of the documents, chosen by the id, the words from one on repeat with a period that the id sets."""
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    chosen = docs.select("doc_id", "text", h.alias("h")).withColumn("g", F.expr("h div 10"))
    # words only where they are changed
    split = F.filter(F.split("text", r"[\x20\x09-\x0D]+"), lambda w: w != "")
    split = chosen.withColumn("words", F.when(F.col("h") % 10 == 0, split)).withColumn("n", F.size("words"))
    placed = split.withColumn("a", F.expr("if(n > 0, int(g % n), 0)")).withColumn("p", F.expr("1 + int((n - a) div (3 + g % 8))"))
    repeated = F.expr("concat(slice(words, 1, a), slice(flatten(array_repeat(slice(words, a + 1, p), int(ceil((n - a) / p)))), 1, n - a))")
    return placed.select("doc_id", F.when(F.col("n") > 0, F.array_join(repeated, " ")).otherwise(F.col("text")).alias("text"))


def digests(found: DataFrame) -> DataFrame:
    """One row of figures per document from (doc_id, runs, collapsed)."""
    longest = F.expr("array_max(transform(runs, r -> struct(r.length, -r.start AS start, -r.period AS period)))")
    lines = F.expr(r"array_join(transform(runs, r -> concat_ws(',', r.start, r.length, r.period) || chr(10)), '')")
    return found.withColumn("longest", longest).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"),
        (-F.col("longest.start")).alias("start"), F.col("longest.length").alias("length"), (-F.col("longest.period")).alias("period"),
        F.expr("1000 * longest.length div -longest.period").alias("exponent_milli"),
        F.sha2(lines, 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digests(periodic_runs(with_planted_periods(table(spark, sf_dir, "documents").select("doc_id", "text"))))
