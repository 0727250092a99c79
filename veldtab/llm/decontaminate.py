"""Benchmark decontamination: Wu-Manber search for windows of benchmark words in documents.

The alphabet is the word: a window is ten consecutive words of an item (all words of a shorter item), a block is two
neighbouring words. Windows of one length share a shift table (how far the search may jump when it sees a block), and
buckets by the last block, then by the first, hold the windows that are compared word by word.

Windows are handed to the tasks in blocks of at most ``block_rows`` (window, item) pairs, so what is broadcast is bounded
whatever the benchmark's size; every further block is one more narrow pass over the documents. Documents are
never shuffled.

Nulls and empty texts have no words: no hits, no items. Repeated rows are judged one by one. A null item id is written as
the empty string. An empty benchmark hits nothing. Extra columns are dropped by ``find_windows`` and kept by
``decontaminate``.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import islice

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from veldtab.llm.common import LOWER_ASCII, as_bytes, packed, table, unpacked, map_batches
from veldtab.sources.storage import write_through

WINDOW = 10
BLOCK_ROWS = 200_000
#: Bytes outside words become spaces: everything of ASCII but letters and digits.
_WORDS = bytes(c if 0x30 <= c <= 0x39 or 0x61 <= c <= 0x7A or c >= 0x80 else 0x20 for c in LOWER_ASCII)


def words_of(text: bytes) -> list[bytes]:
    """Lower-cased words of letters, digits and non-ASCII characters."""
    return text.translate(_WORDS).split()


def windows_of(text: bytes, size: int) -> list[bytes]:
    words = words_of(text)
    if not words:
        return []
    return [b" ".join(words[i:i + size]) for i in range(max(1, len(words) - size + 1))]


class WordSearch:
    """Wu-Manber tables over windows of one length."""

    def __init__(self, length: int, windows: dict[tuple[bytes, ...], list[str]]):
        self.length = length
        self.block = min(2, length)
        self.jump = length - self.block + 1
        self.shift: dict[bytes, int] = {}
        self.buckets: dict[bytes, dict[bytes, list[tuple[list[bytes], list[str]]]]] = {}
        for window, items in windows.items():
            for end in range(self.block, length + 1):
                block = b" ".join(window[end - self.block:end])
                self.shift[block] = min(self.shift.get(block, self.jump), length - end)
            last, first = b" ".join(window[-self.block:]), b" ".join(window[:self.block])
            self.buckets.setdefault(last, {}).setdefault(first, []).append((list(window), items))

    def occurrences(self, words: list[bytes]) -> Iterator[tuple[int, list[str]]]:
        """(start, item ids) of every occurrence of every window."""
        length, jump, shift, n = self.length, self.jump, self.shift.get, len(words)
        pair = self.block == 2
        at = length - 1
        while at < n:
            block = words[at - 1] + b" " + words[at] if pair else words[at]
            step = shift(block, jump)
            if step:
                at += step
                continue
            start = at - length + 1
            first = words[start] + b" " + words[start + 1] if pair else words[start]
            for window, items in self.buckets[block].get(first, ()):
                if words[start:at + 1] == window:
                    yield start, items
            at += 1


def build_search(pairs: list[tuple[bytes, str]]) -> list[WordSearch]:
    by_length: dict[int, dict[tuple[bytes, ...], list[str]]] = {}
    for window, item in pairs:
        words = tuple(window.split(b" "))
        by_length.setdefault(len(words), {}).setdefault(words, []).append(item)
    return [WordSearch(length, windows) for length, windows in sorted(by_length.items())]


def benchmark_windows(benchmark: DataFrame, size: int = WINDOW, id_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """Distinct (window, item) pairs."""
    def cut(batch: pa.RecordBatch) -> dict:
        windows, items = [], []
        for item, text in zip(batch.column(0).to_pylist(), as_bytes(batch.column(1))):
            found = windows_of(text, size)
            windows += found
            items += [item] * len(found)
        return {"window": pa.array(windows, pa.binary()), "item": pa.array(items, pa.string())}

    source = benchmark.select(F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("item"), F.col(text_col).alias("text"))
    return map_batches(source, "window binary, item string", cut).distinct()


def _search_block(df: DataFrame, pairs: list[tuple[bytes, str]]) -> DataFrame:
    """Add the spans and items that one block of windows finds to those found before."""
    shared = df.sparkSession.sparkContext.broadcast(pairs)

    def find(batch: pa.RecordBatch, searches: list[WordSearch]) -> dict:
        spans, items = [], []
        for text, old_spans, old_items in zip(as_bytes(batch.column("text")), batch.column("spans").to_pylist(), batch.column("items").to_pylist()):
            words = words_of(text)
            hit, ids = list(old_spans), set(old_items)
            for search in searches:
                for start, found in search.occurrences(words):
                    end = start + search.length
                    if hit and hit[-2] <= start <= hit[-1]:
                        hit[-1] = max(end, hit[-1])
                    else:
                        hit += (start, end)
                    ids.update(found)
            spans.append(hit)
            items.append(sorted(ids))
        return {n: batch.column(n) for n in batch.schema.names} | {"spans": pa.array(spans, pa.list_(pa.int64())), "items": pa.array(items, pa.list_(pa.string()))}

    return map_batches(df, df.schema, find, lambda: build_search(shared.value))


def search_windows(df: DataFrame, pairs: DataFrame, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Add ``spans`` (starts and ends of hit word runs, flat) and ``items`` (ids with an occurring window) to rows with ``text``."""
    out = df.withColumns({"spans": F.array().cast("array<bigint>"), "items": F.array().cast("array<string>")})
    rows = ((bytes(r["window"]), r["item"]) for r in pairs.toLocalIterator())
    block = list(islice(rows, block_rows))
    while block:
        out = _search_block(out, block)
        block = list(islice(rows, block_rows))
        if block:
            out = write_through(out, "windows")
    return out


def covered(spans: list[int]) -> int:
    """Positions inside any of the spans."""
    total, upto = 0, 0
    for start, end in sorted(zip(spans[::2], spans[1::2])):
        start = max(start, upto)
        if end > start:
            total, upto = total + end - start, end
    return total


def find_windows(docs: DataFrame, benchmark: DataFrame, size: int = WINDOW, id_col: str = "doc_id", text_col: str = "text",
                 block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Per document: id, n_words, n_hit, spans of hit word positions (merged, flat), items, contaminated."""
    source = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    found = search_windows(source, benchmark_windows(benchmark, size), block_rows)

    def count(batch: pa.RecordBatch) -> dict:
        hits = [covered(s) for s in batch.column("spans").to_pylist()]
        return {"id": batch.column("id"), "n_words": [len(words_of(t)) for t in as_bytes(batch.column("text"))], "n_hit": hits,
                "spans": batch.column("spans"), "items": batch.column("items"), "contaminated": [h > 0 for h in hits]}

    schema = f"id {source.schema['id'].dataType.simpleString()}, n_words long, n_hit long, spans array<bigint>, items array<string>, contaminated boolean"
    return map_batches(found, schema, count)


def decontaminate(docs: DataFrame, benchmark: DataFrame, size: int = WINDOW, text_col: str = "text", block_rows: int = BLOCK_ROWS) -> DataFrame:
    """The rows without any hit, with their own columns."""
    source = packed(docs, F.col(text_col).alias("text"))
    found = search_windows(source, benchmark_windows(benchmark, size), block_rows)
    return unpacked(found.where(F.size("spans") == 0))


def op5_benchmark_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_windows(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(F.col("id").alias("doc_id"), "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
                        F.sha2(F.concat_ws(",", F.array_sort("items")), 256).alias("items_sha256"), "contaminated")


_LOWERED = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_SPLIT = rf"regexp_extract_all({_LOWERED}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
OP5_SQL = f"""
WITH item AS (SELECT item_id, {_SPLIT} AS w FROM benchmark),
win AS (SELECT DISTINCT item_id, w[i + 1 : i + 10] AS win FROM (SELECT item_id, w, unnest(range(greatest(1, len(w) - 9))) AS i FROM item WHERE len(w) > 0)),
size AS (SELECT DISTINCT len(win) AS m FROM win),
doc AS (SELECT doc_id, {_SPLIT} AS w FROM documents),
pos AS (SELECT doc_id, m, i, w[i + 1 : i + m] AS win FROM (SELECT doc_id, w, m, unnest(range(len(w) - m + 1)) AS i FROM doc, size WHERE len(w) >= m)),
hit AS (SELECT doc_id, item_id, i, m FROM pos JOIN win USING (win)),
cov AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + m)) AS p FROM hit) GROUP BY doc_id),
its AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
        FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM hit) GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(n_items, 0) AS BIGINT) AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM doc LEFT JOIN cov USING (doc_id) LEFT JOIN its USING (doc_id)
"""
