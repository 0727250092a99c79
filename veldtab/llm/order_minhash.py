"""Order MinHash fingerprints: sketches that feel the order of a text, and so its edit distance.

The text's k-mers (eight bytes of UTF-8, four or two in texts of under 64 or 16 characters) get the number of their occurrence; a hash of (k-mer, occurrence) deals each into one of
``SKETCHES`` bins, and in every bin the ``TUPLE`` smallest are selected, put back into text order and hashed as a
tuple. The share of equal tuples of two fingerprints estimates their likeness. Bins with fewer k-mers than a tuple take what
they have; bins that both texts leave empty do not count.

Neighbours in id order: ids are cut into ranges of like size, each range also receives the first row of the next one,
and a window inside the range finds the next row. So no task holds the order of the whole table.

Null and empty texts have the fingerprint of no k-mers (all bins empty): likeness 1 to each other, 0 to other texts. A
text of one byte is one k-mer, filled up with a zero byte. Rows with equal ids follow each other in the order of
their text hashes; null ids come first. In a table of one row the next row
is the row itself. An empty table gives an empty result; extra columns are dropped.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from veldtab.llm.common import map_batches, table

#: (least characters of the text, bytes of a k-mer)
WIDTHS = ((64, 8), (16, 4), (0, 2))
SKETCHES = 64
TUPLE = 2
EMPTY = "----"
_M1, _M2, _M3 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def _mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit reaches every output bit."""
    x = (x ^ (x >> np.uint64(30))) * _M2
    x = (x ^ (x >> np.uint64(27))) * _M3
    return x ^ (x >> np.uint64(31))


def kmer_hashes(text: bytes) -> np.ndarray:
    """One 64-bit hash per k-mer in text order."""
    if not text:
        return np.empty(0, np.uint64)
    chars = len(text) if len(text) >= 4 * WIDTHS[0][0] else len(text.decode(errors="replace"))
    k = next(width for least, width in WIDTHS if chars >= least)
    raw = np.frombuffer(text + bytes(8), np.uint8)
    n = max(1, len(text) - k + 1)
    eights = np.lib.stride_tricks.as_strided(raw[:8].view("<u8"), (n,), (1,)).copy()
    return _mix((eights & np.uint64((1 << 8 * k) - 1)) + _M1)


def fingerprint(text: bytes, sketches: int = SKETCHES, size: int = TUPLE) -> str:
    """Four hexadecimal digits per bin; ``----`` for an empty bin. ``sketches`` is a power of two."""
    h = kmer_hashes(text)
    n = len(h)
    if not n:
        return EMPTY * sketches
    place_bits = np.uint64(max(1, n.bit_length()))
    places = np.arange(n, dtype=np.uint64)
    keyed = np.sort((h >> place_bits << place_bits) | places)
    kmer = keyed >> place_bits
    place = keyed & ((np.uint64(1) << place_bits) - np.uint64(1))
    start = np.concatenate(([True], kmer[1:] != kmer[:-1]))
    at = np.arange(n)
    occurrence = at - np.maximum.accumulate(np.where(start, at, 0))
    mixed = _mix(h[place] + (occurrence.astype(np.uint64) + np.uint64(1)) * _M1)
    bits = np.uint64(sketches.bit_length() - 1)
    # the highest bits name the bin; inside a bin the rest orders the k-mers
    few = 6 * size * sketches
    if n > 2 * few:
        rank = mixed << bits
        some = np.flatnonzero(rank < np.uint64(int(few / n * 2**64)))
        if np.bincount((mixed[some] >> np.uint64(64 - int(bits))).astype(np.int64), minlength=sketches).min() < size:
            some = np.arange(n)
        mixed, place = mixed[some], place[some]
    order = np.argsort(mixed)
    mixed, place = mixed[order], place[order].astype(np.int64)
    bins = (mixed >> np.uint64(64 - int(bits))).astype(np.int64)
    first = np.searchsorted(bins, np.arange(sketches + 1))
    have = np.diff(first)
    chosen = first[:-1, None] + np.arange(size)[None, :]
    present = np.arange(size)[None, :] < have[:, None]
    chosen = np.minimum(chosen, len(mixed) - 1)
    where = np.where(present, place[chosen], np.iinfo(np.int64).max)
    in_text = np.argsort(where, axis=1, kind="stable")
    value = np.where(np.take_along_axis(present, in_text, 1), h[np.minimum(np.take_along_axis(where, in_text, 1), n - 1)], np.uint64(0))
    out = np.full(sketches, 0x51ED270B, np.uint64)
    for column in range(size):
        out = _mix((out * _M1) ^ value[:, column])
    digits = (out >> np.uint64(48)).astype(">u2").tobytes().hex()
    if have.all():
        return digits
    return "".join(digits[4 * i:4 * i + 4] if have[i] else EMPTY for i in range(sketches))


def likeness(a: str, b: str) -> float:
    """Share of equal tuples among the bins that are not empty in both."""
    x = np.frombuffer(a.encode(), "<u4")
    y = np.frombuffer(b.encode(), "<u4")
    empty = np.frombuffer(EMPTY.encode(), "<u4")[0]
    used = (x != empty) | (y != empty)
    n = int(used.sum())
    return 1.0 if n == 0 else float(((x == y) & used).sum() / n)


def edited(text: str, following: str) -> str:
    """The last quarter of the characters replaced by as many first characters of the following text (or all of it)."""
    n = len(text) // 4
    return text[:len(text) - n] + following[:n] if n else text


def with_next(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", ranges: int | None = None) -> DataFrame:
    """(doc_id, text, next_text) for every row, in ascending id within a range; the last row is followed by the first."""
    spark = docs.sparkSession
    source = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    ranges = ranges or 8 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    cuts = sorted(set(source.where("doc_id IS NOT NULL").approxQuantile("doc_id", [i / ranges for i in range(1, ranges)], 0.25 / ranges)))
    keyed = source.withColumn("key", F.coalesce(F.col("doc_id").cast("double"), F.lit(float("-inf"))))
    if cuts:
        keyed = Bucketizer(splits=[float("-inf"), *cuts, float("inf")], inputCol="key", outputCol="range").transform(keyed)
    else:
        keyed = keyed.withColumn("range", F.lit(0.0))
    keyed = keyed.select("doc_id", "text", F.col("range").cast("int").alias("range"), F.xxhash64("text").alias("tie"))
    # one row per range: its first row, which is also the row after the last one of the range before
    heads = keyed.groupBy("range").agg(F.min(F.struct("doc_id", "tie")).alias("head")).orderBy("range").collect()
    first = {h["range"]: h["head"] for h in heads}
    before = {r: heads[i - 1]["range"] for i, r in enumerate(h["range"] for h in heads)}
    listed = lambda pick, kind: F.array(*[F.lit(pick(r) if r in first else None).cast(kind) for r in range(len(cuts) + 1)])
    head = (F.get(listed(lambda r: first[r]["doc_id"], "long"), "range").eqNullSafe(F.col("doc_id"))
            & (F.get(listed(lambda r: first[r]["tie"], "long"), "range") == F.col("tie")))
    own = F.struct(F.col("range"), F.lit(False).alias("guest"))
    guest = F.struct(F.get(listed(lambda r: before[r], "int"), "range").alias("range"), F.lit(True).alias("guest"))
    placed = keyed.select("doc_id", "text", "tie", F.inline(F.when(head, F.array(own, guest)).otherwise(F.array(own))))
    order = Window.partitionBy("range").orderBy("guest", "doc_id", "tie")
    return placed.withColumn("next_text", F.lead("text").over(order)).where("NOT guest").select("doc_id", "text", "next_text")


def compare_edits(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Fingerprints of every text and of its edited text, and their likenesses (see the contract of the query)."""
    def run(batch: pa.RecordBatch) -> dict:
        out = {n: [] for n in ("n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next")}
        known_text, known_print = None, ""
        for text, following in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
            own = known_print if text == known_text else fingerprint(text.encode())
            changed = edited(text, following)
            encoded = changed.encode()
            other = own if changed == text else fingerprint(encoded)
            known_text, known_print = following, own if following == text else fingerprint(following.encode())
            for name, value in zip(out, (len(text), hashlib.sha256(encoded).hexdigest(), own, other, likeness(own, other), likeness(own, known_print))):
                out[name].append(value)
        return {"doc_id": batch.column(0)} | out

    schema = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"
    return map_batches(with_next(docs, id_col, text_col), schema, run)


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, fingerprint) of every text; no shuffle."""
    source = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("binary").alias("text"))
    return map_batches(source, f"doc_id {source.schema['doc_id'].dataType.simpleString()}, fingerprint string",
                       lambda batch: {"doc_id": batch.column(0), "fingerprint": [fingerprint(t or b"") for t in batch.column(1).to_pylist()]})


def op10_order_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return compare_edits(table(spark, sf_dir, "documents"))
