"""SimHash near-duplicates by meeting in the middle.

A fingerprint is the majority vote over the XXH64 hashes (seed 42) of a text's word shingles. Two fingerprints that differ in at
most ``distance`` bits have a common variant within half that distance of each. Every distinct fingerprint
therefore emits all its variants within the radius, and fingerprints that meet in a variant are linked.

The shuffle carries a variant by its upper half only: 529 rows of (upper half, fingerprint) instead of 2,081 at radius 2. The
receiving task spells out the lower halves with the flips that are left and matches whole variants. All members of
one variant are within the full distance of each other, so linking each to the smallest loses no component and never
lists all pairs; links are compared bit by bit all the same, and each task hands on a spanning forest of its links.

Null and blank texts have fingerprint zero and are linked like any other. Repeated rows and ids share a component.
Very long texts are voted on in pieces. An empty table gives an empty result. Extra columns are dropped by ``near_duplicates`` and kept, whatever
their names, by ``drop_near_duplicates``; there rows without an id take part and come last.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from veldtab.llm.common import LOWER_ASCII, ROW, as_bytes, connected_components, map_batches, packed, table
from veldtab.sources.storage import write_through

SHINGLE = 4
DISTANCE = 4
SEED = 42
#: Variants spelled out at once by a task.
VARIANTS_AT_ONCE = 4_000_000
ROWS_AT_ONCE = 250_000


def fingerprint(text: bytes, shingle: int = SHINGLE) -> int:
    """Unsigned 64-bit SimHash of a text."""
    words = text.translate(LOWER_ASCII).split()
    if not words:
        return 0
    joined = b" ".join(words)
    starts = np.concatenate(([0], np.flatnonzero(np.frombuffer(joined, np.uint8) == 32) + 1))
    ends = np.append(starts[1:] - 1, len(joined))
    width = min(shingle, len(words))
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(joined[a:b], SEED) for a, b in zip(starts.tolist(), ends[width - 1:].tolist())], ">u8")
    votes = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 16_384):
        part = hashes[at:at + 16_384]
        votes += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(votes * 2 > len(hashes)).tobytes(), "big")


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE) -> DataFrame:
    """(doc_id, fp): fp holds the 64 bits as a signed long."""
    def run(batch: pa.RecordBatch) -> dict:
        values = np.array([fingerprint(t, shingle) for t in as_bytes(batch.column(1))], np.uint64)
        return {"doc_id": batch.column(0), "fp": pa.array(values.view(np.int64))}

    source = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    return map_batches(source, f"doc_id {source.schema['doc_id'].dataType.simpleString()}, fp long", run)


def _masks(bits: int, radius: int) -> np.ndarray:
    """All masks with at most ``radius`` of ``bits`` bits, fewest first."""
    return np.array([sum(1 << b for b in c) for k in range(radius + 1) for c in combinations(range(bits), k)], np.uint64)


def _forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A spanning forest of the links, by union-find."""
    nodes, flat = np.unique(np.concatenate((a, b)), return_inverse=True)
    parent = list(range(len(nodes)))
    keep = []
    half = len(a)
    for k, (x, y) in enumerate(zip(flat[:half].tolist(), flat[half:].tolist())):
        while parent[x] != x:
            parent[x] = x = parent[parent[x]]
        while parent[y] != y:
            parent[y] = y = parent[parent[y]]
        if x != y:
            parent[max(x, y)] = min(x, y)
            keep.append(k)
    return a[keep], b[keep]


def _meet(upper: np.ndarray, fps: np.ndarray, radius: int, distance: int) -> tuple[np.ndarray, np.ndarray]:
    """Links among rows (upper half of a variant, fingerprint): each fingerprint to the smallest in its variant."""
    flips = np.bitwise_count((fps >> np.uint64(32)) ^ upper)
    masks = {left: _masks(32, left) for left in range(radius + 1)}
    total = sum(int((flips == radius - left).sum()) * len(m) for left, m in masks.items())
    parts = max(1, -(-total // VARIANTS_AT_ONCE))
    out_a, out_b = [], []
    for part in range(parts):
        keys, owners = [], []
        for left, mask in masks.items():
            rows = flips == radius - left
            up, fp = upper[rows], fps[rows]
            step = max(1, VARIANTS_AT_ONCE // len(mask))
            for at in range(0, len(fp), step):
                variant = ((up[at:at + step] << np.uint64(32)) | (fp[at:at + step] & np.uint64(0xFFFFFFFF)))[:, None] ^ mask[None, :]
                owner = np.broadcast_to(fp[at:at + step][:, None], variant.shape)
                variant, owner = variant.ravel(), owner.ravel()
                if parts > 1:
                    mine = (variant * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(40)) % np.uint64(parts) == part
                    variant, owner = variant[mine], owner[mine]
                keys.append(variant)
                owners.append(owner)
        key, owner = np.concatenate(keys), np.concatenate(owners)
        order = np.argsort(key)
        key = key[order]
        same = key[1:] == key[:-1]
        if not same.any():
            continue
        member = np.concatenate(([False], same)) | np.concatenate((same, [False]))
        key, owner = key[member], owner[order[member]]
        first = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1])))
        lowest = np.minimum.reduceat(owner, first)
        low = np.repeat(lowest, np.diff(np.append(first, len(key))))
        link = (owner != low) & (np.bitwise_count(owner ^ low) <= distance)
        pairs = np.unique(np.stack((owner[link], low[link]), axis=1), axis=0) if link.any() else np.empty((0, 2), np.uint64)
        out_a.append(pairs[:, 0])
        out_b.append(pairs[:, 1])
    if not out_a:
        return np.empty(0, np.uint64), np.empty(0, np.uint64)
    return np.concatenate(out_a), np.concatenate(out_b)


def links(fps: DataFrame, distance: int = DISTANCE) -> DataFrame:
    """(u, v) links of distinct fingerprints within ``distance``, enough of them to keep every component whole."""
    radius = -(-distance // 2)
    upper_masks = _masks(32, radius)

    parts = int(fps.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        uppers, owners, rows, found = [], [], 0, []

        def cut(last: bool) -> None:
            """Match all whole runs of equal upper halves; keep the run that may go on."""
            nonlocal uppers, owners, rows
            up, fp = np.concatenate(uppers), np.concatenate(owners)
            end = len(up) if last else int(np.searchsorted(up, up[-1]))
            if end:
                found.append(_meet(up[:end], fp[:end], radius, distance))
            uppers, owners, rows = [up[end:]], [fp[end:]], len(up) - end

        limit = ROWS_AT_ONCE
        for batch in batches:
            uppers.append(batch.column(0).to_numpy().view(np.uint64))
            owners.append(batch.column(1).to_numpy().view(np.uint64))
            rows += batch.num_rows
            if rows >= limit:
                cut(False)
                limit = max(ROWS_AT_ONCE, 2 * rows)
                if len(found) > 50:
                    found[:] = [_forest(np.concatenate([f[0] for f in found]), np.concatenate([f[1] for f in found]))]
        if rows:
            cut(True)
        if found:
            a, b = _forest(np.concatenate([f[0] for f in found]), np.concatenate([f[1] for f in found]))
            yield pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], ["u", "v"])

    # a row in the shuffle is a fingerprint and the number of a mask; both ends know the masks
    upper = F.shiftrightunsigned("fp", 32).bitwiseXOR(F.get(F.array(*[F.lit(m) for m in _masks(32, radius).tolist()]), "mask"))
    rows = fps.select("fp").distinct().repartition(parts).select(F.explode(F.sequence(F.lit(0), F.lit(len(upper_masks) - 1))).alias("mask"), "fp")
    dealt = rows.repartition(parts, upper).select(upper.alias("upper"), "fp")
    return dealt.sortWithinPartitions("upper").mapInArrow(meet, "u long, v long")


def components(known: DataFrame, least: Column, distance: int = DISTANCE) -> DataFrame:
    """(fp, least): for each fingerprint of ``known`` the smallest value of ``least`` in its component."""
    classes = known.groupBy("fp").agg(F.min(least).alias("least"))
    groups = connected_components(links(known, distance), "simhash-links")
    rooted = classes.join(groups, classes["fp"] == groups["node"], "left").select("fp", F.coalesce("component", "fp").alias("root"), "least")
    roots = rooted.groupBy("root").agg(F.min("least").alias("least"))
    return rooted.drop("least").join(roots, "root").select("fp", "least")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE, distance: int = DISTANCE) -> DataFrame:
    """(doc_id, fp, component_id): the smallest id reachable over links of at most ``distance`` differing bits."""
    known = write_through(fingerprints(docs, id_col, text_col, shingle), "simhash")
    named = components(known, F.col("doc_id"), distance).select("fp", F.col("least").alias("component_id"))
    return known.join(named, "fp").select("doc_id", "fp", "component_id")


def drop_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE, distance: int = DISTANCE) -> DataFrame:
    """One row of each component: that of the smallest id (nulls last), then of the smallest hash of id and text; rows equal in both are one."""
    name = F.md5(F.concat(F.coalesce(F.col(id_col).cast("string"), F.lit("")), F.lit("\n"), F.coalesce(F.col(text_col), F.lit(""))))
    keyed = packed(docs, F.col(id_col).alias("id"), name.alias("name"), F.col(text_col).alias("text"))
    rows = keyed.select(F.struct("id", "name").alias("key"), "text")
    known = write_through(fingerprints(rows, "key", "text", shingle).select(F.col("doc_id.id").alias("id"), F.col("doc_id.name").alias("name"), "fp"), "simhash")
    order = F.struct(F.col("id").isNull().alias("none"), F.col("id"), F.col("name"))
    keep = components(known, order, distance).select(F.col("least.name").alias("name")).distinct()
    # equal rows are folded on the map side; the join finds them dealt by the same key
    return keyed.select(ROW, "name").dropDuplicates(["name"]).join(keep, "name", "left_semi").select(f"{ROW}.*")


def op6_simhash_components(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
