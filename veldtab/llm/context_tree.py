"""Language-model scores by context-tree weighting over bytes.

A byte is coded as eight binary decisions, each at a node of a binary tree over the bytes. Every decision has a context tree of
its own: the contexts are the last 0 to ``DEPTH`` bytes, every context holds the Krichevsky-Trofimov estimate of its
counts, and all depths are mixed with weights one half, from the deepest contexts up. The score of a text is the log10 probability of its
lower-cased bytes and an end mark, given the counts of the training rows; it is a code length, and a word
unigram model with the same training rows is computed beside it.

How it is spread out:
1. A pass over the texts in blocks counts contexts (as six-byte grams) and words. Grams are dealt into parts that hold whole
   depth-3 contexts, words into parts by their checksum; a block sends each part one packed row of its distinct grams or words,
   with the counts from its training rows.
2. Each part adds up the rows of its blocks as they arrive; it holds its distinct grams or words, not the blocks' lists. Trees are
   weighted from depth 5 to 3 inside parts; depth 2 is a table by two bytes and tree node, of which every part gets the nodes it
   has; depths 1 and 0 are at most 65,280 rows and are finished on the driver.
3. Each part answers each packed row with the log-probabilities (as 32-bit floats) or counts of what the row asked for, and the
   answers meet their block, where texts are scored. No model is broadcast or held whole anywhere.

There is a part for each ``PART_BYTES`` of text, up to 65,536 parts; a single depth-3 context has at most 256**3 grams. Blocks are
numbered by the task and the order within it, twice, so ``docs`` has to be read alike twice, like a table in files; pass
``materialise=True`` for anything else. A block that meets a gram it did not ask for raises an error.

Null texts are empty: they hold the end mark only. Texts are never cut; one text is never spread over two blocks. Rows with a null
id are training rows. Repeated rows count each time and get equal scores. With no training row every decision is one half, and
the base probability of each token is 1. An empty table gives an empty result; extra columns are dropped.
"""

from __future__ import annotations

import math
import struct
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from veldtab.llm.common import LOWER_ASCII, as_bytes, id_bucket, table
from veldtab.sources.storage import write_through

DEPTH = 5
#: Grams are dealt into parts by so many last context bytes.
GROUPED = 3
PART_BYTES = 16 << 20
MOST_PARTS = 1 << 16
#: Stands for the end of a text, and before its first byte; never part of UTF-8.
END = b"\xff"
BLOCK_BYTES = 12 << 20
CHUNK_BYTES = 1 << 20
ADDED = 0.1


def grams(texts: list[bytes]) -> np.ndarray:
    """For each byte and end mark of the texts in turn: the DEPTH bytes before it and itself, as one number."""
    data = b"".join(END * DEPTH + t + END for t in texts) + bytes(8)
    lengths = np.fromiter(map(len, texts), np.int64, len(texts))
    starts = np.cumsum(lengths + DEPTH + 1) - (lengths + DEPTH + 1)
    at = np.frombuffer(data, np.uint8)
    n = len(data) - 8 - DEPTH
    windows = np.lib.stride_tricks.as_strided(at[:8].view(">u8"), (n,), (1,))
    inside = np.ones(n, bool)
    between = ((starts + lengths + 1)[:, None] + np.arange(DEPTH)[None, :]).ravel()
    inside[between[between < n]] = False
    found = windows[inside].astype(np.uint64)
    found >>= np.uint64(8 * (7 - DEPTH))
    return found


def _chunks(lengths: list[int]) -> Iterator[tuple[int, int]]:
    """Ranges of texts of about CHUNK_BYTES by their lengths; a longer text is a range of its own."""
    start, size = 0, 0
    for i, n in enumerate(lengths):
        if size and size + n > CHUNK_BYTES:
            yield start, i
            start, size = i, 0
        size += n + 1
    if start < len(lengths):
        yield start, len(lengths)


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, list, list[bytes], list[bool]]]:
    """(block, ids, lower-cased texts, training flags) in the order of the rows."""
    task, number = TaskContext.get().partitionId(), 0
    for batch in batches:
        ids, train = batch.column(0).to_pylist(), batch.column(2).to_pylist()
        texts = [t.translate(LOWER_ASCII) for at in range(0, batch.num_rows, 500) for t in as_bytes(batch.column(1).slice(at, 500))]
        start, size = 0, 0
        for i, t in enumerate(texts):
            if size and size + len(t) > BLOCK_BYTES:
                yield task << 24 | number, ids[start:i], texts[start:i], train[start:i]
                start, size, number = i, 0, number + 1
            size += len(t)
        if start < len(texts):
            yield task << 24 | number, ids[start:], texts[start:], train[start:]
            number += 1


def squeeze(data: bytes) -> bytes:
    return struct.pack("<Q", len(data)) + pa.Codec("zstd", compression_level=1).compress(data, asbytes=True)


def unsqueeze(packed: bytes) -> bytes:
    return pa.Codec("zstd").decompress(packed[8:], struct.unpack_from("<Q", packed)[0], asbytes=True)


def pack(values: np.ndarray) -> bytes:
    """Non-negative numbers, compressed byte by byte: first the low bytes of all, then the next ones."""
    width = max(1, (int(values.max(initial=0)).bit_length() + 7) // 8)
    return bytes([width]) + squeeze(values.astype("<i8").view(np.uint8).reshape(-1, 8)[:, :width].T.tobytes())


def unpack(packed: bytes) -> np.ndarray:
    width, data = packed[0], np.frombuffer(unsqueeze(packed[1:]), np.uint8)
    out = np.zeros((len(data) // width, 8), np.uint8)
    out[:, :width] = data.reshape(width, -1).T
    return out.view("<i8").ravel()


def pack_rising(keys: np.ndarray) -> bytes:
    return pack(np.diff(keys, prepend=0))


def unpack_rising(packed: bytes) -> np.ndarray:
    return np.cumsum(unpack(packed))


def pack_words(words: list[bytes]) -> bytes:
    """Words hold no white space, so a space parts them; the end is the empty word."""
    return squeeze(b" ".join(words))


def unpack_words(packed: bytes) -> list[bytes]:
    return unsqueeze(packed).split(b" ")


def as_keys(gram: np.ndarray) -> np.ndarray:
    """Grams with the bytes of the depth-3 context in front, so that sorted keys stand context by context."""
    gram = gram.astype(np.int64)
    return (gram >> 8 & 0xFFFFFF) << 24 | gram >> 32 << 8 | gram & 0xFF


def as_grams(key: np.ndarray) -> np.ndarray:
    return (key >> 8 & 0xFFFF) << 32 | key >> 24 << 8 | key & 0xFF


class GramCounts:
    """Sums of counts by gram; what is added is merged once there is as much of it as a few chunks give."""

    def __init__(self):
        self.keys, self.counts, self.waiting = [np.empty(0, np.uint64)], [np.empty(0, np.int64)], 0

    def add(self, keys: np.ndarray, counts: np.ndarray) -> None:
        self.keys.append(keys)
        self.counts.append(counts)
        self.waiting += len(keys)
        if self.waiting > 400_000:
            self.merged()

    def merged(self) -> tuple[np.ndarray, np.ndarray]:
        key, count = np.concatenate(self.keys), np.concatenate(self.counts)
        order = np.argsort(key)
        key, count = key[order], count[order]
        first = np.flatnonzero(np.concatenate((np.ones(min(1, len(key)), bool), key[1:] != key[:-1])))
        self.keys, self.counts, self.waiting = [key[first]], [np.add.reduceat(count, first) if len(first) else count], 0
        return self.keys[0], self.counts[0]


def _asked(parts: int):
    """(kind, part, block, keys, counts): distinct grams and words (empty: the end) of every block by part, counted in training rows."""
    names = ["kind", "part", "block", "keys", "counts"]

    def dealt(key: np.ndarray, n: np.ndarray) -> Iterator[tuple[int, bytes, bytes]]:
        part = ((key >> 24).view(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(32)).astype(np.int64) % parts
        order = np.lexsort((key, part))
        key, part, n = key[order], part[order], n[order]
        first = np.flatnonzero(np.diff(part, prepend=-1))
        for a, b in zip(first, np.append(first[1:], len(key))):
            yield int(part[a]), pack_rising(key[a:b]), pack(n[a:b])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block, _, texts, train in _blocks(batches):
            words: Counter = Counter()
            others: set = set()
            found = GramCounts()
            for flag in (True, False):
                chosen = [t for t, f in zip(texts, train) if f == flag]
                for a, b in _chunks(list(map(len, chosen))):
                    unique, n = np.unique(grams(chosen[a:b]), return_counts=True)
                    found.add(unique, n * flag)
                for t in chosen:
                    (words if flag else others).update(t.split())
                if chosen:
                    (words if flag else others).update([b""] * (len(chosen) if flag else 1))
            by_part: dict[int, list[bytes]] = {}
            for word in sorted(others | words.keys()):
                by_part.setdefault(zlib.crc32(word) % parts, []).append(word)
            rows = [("word", part, block, pack_words(held), pack(np.array([words[w] for w in held]))) for part, held in by_part.items()]
            del words, others, by_part
            gram, n = found.merged()
            rows += [("gram", part, block, keys, counts) for part, keys, counts in dealt(as_keys(gram), n)]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows)], names)

    return run


def _runs(batches: Iterator[pa.RecordBatch], *columns: str) -> Iterator[tuple[tuple, pa.RecordBatch]]:
    """Stretches of rows that are alike in some columns; a stretch over several batches comes in pieces."""
    for batch in batches:
        if not batch.num_rows:
            continue
        change = np.zeros(batch.num_rows, bool)
        change[0] = True
        for c in columns:
            code = batch.column(c).dictionary_encode().indices.to_numpy(zero_copy_only=False)
            change[1:] |= code[1:] != code[:-1]
        first = np.flatnonzero(change)
        for a, b in zip(first, np.append(first[1:], batch.num_rows)):
            yield tuple(batch.column(c)[int(a)].as_py() for c in columns), batch.slice(a, b - a)


def _summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(kind, part, keys, counts, n, seen): every part's distinct grams or words with their counts over all blocks, from rows sorted by part."""

    def closed(at: tuple, sums) -> pa.RecordBatch:
        if at[0] == "gram":
            key, n = sums.merged()
            keys, counts = pack_rising(key.astype(np.int64)), pack(n)
        else:
            held = sorted(sums)
            n = np.array([sums[w] for w in held])
            keys, counts = pack_words(held), pack(n)
        return pa.RecordBatch.from_arrays([pa.array([c]) for c in (*at, keys, counts, int(n.sum()), int((n > 0).sum()))], ["kind", "part", "keys", "counts", "n", "seen"])

    at, sums = None, None
    for here, rows in _runs(batches, "kind", "part"):
        if here != at:
            if at:
                yield closed(at, sums)
            at, sums = here, GramCounts() if here[0] == "gram" else {}
        for keys, counts in zip(rows.column("keys"), rows.column("counts")):
            n = unpack(counts.as_py())
            if at[0] == "gram":
                sums.add(unpack_rising(keys.as_py()).astype(np.uint64), n)
            else:
                for word, c in zip(unpack_words(keys.as_py()), n.tolist()):
                    sums[word] = sums.get(word, 0) + c
    if at:
        yield closed(at, sums)


_LGAMMA = np.frompyfunc(math.lgamma, 1, 1)
_TABLE = _LGAMMA(np.concatenate(([0.5], np.arange(1, 4096) / 2))).astype(float)


def _log_gamma(x: np.ndarray) -> np.ndarray:
    """Logarithm of the gamma function at positive multiples of one half: a table, and Stirling's series beyond."""
    big = np.maximum(x, 1000.0)
    series = (big - 0.5) * np.log(big) - big + 0.5 * math.log(2 * math.pi) + 1 / (12 * big) - 1 / (360 * big**3)
    return np.where(x < 1000.0, _TABLE[np.minimum(x * 2, 2000).astype(np.int64)], series)


def log_kt(n0: np.ndarray, n1: np.ndarray) -> np.ndarray:
    """Natural logarithm of the Krichevsky-Trofimov probability of a string with these counts."""
    n0, n1 = n0.astype(float), n1.astype(float)
    return _log_gamma(n0 + 0.5) + _log_gamma(n1 + 0.5) - _log_gamma(n0 + n1 + 1) - math.log(math.pi)


def _mixed(own: np.ndarray, below: np.ndarray) -> np.ndarray:
    """Logarithm of one half of each."""
    return np.logaddexp(own, below) - math.log(2)


def _blend(own: np.ndarray, below: np.ndarray, kt: np.ndarray, deeper: np.ndarray) -> np.ndarray:
    """Predictive probability: the estimate of a node and what its deeper contexts say, by their weights so far."""
    share = 1 / (1 + np.exp(np.clip(below - own, -700, 700)))
    return share * kt + (1 - share) * deeper


class Level:
    """The nodes of one depth for one binary decision of each gram: counts and estimates per node, and the node of each row."""

    def __init__(self, ids: np.ndarray, bit: np.ndarray, n: np.ndarray):
        self.ids, self.row = np.unique(ids, return_inverse=True)
        size = len(self.ids)
        self.n1 = np.bincount(self.row, weights=n * bit, minlength=size)
        self.n0 = np.bincount(self.row, weights=n * (1 - bit), minlength=size)
        self.own = log_kt(self.n0, self.n1)
        self.below = np.zeros(size)
        self.total = self.own

    def over(self, deeper: "Level") -> "Level":
        """Weigh this level with the level below it."""
        parent = np.empty(len(deeper.ids), np.int64)
        parent[deeper.row] = self.row
        self.below = np.bincount(parent, weights=deeper.total, minlength=len(self.ids))
        self.total = _mixed(self.own, self.below)
        return self

    def kt(self, bit: np.ndarray) -> np.ndarray:
        n0, n1 = self.n0[self.row], self.n1[self.row]
        return (np.where(bit == 1, n1, n0) + 0.5) / (n0 + n1 + 1)


def _decisions(gram: np.ndarray, n: np.ndarray, depths: list[int]) -> Iterator[tuple[int, np.ndarray, np.ndarray, list[Level]]]:
    """For each of the eight decisions: its number, tree node and bit of each gram, and the levels of the given depths, deepest first."""
    byte, context = (gram & 0xFF).astype(np.int64), gram >> 8
    for k in range(8):
        node, bit = (1 << k) | (byte >> (8 - k)), (byte >> (7 - k)) & 1
        levels: list[Level] = []
        for depth in depths:
            level = Level(((context & ((1 << 8 * depth) - 1)) << 8) | node, bit, n)
            levels.append(level.over(levels[-1]) if levels else level)
        yield k, node, bit, levels


def _part_nodes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(part, pair, node, n0, n1, total): depth-3 nodes of each part, added up by their last two bytes."""
    for batch in batches:
        for part, keys, counts in zip(*(batch.column(c) for c in ("part", "keys", "counts"))):
            gram = as_grams(unpack_rising(keys.as_py()))
            for _, _, _, levels in _decisions(gram, unpack(counts.as_py()), list(range(DEPTH, GROUPED - 1, -1))):
                top = levels[-1]
                ids, row = np.unique(top.ids & 0xFFFFFF, return_inverse=True)
                sums = [np.bincount(row, weights=v, minlength=len(ids)) for v in (top.n0, top.n1, top.total)]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in (np.full(len(ids), part.as_py()), ids >> 8, ids & 0xFF, *sums)], ["part", "pair", "node", "n0", "n1", "total"])


def _values(gram: np.ndarray, n: np.ndarray, at: np.ndarray, a0: np.ndarray, a1: np.ndarray, b: np.ndarray) -> np.ndarray:
    """log10 probability of each gram's last byte given those before: depth 3 and deeper from the counts, the rest as ``a + b p`` by ``at`` (pair, tree node)."""
    order = np.argsort(at)
    at, a0, a1, b = at[order], a0[order], a1[order], b[order]
    pair, value = gram >> 8 & 0xFFFF, np.zeros(len(gram))
    for _, node, bit, levels in _decisions(gram, n, list(range(DEPTH, GROUPED - 1, -1))):
        p = levels[0].kt(bit)
        for level in levels[1:]:
            p = _blend(level.own[level.row], level.below[level.row], level.kt(bit), p)
        place = np.searchsorted(at, pair << 8 | node)
        value += np.log10(np.where(bit == 1, a1[place], a0[place]) + b[place] * p)
    return value


def _answered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(block, kind, keys, answers) for what the blocks asked, from rows sorted by part and step: sums, upper nodes, blocks' rows."""
    sums, upper, table_ = None, [], None
    for (kind, _, step), rows in _runs(batches, "kind", "part", "step"):
        if step == 0:
            sums, upper, table_ = (rows.column("keys")[0].as_py(), unpack(rows.column("counts")[0].as_py())), [], None
        elif step == 1:
            upper.append([rows.column(c).to_numpy() for c in ("at", "a0", "a1", "b")])
        elif kind == "gram":
            if table_ is None:
                key = unpack_rising(sums[0])
                table_ = key, _values(as_grams(key), sums[1], *map(np.concatenate, zip(*upper))).astype(np.float32).view(np.uint32)
            asked = (unpack_rising(k.as_py()) for k in rows.column("keys"))
            answers = [pack(table_[1][np.searchsorted(table_[0], key)]) for key in asked]
        else:
            if table_ is None:
                table_ = dict(zip(unpack_words(sums[0]), sums[1].tolist()))
            answers = [pack(np.array([table_[w] for w in unpack_words(k.as_py())])) for k in rows.column("keys")]
        if step == 2:
            yield pa.RecordBatch.from_arrays([rows.column("block"), rows.column("kind"), rows.column("keys"), pa.array(answers)], ["block", "kind", "keys", "answers"])


class Nodes:
    """Nodes of one depth with what is below them: how much of a prediction is their own, and how much is left to deeper contexts."""

    def __init__(self, n0: np.ndarray, n1: np.ndarray, below: np.ndarray):
        self.n0, self.n1, self.below = n0, n1, below
        self.own = log_kt(n0, n1)
        self.total = _mixed(self.own, below)
        self.share = 1 / (1 + np.exp(np.clip(below - self.own, -700, 700)))

    def add(self, at, bit: int, deeper: np.ndarray) -> np.ndarray:
        n0, n1 = self.n0[at], self.n1[at]
        share = self.share[at]
        return share * (((n1 if bit else n0) + 0.5) / (n0 + n1 + 1)) + (1 - share) * deeper


class TopLevels:
    """Depths 1 and 0, dense: by last byte and tree node, and by tree node."""

    def __init__(self, last: np.ndarray, node: np.ndarray, n0: np.ndarray, n1: np.ndarray, below: np.ndarray):
        tables = np.zeros((3, 256, 256))
        for table_, value in zip(tables, (n0, n1, below)):
            table_[last, node] = value
        self.one = Nodes(*tables)
        self.root = Nodes(tables[0].sum(axis=0), tables[1].sum(axis=0), self.one.total.sum(axis=0))


def upper_nodes(sums: DataFrame) -> DataFrame:
    """(part, at, a0, a1, b): what turns a probability at depth 3 into the mixed one, for the pairs of last bytes and tree nodes of every part."""
    nodes = write_through(sums.where("kind = 'gram'").mapInArrow(_part_nodes, "part long, pair long, node long, n0 double, n1 double, total double"), "context-tree-nodes")
    pairs = write_through(nodes.groupBy("pair", "node").agg(*[F.sum(c).alias(c) for c in ("n0", "n1", "total")]), "context-tree-pairs")

    def close(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pair, node, n0, n1, below = (c.to_numpy() for c in batch.columns)
            yield pa.RecordBatch.from_arrays([pa.array(pair & 0xFF), pa.array(node), pa.array(n0), pa.array(n1), pa.array(Nodes(n0, n1, below).total)], ["last", "node", "n0", "n1", "total"])

    ones = pairs.select("pair", "node", "n0", "n1", "total").mapInArrow(close, "last long, node long, n0 double, n1 double, total double")
    top = ones.groupBy("last", "node").agg(*[F.sum(c).alias(c) for c in ("n0", "n1", "total")]).toArrow()
    shared = sums.sparkSession.sparkContext.broadcast(TopLevels(*[top[c].to_numpy() for c in ("last", "node", "n0", "n1", "total")]))

    def linear(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        top = shared.value
        for batch in batches:
            pair, node, n0, n1, below = (c.to_numpy() for c in batch.columns)
            two, last, every = Nodes(n0, n1, below), pair & 0xFF, slice(None)
            a = [top.root.add(node, bit, top.one.add((last, node), bit, two.add(every, bit, np.zeros(len(node))))) for bit in (0, 1)]
            b = (1 - top.root.share[node]) * (1 - top.one.share[last, node]) * (1 - two.share)
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in (pair, node, *a, b)], ["pair", "node", "a0", "a1", "b"])

    upper = pairs.select("pair", "node", "n0", "n1", "total").mapInArrow(linear, "pair long, node long, a0 double, a1 double, b double")
    return nodes.select("part", "pair", "node").join(upper, ["pair", "node"]).select("part", (F.shiftleft("pair", 8) + F.col("node")).alias("at"), "a0", "a1", "b")


class GramTable:
    """Values of grams: a table of slots by hash, and a search among the few grams whose slot another one has."""

    def __init__(self, gram: np.ndarray, value: np.ndarray):
        order = np.argsort(gram)
        self.gram, self.value = gram[order].astype(np.int64), value[order]
        self.shift = np.uint64(64 - max(4, (2 * len(gram)).bit_length()))
        self.slots = np.zeros(1 << (64 - int(self.shift)), np.int32)
        self.slots[self.slot(self.gram)] = np.arange(len(gram), dtype=np.int32)

    def slot(self, gram: np.ndarray) -> np.ndarray:
        return (gram.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> self.shift).view(np.int64)

    def values(self, gram: np.ndarray) -> np.ndarray:
        place = self.slots[self.slot(gram)]
        other = np.flatnonzero(self.gram[place] != gram)
        place[other] = np.minimum(np.searchsorted(self.gram, gram[other]), len(self.gram) - 1)
        if not (self.gram[place[other]] == gram[other]).all():
            raise RuntimeError("docs was not read alike twice: pass materialise=True")
        return self.value[place]


def score_texts(docs: DataFrame, training: Column, id_col: str = "doc_id", text_col: str = "text", materialise: bool = False) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score) of every row; rows that meet ``training`` are learned from."""
    source = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"), F.coalesce(training, F.lit(True)).alias("train"))
    if materialise:
        source = write_through(source, "context-tree-texts")
    id_type = source.schema["doc_id"].dataType.simpleString()
    held = source.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = min(MOST_PARTS, 1 + held // PART_BYTES)
    asked = write_through(source.mapInArrow(_asked(parts), "kind string, part long, block long, keys binary, counts binary"), "context-tree-asked")
    by_part = asked.select("kind", "part", "keys", "counts").repartition(parts, "kind", "part").sortWithinPartitions("kind", "part")
    sums = write_through(by_part.mapInArrow(_summed, "kind string, part long, keys binary, counts binary, n long, seen long"), "context-tree-sums")
    total, distinct = sums.where("kind = 'word'").agg(F.coalesce(F.sum("n"), F.lit(0)), F.coalesce(F.sum("seen"), F.lit(0))).first()
    given = (sums.select("kind", "part", F.lit(0).alias("step"), "keys", "counts")
             .unionByName(upper_nodes(sums).withColumns({"kind": F.lit("gram"), "step": F.lit(1)}), allowMissingColumns=True)
             .unionByName(asked.select("kind", "part", F.lit(2).alias("step"), "block", "keys"), allowMissingColumns=True))
    answers = given.repartition(parts, "kind", "part").sortWithinPartitions("kind", "part", "step").mapInArrow(_answered, "block long, kind string, keys binary, answers binary")
    divisor = math.log10(total + ADDED * (distinct + 1))

    def numbered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block, ids, texts, train in _blocks(batches):
            yield pa.RecordBatch.from_arrays([pa.array([block] * len(ids), pa.int64()), pa.array(ids, pa_id), pa.array(texts, pa.binary()), pa.array(train)], ["block", "doc_id", "text", "train"])

    from pyspark.sql.pandas.types import to_arrow_type
    pa_id = to_arrow_type(source.schema["doc_id"].dataType)

    def score(left: pa.Table, right: pa.Table) -> pa.Table:
        words: list[bytes] = []
        found: dict[str, list[np.ndarray]] = {name: [np.empty(0, np.int64)] for name in ("count", "gram", "value")}
        for kind, keys, answer in zip(right["kind"], right["keys"], right["answers"]):
            if kind.as_py() == "word":
                words += unpack_words(keys.as_py())
                found["count"].append(unpack(answer.as_py()))
            else:
                found["gram"].append(as_grams(unpack_rising(keys.as_py())))
                found["value"].append(unpack(answer.as_py()))
        del right
        word, count = pa.array(words, pa.binary()), np.concatenate(found["count"])
        lookup = GramTable(np.concatenate(found["gram"]), np.concatenate(found["value"]).astype(np.uint32).view(np.float32).astype(float))
        del words, found
        log_base, known_word = np.log10(count + ADDED) - divisor, count > 0
        out = {"n_tokens": [], "n_known": [], "base_score": [], "score": []}
        for a, b in _chunks(pc.binary_length(left["text"]).to_pylist()):
            some = left["text"].slice(a, b - a).to_pylist()
            lengths = np.fromiter(map(len, some), np.int64, len(some)) + 1
            out["score"].append(np.add.reduceat(lookup.values(grams(some).view(np.int64)), np.cumsum(lengths) - lengths))
            tokens: list[bytes] = []
            sizes = []
            for t in some:
                own = t.split()
                tokens += own
                tokens.append(b"")
                sizes.append(len(own) + 1)
            place = pc.index_in(pa.array(tokens, pa.binary()), value_set=word).to_numpy(zero_copy_only=False)
            starts = np.cumsum(sizes) - sizes
            out["n_tokens"].append(np.array(sizes, np.int64))
            out["n_known"].append(np.add.reduceat(known_word[place].astype(np.int64), starts))
            out["base_score"].append(np.add.reduceat(log_base[place], starts))
        return pa.table({"doc_id": left["doc_id"], "held_out": pa.array([not f for f in left["train"].to_pylist()])} | {name: np.concatenate(v) for name, v in out.items()})

    texts = source.mapInArrow(numbered, f"block long, doc_id {id_type}, text binary, train boolean")
    scored = texts.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(
        score, f"doc_id {id_type}, held_out boolean, n_tokens long, n_known long, base_score double, score double")
    return scored.select("doc_id", "held_out", "n_tokens", "n_known", F.lit(total).cast("long").alias("train_tokens"), "base_score", "score")


def op1_context_tree_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return score_texts(docs, id_bucket(F.col("doc_id"), 10) != 0)
