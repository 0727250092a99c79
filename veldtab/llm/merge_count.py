"""Token counts by heap-and-linked-list byte-pair merging.

A segment starts as its characters. The adjacent pair of the lowest rank (the leftmost of equals) is merged again and again; a
heap holds the candidate pairs, a linked list the symbols left. The count is initial symbols minus merges; a character outside
the vocabulary counts one token for each of its bytes. No identifiers are made.

Spaces are written as one mark, and a mark is put before a text that is not empty. No piece of the vocabulary holds a mark
after another character, nor a line break, so merges never cross those places: a text is the sum of its segments,
and equal segments are merged once per task. The memory of counts is emptied when it holds ``CACHE`` segments; segments longer than
``LONGEST`` are merged each time.

Null and empty texts have no tokens. Very long texts without spaces are one segment, merged in n log n steps. Repeated rows are
counted one by one; an empty table gives an empty result; extra columns are dropped.
"""

from __future__ import annotations

import heapq
import re

import pyarrow as pa
from pyspark import SparkFiles
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from veldtab.llm.common import map_batches, table

MARK = "▁"
CACHE = 400_000
LONGEST = 200


class MergeCounter(dict):
    """Segment -> number of tokens; counts what it has not seen."""

    def __init__(self, ranks: dict[str, float]):
        super().__init__()
        self.ranks = ranks
        self.pieces = {p for p in ranks if len(p) > 1}
        inside = any(MARK in p.lstrip(MARK) for p in self.pieces)
        #: Characters of no longer piece stand alone: nothing is merged across them.
        self.apart = "\n" if not any("\n" in p for p in self.pieces) else ""
        parts = (f"{self.apart}|" if self.apart else "") + f"{MARK}*[^{MARK}{self.apart}]+|{MARK}+"
        self.splitter = re.compile("(?s).+" if inside else parts)

    def __missing__(self, segment: str) -> int:
        count = self.merged(segment)
        if len(segment) <= LONGEST:
            if len(self) >= CACHE:
                self.clear()
            self[segment] = count
        return count

    def merged(self, segment: str) -> int:
        """Initial symbols minus merges, plus the further bytes of unknown characters."""
        ranks = self.ranks
        symbols: list[str | None] = list(segment)
        n = len(symbols)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = []
        for i in range(n - 1):
            rank = ranks.get(symbols[i] + symbols[i + 1])
            if rank is not None:
                heap.append((rank, i, symbols[i] + symbols[i + 1]))
        heapq.heapify(heap)
        merges = 0
        while heap:
            _, left, piece = heapq.heappop(heap)
            right = after[left]
            if symbols[left] is None or right >= n or len(symbols[left]) + len(symbols[right]) != len(piece) or symbols[left] + symbols[right] != piece:
                continue
            symbols[left], symbols[right] = piece, None
            merges += 1
            after[left] = right = after[right]
            if right < n:
                before[right] = left
                rank = ranks.get(piece + symbols[right])
                if rank is not None:
                    heapq.heappush(heap, (rank, left, piece + symbols[right]))
            left_of = before[left]
            if left_of >= 0:
                rank = ranks.get(symbols[left_of] + piece)
                if rank is not None:
                    heapq.heappush(heap, (rank, left_of, symbols[left_of] + piece))
        return n - merges + sum(len(s.encode()) - 1 for s in symbols if s is not None and len(s) == 1 and s not in ranks)

    def count(self, text: str) -> int:
        if not text:
            return 0
        return sum(map(self.__getitem__, self.splitter.findall(MARK + text.replace(" ", MARK))))


def vocabulary(path: str) -> dict[str, float]:
    """Piece -> rank (minus the score) of the ordinary pieces of a sentencepiece model."""
    import sentencepiece
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    return {model.id_to_piece(i): -model.get_score(i) for i in range(model.vocab_size())
            if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i))}


def count_tokens(docs: DataFrame, path: str, limit: int = 4096, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_bytes, n_tokens, over_limit) per row. The vocabulary file is shipped with ``addFile``; its size is fixed."""
    docs.sparkSession.sparkContext.addFile(path)
    name = path.rsplit("/", 1)[-1]

    def run(batch: pa.RecordBatch, counter: MergeCounter) -> dict:
        texts = [t or "" for t in batch.column(1).to_pylist()]
        tokens = [counter.count(t) for t in texts]
        return {"doc_id": batch.column(0), "n_bytes": [len(t.encode()) for t in texts], "n_tokens": tokens, "over_limit": [n > limit for n in tokens]}

    source = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    schema = f"doc_id {source.schema['doc_id'].dataType.simpleString()}, n_bytes long, n_tokens long, over_limit boolean"
    return map_batches(source, schema, run, lambda: MergeCounter(vocabulary(SparkFiles.get(name))))


def op3_merge_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers
    return count_tokens(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))
