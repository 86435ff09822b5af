"""Shortest-pack-first packing of token pieces over their length histogram.

Documents are cut into pieces of at most ``SEQUENCE`` tokens. The histogram of piece lengths, which has at most that
many rows, is all the packing needs: lengths are placed longest first, each on the shortest packs there are,
and packs that look alike are handled as one pattern with a count. The result says, for ranges of ranks
within a length, which sequences and which offset they get; pieces are joined to it by their rank.
"""

from __future__ import annotations

import heapq
import zlib
from collections.abc import Iterator
from functools import cache

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F, Window
from tokenizers import Tokenizer

from faqspark.llm.store import Saved
from faqspark.llm.words import Words, slices

SEQUENCE, END_ID = 4096, 2
#: Distinct words whose ids a worker remembers (about 40 bytes each); beyond it starts anew.
REMEMBERED = 2_000_000
TOKENIZER = "word_bpe_49k.json"


class WordEncoder:
    """Token ids of whole texts, by encoding each distinct word once.

    The tokenizer drops white space and never merges across it, so a text's ids are those of its words in turn.
    """

    def __init__(self, path: str):
        self.tokenizer = Tokenizer.from_file(path)
        self._forget()

    def _forget(self) -> None:
        self.known, self.low, self.size = np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.pool = np.zeros(0, np.uint32)

    def _learn(self, words: list[str], hashes: np.ndarray) -> None:
        encoded = self.tokenizer.encode(" ".join(words), add_special_tokens=False)
        starts = np.concatenate([[0], np.cumsum([len(w) + 1 for w in words])])[:-1]
        ids = np.array(encoded.ids, np.uint32)
        at = np.array(encoded.offsets, np.int64).reshape(-1, 2)[:, 0]
        size = np.bincount(np.searchsorted(starts, at, "right") - 1, minlength=len(words))
        low = len(self.pool) + np.cumsum(size) - size
        self.pool = np.concatenate([self.pool, ids])
        known, low, size = np.concatenate([self.known, hashes]), np.concatenate([self.low, low]), np.concatenate([self.size, size])
        order = np.argsort(known, kind="stable")
        self.known, self.low, self.size = known[order], low[order], size[order]

    def encode(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all rows one after the other, each row closed by the end id, and the bounds of the rows.

        The tokenizer lower-cases, but special tokens are told by their case; texts that may hold one keep theirs.
        """
        words = Words(column, lower=not pc.any(pc.match_substring(column, "<|")).as_py())
        distinct, first, which = np.unique(words.hash, return_index=True, return_inverse=True)
        if len(self.known) > REMEMBERED:
            self._forget()
        new = ~np.isin(distinct, self.known, assume_unique=True)
        if new.any():
            self._learn([words.text(k).decode() for k in first[new]], distinct[new])
        place = np.searchsorted(self.known, distinct)[which]
        size, low = self.size[place], self.low[place]
        total = int(size.sum())
        before = np.cumsum(size) - size
        token_row = np.repeat(words.row(), size)
        bounds = np.concatenate([[0], np.cumsum(np.bincount(token_row, minlength=len(column)) + 1)])
        flat = np.empty(total + len(column), "<u4")
        flat[np.arange(total) + token_row] = self.pool[np.repeat(low - before, size) + np.arange(total)]
        flat[bounds[1:] - 1] = END_ID
        return flat, bounds


@cache
def encoder(path: str) -> WordEncoder:
    return WordEncoder(path)


PIECE = "doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, part int, rank bigint"


def _cutter(path: str, longest: int):
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        seen = np.zeros(longest + 1, np.int64)
        for batch in slices(batches):
            ids, bounds = encoder(path).encode(batch.column("text"))
            tokens = np.diff(bounds)
            pieces = -(-tokens // longest)
            row = np.repeat(np.arange(len(tokens)), pieces)
            start = (np.arange(len(row)) - np.repeat(np.cumsum(pieces) - pieces, pieces)) * longest
            length = np.minimum(tokens[row] - start, longest)
            low = bounds[row] + start
            crc = [zlib.crc32(ids[a : a + n]) for a, n in zip(low, length)]
            rank = np.empty(len(row), np.int64)
            order = np.argsort(length, kind="stable")
            runs = np.flatnonzero(np.diff(length[order], prepend=0))
            counts = np.diff(runs, append=len(order))
            rank[order] = seen[length[order]] + np.arange(len(order)) - np.repeat(runs, counts)
            seen += np.bincount(length, minlength=longest + 1)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").take(pa.array(row)), pa.array(start), pa.array(length), pa.array(crc, pa.int64()), pa.array(tokens[row]),
                 pa.array(np.full(len(row), part, np.int32)), pa.array(rank)],
                names=["doc_id", "start", "length", "ids_crc32", "doc_tokens", "part", "rank"])

    return cut


def placements(histogram: dict[int, int], longest: int = SEQUENCE) -> np.ndarray:
    """Rows (length, first rank, count, first sequence, offset): where the pieces of each length go.

    A pattern is a run of sequences filled alike, kept by its height. Each length goes on the shortest patterns while it
    fits; what is left opens new sequences, as many as it needs when they are filled with that length alone.
    """
    found, patterns, sequences = [], [], 0
    for length in sorted((n for n, c in histogram.items() if c), reverse=True):
        rank, left = 0, histogram[length]
        while left and patterns and patterns[0][0] + length <= longest:
            height, first, count = heapq.heappop(patterns)
            used = min(count, left)
            found.append((length, rank, used, first, height))
            if height + length < longest:
                heapq.heappush(patterns, (height + length, first, used))
            if used < count:
                heapq.heappush(patterns, (height, first + used, count - used))
            rank, left = rank + used, left - used
        if left:
            opened = -(-left // (longest // length))
            height = 0
            while left:
                used = min(opened, left)
                found.append((length, rank, used, sequences, height))
                if used < opened and height < longest:
                    heapq.heappush(patterns, (height, sequences + used, opened - used))
                rank, left, height = rank + used, left - used, height + length
                opened_left = used
                if not left and height < longest:
                    heapq.heappush(patterns, (height, sequences, opened_left))
            sequences += opened
    return np.array(found, np.int64).reshape(-1, 5)


def _placer(table: np.ndarray):
    shift = np.int64(1) << np.int64(48)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys = table[:, 0] * shift + table[:, 1]
        for batch in batches:
            length, rank = (batch.column(c).to_numpy() for c in ("length", "rank"))
            at = np.searchsorted(keys, length * shift + rank, "right") - 1
            columns = [batch.column(c) for c in ("doc_id", "start", "length", "ids_crc32", "doc_tokens")]
            yield pa.RecordBatch.from_arrays(
                [*columns, pa.array(table[at, 3] + rank - table[at, 1]), pa.array(table[at, 4])],
                names=["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"])

    return place


PACKED = "doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, sequence_id bigint, offset bigint"


def packed(docs: DataFrame, *, tokenizer: str | None = None, longest: int = SEQUENCE) -> DataFrame:
    """One row per piece: (doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset).

    Null and empty texts are the end id alone. Every row of ``docs`` is a document of its own, also with a repeated or
    missing doc_id. An empty table gives no pieces. Ranks count per scan partition and length; their offsets come from
    the counts, so no length's pieces meet in one task.
    """
    path = tokenizer or public_tokenizers.path(TOKENIZER)
    pieces = Saved(docs.select("doc_id", "text").mapInArrow(_cutter(path, longest), PIECE), "pieces").df
    counts = Saved(pieces.groupBy("length", "part").count(), "piece-counts").df
    histogram = {r["length"]: r["n"] for r in counts.groupBy("length").agg(F.sum("count").alias("n")).collect()}
    table = placements(histogram, longest)
    table = table[np.lexsort((table[:, 1], table[:, 0]))]
    before = F.sum("count").over(Window.partitionBy("length").orderBy("part")) - F.col("count")
    bases = counts.select(F.col("length").alias("l"), F.col("part").alias("p"), before.alias("base"))
    # The offsets grow with the partitions and compress well, so a size on disk says little: never broadcast them.
    ranked = pieces.join(bases.hint("merge"), (F.col("length") == F.col("l")) & (F.col("part") == F.col("p"))).select(
        "doc_id", "start", "length", "ids_crc32", "doc_tokens", (F.col("rank") + F.col("base")).alias("rank"))
    return ranked.mapInArrow(_placer(table), PACKED)
