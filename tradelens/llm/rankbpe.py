"""Byte-level BPE encoding and decoding by a rank file.

Words are slices of a batch's bytes (``boundaries``). A batch's distinct words
are looked up in the worker's cache of merged words; new ones are merged exactly
and kept. Every token keeps the byte offset at which it ends, so that decoding
writes each token to its place, and any range of tokens leads back to its text.
"""

from __future__ import annotations

import base64
import heapq
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .boundaries import class_table, words
from .common import map_arrow, slices, text_or_empty
from .wordids import gather

MULTI_BPE = "byte_bpe_multi_50k.tiktoken"
#: Merged words that a worker keeps, and the bytes of the longest that it does.
KEPT_WORDS = 250_000
KEPT_BYTES = 64
_TEXT_BYTES = 2 << 20
_LONG = 256
_NEVER = 1 << 60


class RankBPE:
    """The ranks of a file, and the words merged by them so far."""

    def __init__(self, path: str, kept_words: int = KEPT_WORDS):
        with open(path, "rb") as f:
            pairs = [line.split() for line in f if line.strip()]
        self.ranks = {base64.b64decode(token): int(rank) for token, rank in pairs}
        self.kept_words = kept_words
        tokens = [b""] * (1 + max(self.ranks.values()))
        for token, rank in self.ranks.items():
            tokens[rank] = token
        self.sizes = np.fromiter(map(len, tokens), np.int64, len(tokens))
        self.bytes = np.frombuffer(b"".join(tokens), np.uint8)
        self._forget()

    def _forget(self) -> None:
        self.places: dict[str, int] = {}
        self.flat, self.counts = np.zeros(0, np.uint32), np.zeros(0, np.int64)

    def merge(self, word: bytes) -> list[int]:
        """The ids of one word: itself if it has a rank, else merges, the lowest rank first and of equal ones the leftmost."""
        rank_of = self.ranks.get
        whole = rank_of(word)
        if whole is not None:
            return [whole]
        if len(word) > _LONG:
            return self._merge_long(word)
        cuts = list(range(len(word) + 1))
        ranks = [rank_of(word[i : i + 2], _NEVER) for i in range(len(word) - 1)]  # of parts i and i + 1 as one
        while ranks:
            low = min(ranks)
            if low == _NEVER:
                break
            i = ranks.index(low)
            del cuts[i + 1], ranks[i]
            if i < len(ranks):
                ranks[i] = rank_of(word[cuts[i] : cuts[i + 2]], _NEVER)
            if i:
                ranks[i - 1] = rank_of(word[cuts[i - 1] : cuts[i + 1]], _NEVER)
        return [self.ranks[word[a:b]] for a, b in zip(cuts, cuts[1:])]

    def _merge_long(self, word: bytes) -> list[int]:
        """The same with a heap over linked parts, for words of any length."""
        n, rank_of = len(word), self.ranks.get
        end = np.arange(1, n + 1)  # of the part that begins here; 0 where none does
        before = np.arange(-1, n - 1)
        heap = [(r, i, i + 2) for i in range(n - 1) if (r := rank_of(word[i : i + 2])) is not None]
        heapq.heapify(heap)
        while heap:
            _, i, stop = heapq.heappop(heap)
            middle = int(end[i])
            if not middle or middle >= n or end[middle] != stop:
                continue  # a part of it has been merged since
            end[i], end[middle] = stop, 0
            if stop < n:
                before[stop] = i
                last = int(end[stop])
                if (r := rank_of(word[i:last])) is not None:
                    heapq.heappush(heap, (r, i, last))
            left = int(before[i])
            if left >= 0 and (r := rank_of(word[left:stop])) is not None:
                heapq.heappush(heap, (r, left, stop))
        return [self.ranks[word[i : end[i]]] for i in np.flatnonzero(end).tolist()]

    def _ids(self, distinct: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ragged ids (flat, counts) of the words known by now, and the place of each of ``distinct`` among them."""
        if len(self.places) > self.kept_words:
            self._forget()
        known, flat, counts = self.places, [self.flat], [self.counts]
        place = np.empty(len(distinct), np.int64)
        free = kept = len(self.counts)
        new: list[list[int]] = []
        passing: list[tuple[int, list[int]]] = []  # words too long to be kept
        for k, word in enumerate(distinct.to_pylist()):
            at = known.get(word)
            if at is None:
                ids = self.merge(data := word.encode())
                if len(data) > KEPT_BYTES:
                    passing.append((k, ids))
                    continue
                at = known[word] = free
                free += 1
                new.append(ids)
            place[k] = at
        for ids in (new, [ids for _, ids in passing]):
            counts.append(np.fromiter(map(len, ids), np.int64, len(ids)))
            flat.append(np.array([i for x in ids for i in x], np.uint32))
        place[[k for k, _ in passing]] = free + np.arange(len(passing))
        if free > kept:
            self.flat, self.counts = np.concatenate(flat[:2]), np.concatenate(counts[:2])
        return np.concatenate([self.flat, flat[2]]), np.concatenate([self.counts, counts[2]]), place

    def encode(self, texts: pa.Array, table: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """All ids of the texts (null: empty), the byte at which each token ends in its text, and the end of each text's ids."""
        found, word_ends = words(texts, table)
        found = found.dictionary_encode()
        flat, counts, place = self._ids(found.dictionary)
        ids, ends = gather(flat, counts, place[found.indices.to_numpy()])
        ends = np.concatenate(([0], ends))[word_ends]
        upto = np.cumsum(self.sizes[ids])
        first = np.concatenate(([0], ends[:-1]))  # the first id of each text
        base = np.concatenate(([0], upto))[first]
        return ids, upto - np.repeat(base, ends - first), ends

    def decode(self, ids: np.ndarray, ends: np.ndarray) -> bytes:
        """The bytes of one text's tokens, each written up to the place at which it ends."""
        sizes = self.sizes[ids]
        out = np.zeros(int(ends[-1]) if len(ends) else 0, np.uint8)
        source, _ = gather(self.bytes, self.sizes, ids)
        out[np.repeat(ends - np.cumsum(sizes), sizes) + np.arange(len(source))] = source
        return out.tobytes()


@lru_cache(maxsize=2)
def rank_bpe(path: str | None = None) -> RankBPE:
    """The worker's ranks; read once per Python worker."""
    return RankBPE(path or public_tokenizers.path(MULTI_BPE))


def _binary(values: np.ndarray, ends: np.ndarray) -> pa.Array:
    """Each row's part of ``values`` as little-endian unsigned 32-bit integers."""
    offsets = pa.py_buffer(np.concatenate(([0], ends * 4)).astype(np.int32))
    return pa.Array.from_buffers(pa.binary(), len(ends), [None, offsets, pa.py_buffer(values.astype("<u4"))])


def _encode(path: str | None, shared) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe, table = rank_bpe(path), shared.value
        for batch in slices(batches, 1, _TEXT_BYTES):
            ids, token_ends, ends = bpe.encode(batch.column(1), table)
            yield pa.record_batch([batch.column(0), _binary(ids, ends), _binary(token_ends, ends)], names=["id", "ids", "ends"])

    return run


def _numbers(value) -> np.ndarray:
    return np.frombuffer(value.as_buffer(), "<u4").astype(np.int64) if value.is_valid else np.zeros(0, np.int64)


def _decode(path: str | None) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = rank_bpe(path)
        for batch in slices(batches, 1, 2 * _TEXT_BYTES):
            found = [bpe.decode(_numbers(i), _numbers(e)) for i, e in zip(batch.column(1), batch.column(2))]
            yield pa.record_batch([batch.column(0), batch.column(1), batch.column(2), pa.array(found, pa.binary())], names=["id", "ids", "ends", "bytes"])

    return run


def encode(docs: DataFrame, id: str = "doc_id", text: str = "text", ranks: str | None = None) -> DataFrame:
    """(``id``, ids, ends) per row: ids and token ends (in bytes of the text) as little-endian unsigned 32-bit integers.

    Special tokens' names in a text are text. Null and empty texts have no ids;
    repeated rows are encoded each; an empty table gives an empty result. A text
    of any length is encoded whole; other columns of ``docs`` are not read.
    """
    kind = docs.schema[id].dataType.simpleString()
    rows = docs.select(F.col(id).alias("id"), text_or_empty(text).alias("text"))
    shared = docs.sparkSession.sparkContext.broadcast(class_table())  # a byte per code point
    return map_arrow(rows, _encode(ranks, shared), f"id {kind}, ids binary, ends binary").withColumnRenamed("id", id)


def decode(encoded: DataFrame, id: str = "doc_id", ids: str = "ids", ends: str = "ends", ranks: str | None = None) -> DataFrame:
    """(``id``, ids, ends, bytes) per row of ``encode``; null ids give no bytes."""
    kind = encoded.schema[id].dataType.simpleString()
    rows = encoded.select(F.col(id).alias("id"), F.col(ids).alias("ids"), F.col(ends).alias("ends"))
    return map_arrow(rows, _decode(ranks), f"id {kind}, ids binary, ends binary, bytes binary").withColumnRenamed("id", id)
