"""Byte-level BPE encoding and decoding over a lexicon of the corpus's frequent words.

A pass over all documents counts the words; those frequent enough are compiled
with their ids into a minimal acyclic transducer, which every worker maps into
memory. Encoding looks a batch's distinct words up in it, and merges exactly
those that it does not hold.
"""

from __future__ import annotations

import heapq
import json
import re
import uuid
from collections import Counter
from collections.abc import Callable, Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark import SparkFiles
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import map_arrow, put, slices, text_or_empty, written
from .lexicon import Lexicon, compile_lexicon
from .wordids import gather

BYTE_BPE = "byte_bpe_50k.json"
LEXICON_WORDS = 65_536
LEXICON_BYTES = 64
_STEPS = 256  # in which a count grows by the factor e
_NEVER = 1 << 40
_LONG = 48
_BLOCK = 1 << 15
_TEXT_BYTES = 8 << 20
_FLUSH = 300_000
_WHITE = r"\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
# Fixed value: how byte-level BPE splits text before it merges.
_WORD = regex.compile(
    rf"'s|'t|'re|'ve|'m|'ll|'d| ?\p{{L}}+| ?\p{{N}}+| ?[^{_WHITE}\p{{L}}\p{{N}}]+|[{_WHITE}]+(?![^{_WHITE}])|[{_WHITE}]+"
)
# A word never holds a space after another character, and white space goes with
# what follows it only as one space. So text may be cut before a space that is
# followed by something else. Cutting before every space is the same unless the
# space has white space before it and white space or the end behind it.
_CUT = re.compile(r"(?= \S)")
_IRREGULAR = r"[\t-\r \x1c-\x1f\x{85}\p{Z}] ([\t-\r \x1c-\x1f\x{85}\p{Z}]|$)"


def _byte_letters() -> dict[str, int]:
    """The letter that stands for each byte in the vocabulary file: itself if printable, else from 256 on."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    letters = {chr(b): b for b in printable}
    for n, b in enumerate(b for b in range(256) if b not in set(printable)):
        letters[chr(256 + n)] = b
    return letters


class ByteBPE:
    """Vocabulary, merges and special tokens of a byte-level BPE file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        letters = _byte_letters()
        vocab = spec["model"]["vocab"]
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.bytes_of = [b""] * (1 + max([*vocab.values(), *self.special.values()]))
        for token, i in vocab.items():
            self.bytes_of[i] = bytes(letters[c] for c in token)
        for token, i in self.special.items():
            self.bytes_of[i] = token.encode()
        self.first = [0] * 256
        for letter, b in letters.items():
            self.first[b] = vocab[letter]
        self.merges = {
            (vocab[a], vocab[b]): (rank, vocab[a + b]) for rank, (a, b) in enumerate(spec["model"]["merges"])
        }
        self.split_special = re.compile("(" + "|".join(map(re.escape, sorted(self.special, key=len, reverse=True))) + ")")
        pairs = sorted((a * len(self.bytes_of) + b, rank, new) for (a, b), (rank, new) in self.merges.items())
        self.pair_keys, self.pair_ranks, self.pair_ids = np.array(pairs, np.int64).reshape(-1, 3).T.copy()
        self.first_ids = np.array(self.first, np.int64)

    def merge(self, word: bytes) -> list[int]:
        """Exact merges of one word: always the pair of the lowest rank, the leftmost first."""
        ids = [self.first[b] for b in word]
        if len(ids) > _LONG:
            return self._merge_long(ids)
        merges, none = self.merges, (1 << 60, 0)
        while len(ids) > 1:
            rank, new = none
            for pair in zip(ids, ids[1:]):
                found = merges.get(pair, none)
                if found[0] < rank:
                    (rank, new), best = found, pair
            if rank == none[0]:
                break
            out, i, last = [], 0, len(ids) - 1
            while i <= last:
                if i < last and ids[i] == best[0] and ids[i + 1] == best[1]:
                    out.append(new)
                    i += 2
                else:
                    out.append(ids[i])
                    i += 1
            ids = out
        return ids

    def _merge_long(self, ids: list[int]) -> list[int]:
        """The same with a heap, for words of any length."""
        n, merges = len(ids), self.merges
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(merges[p][0], i, p) for i, p in enumerate(zip(ids, ids[1:])) if p in merges]
        heapq.heapify(heap)
        while heap:
            _, i, pair = heapq.heappop(heap)
            j = after[i] if ids[i] >= 0 else n
            if j >= n or (ids[i], ids[j]) != pair:
                continue
            ids[i], ids[j] = merges[pair][1], -1
            after[i] = after[j]
            if after[i] < n:
                before[after[i]] = i
            for a, b in ((before[i], i), (i, after[i])):
                if a >= 0 and b < n and (found := merges.get((ids[a], ids[b]))):
                    heapq.heappush(heap, (found[0], a, (ids[a], ids[b])))
        return [i for i in ids if i >= 0]

    def _ranks(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank of each pair (or _NEVER) and the id that it merges to."""
        key = left * len(self.bytes_of) + right
        at = np.minimum(np.searchsorted(self.pair_keys, key), len(self.pair_keys) - 1)
        rank = np.where(self.pair_keys[at] == key, self.pair_ranks[at], _NEVER)
        return rank, self.pair_ids[at]

    def merge_all(self, data: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """``merge`` of many words at once: their ids one after the other, and how many each has."""
        order = np.argsort(lengths, kind="stable")
        counts = np.zeros(len(starts), np.int64)
        rows, blocks = [], []
        short = order[: np.searchsorted(lengths[order], _LONG, side="right")]
        for at in range(0, len(short), _BLOCK):
            some = short[at : at + _BLOCK]
            ids, counts[some] = self._merge_block(data, starts[some], lengths[some])
            rows.append(some)
            blocks.append(ids)
        for k in order[len(short) :].tolist():
            ids = np.array(self._merge_long(self.first_ids[data[starts[k] : starts[k] + lengths[k]]].tolist()), np.uint32)
            counts[k] = len(ids)
            rows.append(np.array([k]))
            blocks.append(ids)
        out = np.empty(int(counts.sum()), np.uint32)
        ends = np.cumsum(counts)
        for some, ids in zip(rows, blocks):
            sizes = counts[some]
            out[np.repeat(ends[some] - np.cumsum(sizes), sizes) + np.arange(len(ids))] = ids
        return out, counts

    def _merge_block(self, data: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All words of a block advance together, each by the merge it makes next."""
        width = int(lengths[-1]) if len(lengths) else 0
        column = np.arange(width)
        held = column < lengths[:, None]
        ids = np.where(held, self.first_ids[data[np.where(held, starts[:, None] + column, 0)]], -1)
        sizes = lengths.copy()
        rank = np.full(ids.shape, _NEVER)
        new = np.zeros(ids.shape, np.int64)
        pairs = held[:, 1:]
        rank[:, :-1][pairs], new[:, :-1][pairs] = self._ranks(ids[:, :-1][pairs], ids[:, 1:][pairs])
        live = np.arange(len(ids))
        while len(live):
            at = rank[live].argmin(axis=1)
            on = rank[live, at] < _NEVER
            live, at = live[on], at[on]
            if not len(live):
                break
            ids[live, at] = new[live, at]
            # What follows the merged pair moves up by one.
            for table, filler in ((ids, -1), (rank, _NEVER), (new, 0)):
                moved = table[live]
                after = column[:-1] > at[:, None]
                moved[:, :-1] = np.where(after, moved[:, 1:], moved[:, :-1])
                moved[:, -1] = filler
                table[live] = moved
            sizes[live] -= 1
            for left in (at - 1, at):
                valid = (left >= 0) & (left + 1 < sizes[live])
                row, place = live[valid], left[valid]
                rank[row, place], new[row, place] = self._ranks(ids[row, place], ids[row, place + 1])
                last = (left >= 0) & ~valid
                rank[live[last], left[last]] = _NEVER
        return ids[column < sizes[:, None]].astype(np.uint32), sizes

    def pieces(self, texts: pa.Array) -> tuple[list[str], np.ndarray, np.ndarray]:
        """Distinct pieces of the texts, the piece at each place, and the end of each text."""
        texts = texts.fill_null("")
        odd = pc.match_substring_regex(texts, _IRREGULAR)
        for token in self.special:
            odd = pc.or_(odd, pc.match_substring(texts, token))
        split = pc.split_pattern(pc.if_else(odd, "", texts), " ")
        values = split.flatten().dictionary_encode()
        offsets = split.offsets.to_numpy().astype(np.int64)
        offsets = offsets - offsets[0]
        places = values.indices.to_numpy().astype(np.int64) * 2 + 1
        places[offsets[:-1]] -= 1  # the first of a text has no space before it
        seen = np.flatnonzero(np.bincount(places))
        rank = np.zeros(int(seen[-1]) + 1 if len(seen) else 0, np.int64)
        rank[seen] = np.arange(len(seen))
        words = values.dictionary.to_pylist()
        pieces = [" " + words[k >> 1] if k & 1 else words[k >> 1] for k in seen.tolist()]
        places, ends = rank[places], offsets[1:]

        slow = np.flatnonzero(odd.to_numpy(zero_copy_only=False))
        if len(slow):
            numbers: dict[str, int] = {}
            parts, at = [], 0
            for i in slow.tolist():
                cut = []
                for k, segment in enumerate(self.split_special.split(texts[i].as_py())):
                    cut.extend([segment] if k % 2 else _CUT.split(segment))
                found = [len(pieces) + numbers.setdefault(c, len(numbers)) for c in cut]
                parts.append(places[at : offsets[i]])
                parts.append(np.array(found, np.int64))
                at = offsets[i + 1]  # in place of the empty text's one piece
            parts.append(places[at:])
            sizes = np.diff(ends, prepend=0)
            sizes[slow] = [len(p) for p in parts[1::2]]
            places, ends = np.concatenate(parts), np.cumsum(sizes)
            pieces.extend(numbers)
        return pieces, places, ends

    def words(self, pieces: list[str]) -> tuple[pa.DictionaryArray, np.ndarray]:
        """The words of the pieces one after the other, and how many each piece has."""
        special, find = self.special, _WORD.findall
        found = [[p] if p in special else find(p) for p in pieces]
        sizes = np.fromiter(map(len, found), np.int64, len(found))
        return pa.array(chain.from_iterable(found), pa.string()).dictionary_encode(), sizes

    def encode(self, texts: pa.Array, lexicon: Lexicon) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the texts (null: empty), and the end of each text."""
        pieces, places, ends = self.pieces(texts)
        words, sizes = self.words(pieces)
        distinct = words.dictionary
        offsets = np.frombuffer(distinct.buffers()[1], np.int32, len(distinct) + 1, distinct.offset * 4).astype(np.int64)
        data = np.frombuffer(distinct.buffers()[2] or b"\0", np.uint8)
        place = lexicon.places(data, offsets[:-1], np.diff(offsets))
        unseen = np.flatnonzero(place < 0)
        merged, counts = self.merge_all(data, offsets[unseen], np.diff(offsets)[unseen])

        # Ids of each distinct word, from the lexicon and the merges.
        lengths = np.empty(len(distinct), np.int64)
        in_file = place >= 0
        lengths[in_file] = np.diff(lexicon.offsets)[place[in_file]]
        lengths[unseen] = counts
        flat = np.empty(int(lengths.sum()), np.uint32)
        of_file = np.repeat(in_file, lengths)
        flat[of_file], _ = gather(lexicon.ids, np.diff(lexicon.offsets), place[in_file])
        flat[~of_file] = merged
        for token, i in self.special.items():  # a word of its own where a text holds it
            k = pc.index(distinct, token).as_py()
            if k >= 0:
                upto = np.cumsum(lengths)[k]
                flat = np.concatenate([flat[: upto - lengths[k]], np.array([i], np.uint32), flat[upto:]])
                lengths[k] = 1

        by_piece, piece_ends = gather(flat, lengths, words.indices.to_numpy())
        word_ends = np.concatenate(([0], piece_ends))[np.concatenate(([0], np.cumsum(sizes)))]
        out, out_ends = gather(by_piece, np.diff(word_ends), places)
        return out, np.concatenate(([0], out_ends))[ends]


@lru_cache(maxsize=2)
def byte_bpe(path: str | None = None) -> ByteBPE:
    """The worker's vocabulary; read once per Python worker."""
    return ByteBPE(path or public_tokenizers.path(BYTE_BPE))


@lru_cache(maxsize=2)
def _lexicon(name: str) -> Lexicon:
    return Lexicon(SparkFiles.get(name))


def _count(path: str | None) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe, counts = byte_bpe(path), Counter()

        def flush() -> pa.RecordBatch:
            return pa.record_batch([pa.array(counts.keys(), pa.string()), pa.array(counts.values(), pa.int64())], names=["word", "n"])

        for batch in slices(batches, 0, _TEXT_BYTES):
            pieces, places, _ = bpe.pieces(batch.column(0))
            words, sizes = bpe.words(pieces)
            weight = np.repeat(np.bincount(places, minlength=len(pieces)), sizes)
            total = np.bincount(words.indices.to_numpy(), weight, len(words.dictionary)).astype(np.int64)
            for word, n in zip(words.dictionary.to_pylist(), total.tolist()):
                counts[word] += n
            if len(counts) > _FLUSH:
                yield flush()
                counts.clear()
        yield flush()

    return run


def word_counts(docs: DataFrame, text: str = "text", tokenizer: str | None = None) -> DataFrame:
    """(word, n) over all documents."""
    partial = map_arrow(docs.select(text_or_empty(text).alias("text")), _count(tokenizer), "word string, n long")
    return partial.groupBy("word").agg(F.sum("n").alias("n"))


def build_lexicon(counts: DataFrame, words: int = LEXICON_WORDS, tokenizer: str | None = None) -> bytes:
    """The lexicon file of the most frequent words: all that occur so often that at most ``words`` do.

    Words are taken by steps of their counts' logarithm, each step whole or not at
    all, and only up to ``LEXICON_BYTES`` bytes. Both bounds are on the model, not
    on the corpus: other words are merged exactly.
    """
    step = F.floor(F.log1p(F.col("n").cast("double")) * _STEPS)
    counts = counts.where(F.octet_length("word") <= LEXICON_BYTES).withColumn("step", step)
    sizes = counts.groupBy("step").agg(F.count(F.lit(1)).alias("c")).collect()  # at most 44 * _STEPS rows
    least, room = None, words
    for at, c in sorted(((r["step"], r["c"]) for r in sizes), reverse=True):
        if c > room:
            break
        least, room = at, room - c
    bpe = byte_bpe(tokenizer)
    taken = counts.where(F.col("step") >= least).select("word").collect() if least is not None else []
    found = sorted(r["word"].encode() for r in taken)
    found = [w for w in found if w and w.decode() not in bpe.special]
    return compile_lexicon(found, [bpe.merge(w) for w in found])


def share(spark: SparkSession, data: bytes) -> str:
    """Put a small file into the shared folder and hand a copy to every executor; its name there."""
    name = f"tradelens-lexicon-{uuid.uuid4().hex}"
    spark.sparkContext.addFile(put(spark, name, data))
    return name


def _encode(path: str | None, name: str) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe, lexicon = byte_bpe(path), _lexicon(name)
        for batch in slices(batches, 1, _TEXT_BYTES):
            ids, ends = bpe.encode(batch.column(1), lexicon)
            offsets = pa.py_buffer(np.concatenate(([0], ends * 4)).astype(np.int32))
            data = pa.Array.from_buffers(pa.binary(), batch.num_rows, [None, offsets, pa.py_buffer(ids.astype("<u4"))])
            yield pa.record_batch([batch.column(0), data], names=["id", "ids"])

    return run


def _decode(path: str | None) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = byte_bpe(path).bytes_of
        for batch in slices(batches, 1, 4 * _TEXT_BYTES):
            texts = []
            for data in batch.column(1):
                ids = np.frombuffer(data.as_buffer(), "<u4").tolist() if data.is_valid else []
                texts.append(b"".join(map(table.__getitem__, ids)).decode("utf-8", "replace"))
            yield pa.record_batch([batch.column(0), batch.column(1), pa.array(texts, pa.string())], names=["id", "ids", "text"])

    return run


def encode(
    docs: DataFrame, id: str = "doc_id", text: str = "text", words: int = LEXICON_WORDS, tokenizer: str | None = None
) -> DataFrame:
    """(``id``, ids) per row: the text's ids as little-endian unsigned 32-bit integers.

    Special tokens in a text are themselves, as the library has it. Null and
    empty texts have no ids; repeated rows are encoded each; an empty table
    gives an empty result. Other columns of ``docs`` are not read.
    """
    counts = written(word_counts(docs, text, tokenizer), "words")
    name = share(docs.sparkSession, build_lexicon(counts, words, tokenizer))
    kind = docs.schema[id].dataType.simpleString()
    rows = docs.select(F.col(id).alias("id"), text_or_empty(text).alias("text"))
    return map_arrow(rows, _encode(tokenizer, name), f"id {kind}, ids binary").withColumnRenamed("id", id)


def decode(encoded: DataFrame, id: str = "doc_id", ids: str = "ids", tokenizer: str | None = None) -> DataFrame:
    """(``id``, ids, text) per row of ids; bytes that are no UTF-8 become U+FFFD, null ids an empty text."""
    kind = encoded.schema[id].dataType.simpleString()
    rows = encoded.select(F.col(id).alias("id"), F.col(ids).alias("ids"))
    return map_arrow(rows, _decode(tokenizer), f"id {kind}, ids binary, text string").withColumnRenamed("id", id)
