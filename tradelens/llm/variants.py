"""Spelling variant grouping by asymmetric q-chunks.

Words that differ by exactly one inserted, deleted or replaced code point are
near. Of two words the shorter (of equal length the smaller) contributes two
disjoint chunks, each half its length; the other contributes its grams of that
length at all positions within one of a chunk's. One edit leaves one of the
chunks whole and shifts it by one place at most, so near words share a chunk and
a gram; pairs that do are verified by their edit distance inside the join.

A chunk that very many words share (a common beginning) would meet all their
grams. There the rest of the words, without the chunk, is chunked again, since
one of two near words' chunks stands at the same distance from the beginning or
the end, and the edit is in the rest: both the chunk and a chunk of the rest must
agree. This goes on until few words share what agrees, or a letter at most is left.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .boundaries import flat_texts
from .common import map_arrow, slices, text_or_empty, written

MIN_LETTERS = 6
MIN_COUNT = 5
#: A word's form occurs at least so many times as often.
FORM_FACTOR = 5
#: One in so many runs of a document is misspelt on purpose.
MISSPELT = 199
#: Grams that agree with one chunk before the rest is chunked again.
HOT_GRAMS = 2_000
_TEXT_BYTES = 4 << 20
_FLUSH = 300_000
_TABLED = 64  # bytes of runs whose checksums are carried on in numpy
_FULL = 0xFFFFFFFF


def _byte_table() -> np.ndarray:
    """What the text's bytes become: A-Z lower-cased, letters kept, all else a space; bytes behind 0xC3 are set apart."""
    table = np.full(256, ord(" "), np.uint8)
    for low, high in (("a", "z"), ("A", "Z")):
        table[ord(low) : ord(high) + 1] = np.arange(ord("a"), ord("z") + 1)
    table[0xC3] = 0xC3  # begins each of U+00C0 to U+00FF
    return table


_BYTES = _byte_table()


def _crc_table() -> np.ndarray:
    """Checksum registers after a zero byte, by the last byte before it."""
    value = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        value = np.where(value & 1, value >> 1 ^ np.uint32(0xEDB88320), value >> 1)
    return value


_CRC = _crc_table()


def runs(texts: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """Distinct lower-cased runs of letters of the texts (null: none), the run at each place, and the text there."""
    buffer, data, offsets = flat_texts(texts)
    plain = _BYTES[data]
    accented = np.flatnonzero(data == 0xC3) + 1
    plain[accented] = data[accented]
    cut = pa.py_buffer(offsets.astype(np.int32))
    split = pc.ascii_split_whitespace(pa.Array.from_buffers(pa.string(), len(texts), [None, cut, pa.py_buffer(plain)]))
    found = split.flatten().dictionary_encode()
    text_of = np.repeat(np.arange(len(texts)), np.diff(split.offsets.to_numpy()))
    return found.dictionary, found.indices.to_numpy(), text_of


def checksums(names: list[bytes], words: list[bytes], text_of: np.ndarray, word_at: np.ndarray) -> np.ndarray:
    """CRC-32 of each place's text name followed by its word.

    The register after a word is that after as many zero bytes, exclusive-or the
    word's own from a zero register; both are made once for each text and word.
    """
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    own = np.fromiter((zlib.crc32(w, _FULL) ^ _FULL for w in words), np.uint32, len(words))
    ahead = np.empty((_TABLED + 1, len(names)), np.uint32)
    ahead[0] = np.fromiter((zlib.crc32(n) ^ _FULL for n in names), np.uint32, len(names))
    for k in range(_TABLED):
        ahead[k + 1] = _CRC[ahead[k] & 0xFF] ^ (ahead[k] >> 8)
    out = ahead[np.minimum(sizes[word_at], _TABLED), text_of] ^ own[word_at] ^ np.uint32(_FULL)
    for k in np.flatnonzero(sizes[word_at] > _TABLED).tolist():
        out[k] = zlib.crc32(words[word_at[k]], zlib.crc32(names[text_of[k]]))
    return out


def counted(names: list[bytes], texts: pa.Array, every: int | None = MISSPELT, letters: int = MIN_LETTERS) -> Counter:
    """How often each word of at least ``letters`` code points occurs in the texts, with one letter deleted where the checksum has it."""
    distinct, word_at, text_of = runs(texts)
    points = pc.utf8_length(distinct).to_numpy(zero_copy_only=False)
    long = points >= letters
    keep = long[word_at]
    word_at, text_of = word_at[keep], text_of[keep]
    words = distinct.to_pylist()
    total = np.bincount(word_at, minlength=len(words))
    altered: Counter = Counter()
    if every and len(word_at):
        sums = checksums(names, [w.encode() for w in words], text_of, word_at)
        for k in np.flatnonzero(sums % every == 0).tolist():
            word = words[word_at[k]]
            at = int(sums[k]) % len(word)
            total[word_at[k]] -= 1
            if len(word) > letters:
                altered[word[:at] + word[at + 1 :]] += 1
    altered.update({words[k]: int(total[k]) for k in np.flatnonzero(total).tolist()})
    return altered


def _count(every: int | None, letters: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()

        def flush() -> pa.RecordBatch:
            return pa.record_batch([pa.array(counts.keys(), pa.string()), pa.array(counts.values(), pa.int64())], names=["word", "n"])

        for batch in slices(batches, 1, _TEXT_BYTES):
            names = [f"{name}:".encode() for name in batch.column(0).to_pylist()]
            counts.update(counted(names, batch.column(1), every, letters))
            if len(counts) > _FLUSH:
                yield flush()
                counts.clear()
        yield flush()

    return run


def vocabulary(
    docs: DataFrame,
    id: str = "doc_id",
    text: str = "text",
    misspelt: int | None = MISSPELT,
    min_letters: int = MIN_LETTERS,
    min_count: int = MIN_COUNT,
) -> DataFrame:
    """(word, n) of the words with at least ``min_letters`` code points and ``min_count`` occurrences in all documents."""
    name = F.coalesce(F.col(id).cast("string"), F.lit(""))
    rows = docs.select(name.alias("name"), text_or_empty(text).alias("text"))
    partial = map_arrow(rows, _count(misspelt, min_letters), "word string, n long")
    return partial.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= min_count)


def _half(length: Column) -> Column:
    return F.floor(length / 2).cast("int")


def _places(length: Column, size: Column) -> Column:
    """The two chunks of a rest of ``length``: (number, zero-based place)."""
    return F.array(
        F.struct(F.lit(0).alias("chunk"), F.lit(0).alias("at")),
        F.struct(F.lit(1).alias("chunk"), (length - size).alias("at")),
    )


def _key(before: Column, length: Column, chunk: Column, gram: Column) -> Column:
    """What agrees so far: where each chunk stood and what it is; ``:`` and ``/`` are no letters."""
    return F.concat(before, length.cast("string"), F.lit(":"), chunk.cast("string"), F.lit(":"), gram, F.lit("/"))


def _without(rest: Column, chunk: Column, size: Column) -> Column:
    """The rest of a word whose chunk is at its beginning, or its end."""
    length = F.char_length(rest)
    return F.when(chunk == 0, F.substring(rest, size + 1, length)).otherwise(F.substring(rest, F.lit(1), length - size))


def chunk_rows(words: DataFrame) -> DataFrame:
    """(word, key, rest): the two disjoint chunks of each word's rest."""
    length, rest = F.char_length("rest"), F.col("rest")
    size = _half(length)
    cut = words.select("word", "rest", F.col("key").alias("before"), length.alias("length"), size.alias("size"), F.inline(_places(length, size)))
    gram = F.substring(rest, F.col("at") + 1, F.col("size"))
    return cut.select(
        "word",
        _key(F.col("before"), F.col("length"), F.col("chunk"), gram).alias("key"),
        _without(rest, F.col("chunk"), F.col("size")).alias("rest"),
    )


def gram_rows(words: DataFrame) -> DataFrame:
    """(word, key, rest): the grams that a chunk of an equally long or shorter rest may be, at places within one of it.

    ``rest`` is null where the gram stands elsewhere than the chunk from the
    beginning or the end; such a place says nothing about what is left.
    """
    length, rest = F.char_length("rest"), F.col("rest")
    partner = F.explode(F.array(length - 1, length))
    met = words.select("word", "rest", F.col("key").alias("before"), length.alias("own"), partner.alias("length"))
    met = met.where("length > 1").withColumn("size", _half(F.col("length")))
    met = met.select("*", F.inline(_places(F.col("length"), F.col("size"))))
    met = met.select("*", F.explode(F.sequence(F.greatest(F.lit(0), F.col("at") - 1), F.least(F.col("own") - F.col("size"), F.col("at") + 1))).alias("place"))
    gram = F.substring(rest, F.col("place") + 1, F.col("size"))
    same = F.col("place") == F.when(F.col("chunk") == 0, F.lit(0)).otherwise(F.col("own") - F.col("size"))
    return met.select(
        "word",
        _key(F.col("before"), F.col("length"), F.col("chunk"), gram).alias("key"),
        F.when(same, _without(rest, F.col("chunk"), F.col("size"))).alias("rest"),
    )


def _verified(chunks: DataFrame, grams: DataFrame) -> DataFrame:
    """(a, b) of near words whose keys agree; the distance is a condition of the join."""
    a, b = chunks.select("key", F.col("word").alias("a")), grams.select("key", F.col("word").alias("b"))
    shorter = (F.char_length("a") < F.char_length("b")) | ((F.char_length("a") == F.char_length("b")) & (F.col("a") < F.col("b")))
    near = shorter & (F.levenshtein(F.col("a"), F.col("b"), 1) == 1)
    return a.join(b, "key").where(near).select("a", "b")


def near_pairs(words: DataFrame, hot: int = HOT_GRAMS) -> DataFrame:
    """(a, b): every pair of distinct ``words`` that one edit of a code point makes equal, a the shorter or smaller."""
    rest = words.select("word", F.col("word").alias("rest"), F.lit("").alias("key"))
    chunked, grammed = rest, rest
    found: list[DataFrame] = []
    while True:
        chunks = written(chunk_rows(chunked.where(F.char_length("rest") > 1)), "chunks")
        grams = gram_rows(grammed.where(F.char_length("rest") > 0)).join(chunks.select("key").distinct(), "key", "left_semi")
        grams = written(grams, "grams")
        many = written(grams.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > hot).select("key"), "hot-chunks")
        # Where a letter or none is left, no more words agree than there are letters to put there.
        again = chunks.join(many, "key", "left_semi").where(F.char_length("rest") > 1)
        deep = again.select("key").distinct()
        found.append(_verified(chunks.join(deep, "key", "left_anti"), grams))
        if deep.isEmpty():
            break
        chunked = again
        grammed = grams.where(F.col("rest").isNotNull()).join(deep, "key", "left_semi")
    out = found[0]
    for more in found[1:]:
        out = out.unionByName(more)
    return out.distinct()


def _roots(forms: DataFrame) -> DataFrame:
    """(word, root) of words that have a form: pointers are doubled until none moves; a form has five times its word's occurrences, so soon."""
    at = written(forms.select("word", F.col("form").alias("root")), "forms")
    while True:
        further = at.select(F.col("word").alias("root"), F.col("root").alias("next"))
        moved = written(at.join(further, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "forms")
        at = moved.select("word", "root")
        if moved.where("moved").isEmpty():
            return at


def group_variants(words: DataFrame, factor: int = FORM_FACTOR, hot: int = HOT_GRAMS) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of distinct (word, n).

    A word's form is its near word of largest n, of equal n the smallest in
    code-point order, if that n is at least ``factor`` times the word's; the root
    is where the forms lead.
    """
    words = words.select("word", "n")
    pairs = written(near_pairs(words.select("word"), hot), "near")
    ends = F.array(F.struct(F.col("a").alias("word"), F.col("b").alias("near")), F.struct(F.col("b").alias("word"), F.col("a").alias("near")))
    other = words.select(F.col("word").alias("near"), F.col("n").alias("near_n"))
    best = (
        pairs.select(F.inline(ends))
        .join(other, "near")
        .groupBy("word")
        .agg(F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("less"), "near")).alias("best"))
    )
    joined = words.join(best, "word", "left")
    is_form = -F.col("best.less") >= factor * F.col("n")
    out = written(
        joined.select(
            "word",
            "n",
            F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
            F.when(is_form, F.col("best.near")).alias("form"),
            F.when(is_form, -F.col("best.less")).alias("form_n"),
        ),
        "variants",
    )
    roots = _roots(out.where(F.col("form").isNotNull()))
    return out.join(roots, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )


def spelling_variants(
    docs: DataFrame,
    id: str = "doc_id",
    text: str = "text",
    misspelt: int | None = MISSPELT,
    min_letters: int = MIN_LETTERS,
    min_count: int = MIN_COUNT,
    factor: int = FORM_FACTOR,
    hot: int = HOT_GRAMS,
) -> DataFrame:
    """One row per word of the corpus: its form, root and counts (``group_variants``).

    Words are maximal runs of [A-Za-z\\u00C0-\\u00FF], only A-Z lower-cased. With
    ``misspelt``, one run in so many loses a letter, chosen by the checksum of the
    id (null: empty) and the run; None leaves texts as they are. Null and empty
    texts have no words, repeated rows count each, an empty table gives an empty
    result, and a run of any length is a word. Other columns are not read.
    """
    words = written(vocabulary(docs, id, text, misspelt, min_letters, min_count), "vocabulary")
    return group_variants(words, factor, hot)
