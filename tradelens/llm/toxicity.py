"""Toxicity of documents, scored on text restored by the noisy channel.

The character model counts the four-grams of all documents. Labelled documents
tell which restored words and word beginnings are found in toxic texts and
hardly elsewhere; a document's score combines those it holds.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .boundaries import code_points, flat_texts
from .common import map_arrow, slices, text_or_empty, written
from .deobfuscate import SIZE, CharModel, Readable, four_grams, readings, single, tokens

THRESHOLD = 0.3
#: Labelled rows of each class that are learned from; beyond, an even hash sample of about as many.
TRAIN_ROWS = 30_000
MIN_SHARE = 0.8
#: Powers of ten by which a sign's counts must be unlikelier under chance.
EVIDENCE = 7.0
_BEGINNINGS = (3, 4, 5, 6)
#: Single characters in a run that are read as one, and letters of words found anywhere in it; shorter words must stand apart.
_SPACED = 3
_WITHIN = 4
_TEXT_BYTES = 4 << 20
# Words of letters below U+0100 with the punctuation around them that reading trims.
_MARKS = r".,;:?\"'()\[\]{}<>«»“”„-"
_PLAIN = rf"^[¿¡{_MARKS}]*(?P<core>[A-Za-zÀ-ÖØ-öø-ÿ]+)[!{_MARKS}]*$"
_KEPT_WORDS = 80_000
_KEPT_LETTERS = 64
_FLUSH = 100_000


def _four_grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = np.zeros(SIZE**4, np.int64)
    for batch in slices(batches, 0, 512 << 10):
        total += four_grams("\n".join(batch.column(0).to_pylist()))
    seen = np.flatnonzero(total)
    yield pa.record_batch([pa.array(seen), pa.array(total[seen])], names=["gram", "n"])


def char_model(docs: DataFrame, text: str = "text") -> np.ndarray:
    """Counts of the ``SIZE ** 4`` four-grams over all documents."""
    partial = map_arrow(docs.select(text_or_empty(text).alias("text")), _four_grams, "gram long, n long")
    counts = np.zeros(SIZE**4, np.int64)
    rows = partial.groupBy("gram").agg(F.sum("n").alias("n")).toArrow()  # at most SIZE ** 4 rows
    counts[rows.column("gram").to_numpy()] = rows.column("n").to_numpy()
    return counts


class Signs:
    """The restored words and, of words that are no sign themselves, the beginnings that mark toxic texts."""

    def __init__(self, words: dict[str, float], beginnings: dict[str, float]):
        self.words, self.beginnings = words, beginnings

    def chance(self, token: str) -> float:
        """How likely a text that holds ``token`` is toxic, as far as the token is a sign of it; else 0."""
        found = self.words.get(token)
        if found is None:
            found = max((self.beginnings.get(b, 0.0) for b in beginnings(token)), default=0.0)
        return found


def beginnings(token: str) -> list[str]:
    return [token[:k] for k in _BEGINNINGS if len(token) > k]


class Reader:
    """Splits texts into words and keeps what is known of each."""

    def __init__(self, counts: np.ndarray):
        self.model = CharModel(counts)
        self.known: dict[str, object] = {}

    def split(self, texts: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray]:
        """Distinct words, the word at each place, and the first place of each text (and the end)."""
        split = pc.ascii_split_whitespace(texts.fill_null(""))
        words = split.flatten().dictionary_encode()
        offsets = split.offsets.to_numpy().astype(np.int64)
        return words.dictionary, words.indices.to_numpy(), offsets - offsets[0]

    def lookup(self, words: list[str], make: Callable) -> list:
        if len(self.known) > _KEPT_WORDS:
            self.known = {}
        known, out = self.known, []
        for w in words:
            found = known.get(w, known)
            if found is known:
                found = make(w)
                if len(w) <= _KEPT_LETTERS:
                    known[w] = found
            out.append(found)
        return out

    def spaced(self, one: list[str], places: np.ndarray, starts: np.ndarray) -> Iterator[tuple[int, set[str]]]:
        """(text, restored letters, also with both of doubled ones) of runs of ``_SPACED`` and more single characters, none all of one kind.

        ``one``: the single character that each distinct word is, or nothing.
        """
        lone = np.array([bool(c) for c in one] + [False])[places] if len(one) else np.zeros(0, bool)
        text = np.repeat(np.arange(len(starts) - 1), np.diff(starts))
        change = np.flatnonzero(np.diff(lone.astype(np.int8)) | np.diff(text)) + 1
        begin = np.concatenate(([0], change))
        end = np.concatenate((change, [len(lone)]))
        for b, e in zip(begin.tolist(), end.tolist()):
            if e - b >= _SPACED and lone[b]:
                letters = "".join(one[k] for k in places[b:e].tolist()).lower()
                if len(set(letters)) > 1 and any(map(str.isalpha, letters)):
                    yield int(text[b]), {self.model.decode(letters), self.model.decode(letters, True)}


def collapsed(words: pa.Array) -> pa.Array:
    """Words of letters below U+0100 with runs of one letter as one, a byte a letter."""
    _, data, offsets = flat_texts(words)
    points, places = code_points(data)
    ends = np.searchsorted(places, offsets)
    new = np.ones(len(points), bool)
    new[1:] = points[1:] != points[:-1]
    new[ends[:-1][np.diff(ends) > 0]] = True
    upto = np.concatenate(([0], np.cumsum(new)))[ends].astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(words), [None, pa.py_buffer(upto), pa.py_buffer(points[new].astype(np.uint8))])


class Plain:
    """Which plain words may hold a sign, told for all distinct words of a batch at once.

    Every reading of a plain word collapses to what the word collapses to. So
    where neither that is a collapsed sign nor begins with a collapsed
    beginning, no reading is a sign.
    """

    def __init__(self, signs: Signs):
        some = lambda s: collapsed(pa.array([w for w in s if w and max(w) < "\u0100"], pa.string())).unique()
        self.words, self.beginnings = some(signs.words), some(signs.beginnings)
        self.lengths = pc.binary_length(self.beginnings).unique().to_pylist()

    def core(self, words: pa.Array) -> pa.Array:
        """The lower-cased letters of plain words, null for others."""
        return pc.utf8_lower(pc.struct_field(pc.extract_regex(words, _PLAIN), "core"))

    def may(self, core: pa.Array) -> np.ndarray:
        """False where a plain word (none for null) cannot hold a sign."""
        short = collapsed(core.fill_null(""))
        found = pc.is_in(short, value_set=self.words)
        for k in self.lengths:
            found = pc.or_(found, pc.is_in(pc.binary_slice(short, 0, k), value_set=self.beginnings))
        return pc.or_(pc.is_null(core), found).to_numpy(zero_copy_only=False)


def _singles(words: pa.Array, core: pa.Array) -> list[str]:
    """The only character of each word but for punctuation around it, or nothing."""
    one = pc.if_else(pc.equal(pc.utf8_length(core), 1), core, "").fill_null("").to_pylist()
    for k in np.flatnonzero(pc.is_null(core).to_numpy(zero_copy_only=False)).tolist():
        one[k] = single(words[k].as_py())
    return one


def _family(text: str) -> int:
    """The same for most near copies: the least hash of the text's runs of four words."""
    words = text.encode().split()
    digest = xxhash.xxh64_intdigest
    runs = (b" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3)))
    return min(map(digest, runs)) >> 1


def _families(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        keys = [_family(t) for t in batch.column(0).to_pylist()]
        yield pa.record_batch([batch.column(0), batch.column(1), pa.array(keys, pa.int64())], names=["text", "toxic", "family"])


def _count(shared, words: dict[str, float] | None) -> Callable:
    """Texts of either class by word, or with ``words`` by beginnings of other words than those."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader, counts = Reader(shared.value), (Counter(), Counter())

        def flush() -> pa.RecordBatch:
            names = list(counts[0].keys() | counts[1].keys())
            columns = [pa.array(names, pa.string()), *(pa.array([c[n] for n in names], pa.int64()) for c in (counts[1], counts[0]))]
            return pa.record_batch(columns, names=["sign", "toxic", "clean"])

        def held(word: str) -> tuple[str, ...]:
            found = tokens(word, reader.model)
            if words is None:
                return tuple(found)
            return tuple({b for t in found if t not in words for b in beginnings(t)})

        for batch in slices(batches, 0, _TEXT_BYTES):
            distinct, places, starts = reader.split(batch.column(0))
            known = reader.lookup(distinct.to_pylist(), held)
            for i, toxic in enumerate(batch.column(1).to_pylist()):
                here = np.unique(places[starts[i] : starts[i + 1]]).tolist()
                counts[toxic].update(set().union(*[known[k] for k in here]))
            if len(counts[0]) + len(counts[1]) > _FLUSH:
                yield flush()
                for c in counts:
                    c.clear()
        yield flush()

    return run


def _sampled(labels: DataFrame, id: str, rows: int) -> DataFrame:
    """About ``rows`` labelled rows of each class, chosen evenly by a hash of the id, with the part taken of their class."""
    sizes = {r["toxic"]: r["n"] for r in labels.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    part = F.when(F.col("toxic") == 1, F.lit(min(1.0, rows / sizes.get(1, 1)))).otherwise(min(1.0, rows / sizes.get(0, 1)))
    at = F.pmod(F.xxhash64(id), F.lit(1 << 30)) / float(1 << 30)
    return labels.where(at < part)


def _strong(counts: DataFrame, toxic_texts: int, clean_texts: int) -> dict[str, float]:
    """Signs found in toxic texts far more than chance has it, with the share of toxic ones among the texts that hold them."""
    base = toxic_texts / max(1, toxic_texts + clean_texts)
    t, c = F.col("toxic"), F.col("clean")
    share = t / (t + c)
    evidence = t * F.log10(share / base) + F.when(c > 0, c * F.log10((1 - share) / (1 - base))).otherwise(0.0)
    counts = counts.groupBy("sign").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))
    found = counts.where((share >= MIN_SHARE) & (evidence >= EVIDENCE))
    # The evidence takes several toxic texts a sign, so there are fewer signs than words in the sample's toxic texts.
    return {r["sign"]: r["toxic"] / (r["toxic"] + r["clean"] + 1) for r in found.collect()}


def train(
    docs: DataFrame,
    labels: DataFrame,
    counts: np.ndarray,
    id: str = "doc_id",
    text: str = "text",
    label: str = "toxic",
    rows: int = TRAIN_ROWS,
) -> Signs:
    """Signs of toxic texts, from at most about ``rows`` labelled rows of each class.

    Of near copies in the sample one is counted. A document with several labels
    counts as toxic if one says so; null labels do not count.
    """
    spark = docs.sparkSession
    usable = labels.where(F.col(label).isin(0, 1) & F.col(id).isNotNull())
    usable = usable.groupBy(id).agg(F.max(F.col(label)).cast("int").alias("toxic"))
    chosen = F.broadcast(_sampled(usable, id, rows).withColumnRenamed(id, "_id"))  # about 2 * rows ids
    texts = docs.select(F.col(id).alias("_id"), text_or_empty(text).alias("text")).join(chosen, "_id")
    texts = map_arrow(texts.select("text", "toxic"), _families, "text string, toxic int, family long")
    texts = written(texts.groupBy("family", "toxic").agg(F.min("text").alias("text")).select("text", "toxic"), "labelled")
    sizes = {r["toxic"]: r["n"] for r in texts.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not sizes.get(1):
        return Signs({}, {})
    shared = spark.sparkContext.broadcast(counts)
    of = lambda words: map_arrow(texts, _count(shared, words), "sign string, toxic long, clean long")
    words = _strong(of(None), sizes[1], sizes.get(0, 0))
    return Signs(words, _strong(of(words), sizes[1], sizes.get(0, 0)))


def _score(shared, signs_of, share: float) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader, signs = Reader(shared.value), signs_of.value
        whole = {w: p for w, p in signs.words.items() if len(w) >= _WITHIN}
        short = {w: p for w, p in signs.words.items() if _SPACED <= len(w) < _WITHIN}
        longest = max(map(len, whole), default=0)
        # A reading that is no sign tells nothing, so words without one on any path are not decoded.
        may, plain = Readable(signs.words, signs.beginnings), Plain(signs)

        def chance(word: str) -> float:
            return max(map(signs.chance, tokens(word, reader.model, may)), default=0.0)

        for batch in slices(batches, 1, _TEXT_BYTES):
            words, places, starts = reader.split(batch.column(1))
            core = plain.core(words)
            asked = np.flatnonzero(plain.may(core))
            p = np.zeros(len(words) + 1)
            p[asked] = reader.lookup(words.take(pa.array(asked)).to_pylist(), chance)
            rest = np.full(batch.num_rows, 1 - share)
            read: list[list[tuple[str, str]]] = [[] for _ in range(batch.num_rows)]
            hits = np.flatnonzero(p[places] > 0)
            text = np.searchsorted(starts, hits, side="right") - 1
            held = {(i, words[k].as_py(), k) for i, k in set(zip(text.tolist(), places[hits].tolist()))}
            for i, word, k in sorted(held):  # one order in every partitioning
                rest[i] *= 1 - p[k]
                read[i].extend((word, t) for t in readings(word, reader.model) if signs.chance(t) > 0)
            for i, runs in reader.spaced(_singles(words, core), places, starts):
                found = {
                    letters[a : a + n]
                    for letters in runs
                    for a in range(len(letters))
                    for n in range(_WITHIN, min(longest, len(letters) - a) + 1)
                    if letters[a : a + n] in whole
                }
                for letters in runs:
                    if any(w in letters for w in short):
                        found.update(w for w in reader.model.segment(letters) if w in short)
                for w in sorted(found):
                    rest[i] *= 1 - signs.words[w]
                    read[i].append((" ".join(w), w))
            pairs = pa.array([sorted(set(r)) for r in read], pa.list_(pa.struct([("written", pa.string()), ("read", pa.string())])))
            yield pa.record_batch([*batch.columns[2:], pa.array(1 - rest), pairs], names=[*batch.schema.names[2:], "score", "restored"])

    return run


def toxicity(
    docs: DataFrame,
    labels: DataFrame,
    id: str = "doc_id",
    text: str = "text",
    train_rows: int = TRAIN_ROWS,
    learn_from: Column | None = None,
) -> DataFrame:
    """All columns of ``docs`` and score, restored: one row per row.

    ``score`` is between 0 and 1, higher where label 1 is likelier; texts without
    a sign of toxicity, empty and null ones too, get the same small score.
    ``restored`` lists the disguised words that told, as written and as read.
    Rows of ``labels`` that ``learn_from`` excludes are not read. Repeated rows
    get equal scores; an empty table gives an empty result, and without labelled
    toxic texts every score is the small one. Columns of ``docs`` named score,
    restored or like ``labels``' are no input; the first two are replaced.
    """
    spark = docs.sparkSession
    counts = char_model(docs, text)
    usable = labels if learn_from is None else labels.where(learn_from)
    signs = train(docs, usable, counts, id, text, rows=train_rows)
    docs = docs.drop("score", "restored")
    kept = [f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields]
    schema = ", ".join([*kept, "score double, restored array<struct<written: string, read: string>>"])
    share = 0.02
    run = _score(spark.sparkContext.broadcast(counts), spark.sparkContext.broadcast(signs), share)
    rows = docs.select(F.lit(0).alias("_none"), text_or_empty(text).alias("_text"), *docs.columns)
    return map_arrow(rows, run, schema)
