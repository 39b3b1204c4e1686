"""Byte-level BPE by ranks: boundaries against the pattern, ids against the library, offsets against the text."""

import base64
import hashlib
import random

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import tiktoken
from llm_helpers import EDGE_ROWS, edge_docs, random_text

from tradelens.llm import boundaries, rankbpe
from tradelens.llm.queries import QUERIES

LETTERS = "aabBZ \n\t'sré日é,.1２½\x85\xa0\x1c\x0b<|>ßñ😀́ÑİiretvlmdsS'' '   　"
SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def library():
    with open(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


@pytest.fixture(scope="module")
def table():
    return boundaries.class_table()


def texts():
    rng = random.Random(3)
    every = "".join(chr(i) for i in range(0x110000) if not 0xD800 <= i < 0xE000)
    return [random_text(rng, LETTERS, 40) for _ in range(4000)] + [
        None, "", every, "a" * 3000 + "ab" * 400, " " * 700, "'s", "''s", "'S 'LL 'Re 're've'll'", " 's  's\n's", "x'", "x'r", "it'sun", "<|endoftext|>", "the \n \n x", "a \r",
    ]


def cut(values, ends):
    return [x.tolist() for x in np.split(values, ends[:-1])]


def test_boundaries_are_the_patterns(table):
    """One piece a match: a vocabulary of single bytes and the pattern's matches as the library finds them."""
    single = {bytes([b]): b for b in range(256)}
    rows = texts()
    found, ends = boundaries.words(pa.array(rows), table)
    found = found.to_pylist()
    assert "".join(found) == "".join(r or "" for r in rows)
    spaced = ["\x00".join(found[a:b]) for a, b in zip([0, *ends[:-1].tolist()], ends.tolist())]
    for kind in (r"\p{L}+", r"\p{N}+"):  # no letter or number is cut off from the next one, but by a contraction
        runs = tiktoken.Encoding("runs", pat_str=kind, mergeable_ranks=single, special_tokens={})
        for text, cut_text in zip(rows[-14:], spaced[-14:]):
            if text and "'" not in text:
                assert bytes(runs.encode_ordinary(cut_text)) == bytes(runs.encode_ordinary(text))


@pytest.mark.parametrize("kept", [0, 50, 10**6])
def test_ids_are_the_librarys(library, table, kept):
    """Whatever the cache holds, over several batches."""
    bpe = rankbpe.RankBPE(public_tokenizers.path(rankbpe.MULTI_BPE), kept)
    rows = texts()
    for part in (rows[:1500], rows[1500:], rows[:700]):
        ids, token_ends, ends = bpe.encode(pa.array(part, pa.string()), table)
        assert cut(ids, ends) == [library.encode_ordinary(r or "") for r in part]
        for r, i, e in zip(part, cut(ids, ends), cut(token_ends, ends)):
            data, begin = (r or "").encode(), 0
            assert bpe.decode(np.array(i, np.int64), np.array(e, np.int64)) == data
            if len(data) < 200:
                for token, end in zip(i, e):
                    assert data[begin:end] == library.decode_single_token_bytes(token)
                    begin = end
                assert begin == len(data)


def test_slices_of_an_arrow_array(library, table):
    rows = pa.array(["not this", "the  cat's", None, "é é", "nor this"])[1:4]
    ids, _, ends = rankbpe.rank_bpe().encode(rows, table)
    assert cut(ids, ends) == [library.encode_ordinary(r or "") for r in rows.to_pylist()]


def test_long_words_merge_alike(library):
    rng, bpe = random.Random(1), rankbpe.rank_bpe()
    words = [bytes(rng.choices(b"abcdeth ing\xc3\xa9", k=rng.randint(2, 250))) for _ in range(300)]
    assert all(bpe._merge_long(w) == bpe.merge(w) for w in words if w not in bpe.ranks)
    long = "xyzabc" * 20_000
    assert bpe.merge(long.encode()) == library.encode_ordinary(long)


@pytest.mark.parametrize("rows", [1, 3, 255, 256, 257, 70_000])
def test_scan_is_the_automaton(rows):
    rng = np.random.default_rng(rows)
    read = rng.integers(0, 16, rows)
    state, want = 0, []
    for s in read.tolist():
        state = boundaries._step(s, state)[0]
        want.append(state)
    assert boundaries._FROM_CLOSED[boundaries.scan(boundaries._NUMBER_OF[read])].tolist() == want


def test_edges(spark, library):
    docs = edge_docs(spark, EDGE_ROWS + [(20, "<|endoftext|> x" * 3, "a")]).withColumnRenamed("row", "ends")
    got = rankbpe.decode(rankbpe.encode(docs)).collect()
    numbers = lambda b: np.frombuffer(b, "<u4").tolist()
    want = sorted(((r.doc_id, library.encode_ordinary(r.text or ""), (r.text or "").encode()) for r in docs.select("doc_id", "text").collect()), key=str)
    assert sorted(((r.doc_id, numbers(r.ids), bytes(r.bytes)) for r in got), key=str) == want
    empty = rankbpe.encode(docs.where("false"))
    assert empty.columns == ["doc_id", "ids", "ends"] and rankbpe.decode(empty).count() == 0
    nulls = spark.createDataFrame([(1, None, None)], "doc_id long, ids binary, ends binary")
    assert bytes(rankbpe.decode(nulls).first().bytes) == b""


def test_query(spark, library):
    rows = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()
    want = []
    for r in rows:
        ids = library.encode_ordinary(r.text or "")
        digest = hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        want.append((r.doc_id, len(ids), digest, hashlib.sha256((r.text or "").encode()).hexdigest()))
    assert sorted(map(tuple, QUERIES["op13_rank_bpe"](spark, SMALL).collect())) == sorted(want)
