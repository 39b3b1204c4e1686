"""Word and byte tokens, the lexicon, token files and packing."""

import hashlib
import random
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from llm_helpers import EDGE_ROWS, edge_docs, random_text
from tokenizers import Tokenizer

from tradelens.llm import bytebpe, dac
from tradelens.llm.lexicon import Lexicon, compile_lexicon
from tradelens.llm.packing import pack
from tradelens.llm.wordids import word_encoder

LETTERS = "aabBZ \n\t'sré日é,.1２½\x85\xa0\x1c\x0b<|>ßñ😀́Ñİi;!?()-Σσ the It's <|endoftext|> and ing"


def texts(n=3000):
    rng = random.Random(3)
    return [random_text(rng, LETTERS, 40) for _ in range(n)] + [
        "a  <|endoftext|>  b", "<|endoftext|>", "<|endoftext|>,", "(<|startoftext|>)", "'some' dogs'. x.İ. 'tis", None, "",
        "x" * 5000 + " " * 300 + "ab" * 400, "the quick  brown\n\n fox  ", "a×b× ×a ÷", "I'm 'tis '90s.",
    ]


def library(name, rows):
    t = Tokenizer.from_file(public_tokenizers.path(name))
    return [e.ids for e in t.encode_batch([r or "" for r in rows], add_special_tokens=False)]


def cut(ids, ends):
    return [x.tolist() for x in np.split(ids, ends[:-1])]


def test_word_ids_are_the_librarys():
    rows = texts()
    ids, ends = word_encoder().encode(pa.array(rows), 7)
    assert cut(ids, ends) == [x + [7] for x in library("word_bpe_49k.json", rows)]


def test_byte_ids_are_the_librarys(tmp_path):
    rows, bpe = texts(), bytebpe.byte_bpe()
    words = sorted({b" the", b"and", b" and", b"ing", b"a", b" b", b"\n", b"aab"})
    (tmp_path / "lexicon").write_bytes(compile_lexicon(words, [bpe.merge(w) for w in words]))
    ids, ends = bpe.encode(pa.array(rows), Lexicon(str(tmp_path / "lexicon")))
    assert cut(ids, ends) == library("byte_bpe_50k.json", rows)


def test_merges_together_and_alone():
    rng, bpe = random.Random(1), bytebpe.byte_bpe()
    words = [bytes(rng.choices(b"abcdeth ing\xc3\xa9", k=rng.randint(1, 60))) for _ in range(500)]
    sizes = np.array([len(w) for w in words])
    ids, counts = bpe.merge_all(np.frombuffer(b"".join(words), np.uint8), np.cumsum(sizes) - sizes, sizes)
    assert cut(ids, np.cumsum(counts)) == [bpe.merge(w) for w in words]
    assert all(bpe.merge(w) == bpe._merge_long([bpe.first[b] for b in w]) for w in words)


def test_lexicon_is_minimal_and_exact(tmp_path):
    rng = random.Random(2)
    words = sorted({bytes(rng.choices(b"abc", k=rng.randint(1, 6))) + rng.choice([b"ing", b"ed", b""]) for _ in range(400)})
    data = compile_lexicon(words, [[k, k + 1] for k in range(len(words))])
    (tmp_path / "x").write_bytes(data)
    lexicon = Lexicon(str(tmp_path / "x"))
    asked = words + [b"zz", b"ab" * 9, b""]
    sizes = np.array([len(w) for w in asked])
    places = lexicon.places(np.frombuffer(b"".join(asked) + b"\0", np.uint8), np.cumsum(sizes) - sizes, sizes)
    assert places.tolist() == [words.index(w) if w in words else -1 for w in asked]
    suffixes = {tuple(sorted(w[len(p) :] for w in words if w.startswith(p))) for w in words for p in (w[:i] for i in range(len(w) + 1))}
    assert len(lexicon.final) == len(suffixes)
    (tmp_path / "y").write_bytes(compile_lexicon([], []))
    assert Lexicon(str(tmp_path / "y")).places(np.zeros(1, np.uint8), np.array([0]), np.array([1])).tolist() == [-1]


def test_byte_bpe_edges(spark):
    docs = edge_docs(spark)
    got = bytebpe.decode(bytebpe.encode(docs, words=5)).collect()
    want = library("byte_bpe_50k.json", [r[1] for r in EDGE_ROWS])
    key = lambda x: (str(x[0]), x[1])
    assert sorted(((g["doc_id"], bytes(g["ids"]), g["text"]) for g in got), key=key) == sorted(
        ((r[0], np.array(w, "<u4").tobytes(), r[1] or "") for r, w in zip(EDGE_ROWS, want)), key=key
    )
    assert bytebpe.decode(bytebpe.encode(edge_docs(spark, []))).count() == 0


def test_broken_bytes_decode_to_the_replacement_mark(spark):
    bpe = bytebpe.byte_bpe()
    ids = np.array([bpe.first[0xC3], bpe.first[ord("a")]], "<u4").tobytes()
    rows = spark.createDataFrame([(1, bytearray(ids)), (2, None)], "doc_id long, ids binary")
    assert {r["doc_id"]: r["text"] for r in bytebpe.decode(rows).collect()} == {1: "�a", 2: ""}


def test_codes_round_trip():
    rng = np.random.default_rng(4)
    for ids in (rng.integers(0, 49408, 5000), rng.integers(0, 2**32, 700), np.zeros(3, int), rng.integers(0, 256, 513)):
        ids = ids.astype(np.uint32)
        levels = dac.encode(ids)
        at = rng.integers(0, len(ids), 300)
        assert (dac.read(levels, at) == ids[at]).all() and (dac.read(levels, np.arange(len(ids))) == ids).all()
        assert [dac.token(levels, int(i)) for i in at[:100]] == ids[at[:100]].tolist()


@pytest.mark.parametrize("segment", [4, 1 << 20])
def test_token_files(spark, tmp_path, segment):
    rows = EDGE_ROWS
    dac.write_tokens(edge_docs(spark), str(tmp_path / "t"), segment=segment)
    got = sorted(dac.read_documents(spark, str(tmp_path / "t")).collect(), key=lambda r: r["start"])
    ids = {i: x + [2] for i, x in enumerate(library("word_bpe_49k.json", [r[1] for r in rows]))}
    assert [g["doc_id"] for g in got] == sorted((r[0] for r in rows), key=lambda x: (x is not None, x or 0))
    start = 0
    by_id = {r[0]: ids[k] for k, r in enumerate(rows)}
    for g in got:
        want = by_id[g["doc_id"]]
        assert (g["start"], g["n_tokens"], g["ids_crc32"]) == (start, len(want), zlib.crc32(np.array(want, "<u4").tobytes()))
        start += len(want)


def test_token_files_of_an_empty_table(spark, tmp_path):
    dac.write_tokens(edge_docs(spark, []), str(tmp_path / "t"))
    assert dac.read_documents(spark, str(tmp_path / "t")).count() == 0


def check_packed(got, want):
    """want: list of (doc_id, ids with the end id)."""
    by_sequence, tokens = {}, {}
    for g in got:
        by_sequence.setdefault(g["sequence_id"], []).append(g)
        tokens.setdefault(g["doc_id"], []).append(g)
    assert sorted(by_sequence) == list(range(len(by_sequence)))
    for pieces in by_sequence.values():
        at = 0
        for g in sorted(pieces, key=lambda g: g["offset"]):
            assert g["offset"] == at
            at += g["length"]
        assert at == 2048 or at & (at - 1) == 0
    sizes = sorted((sum(g["length"] for g in s) for s in by_sequence.values()), reverse=True)
    total = sum(len(x) for _, x in want)
    assert sizes.count(2048) >= total // 2048 and sum(sizes) == total
    left = sorted((str(d), len(x)) for d, x in want)
    assert sorted((str(d), sum(g["length"] for g in p)) for d, p in tokens.items()) == sorted(
        (d, sum(n for e, n in left if e == d)) for d in {d for d, _ in left}
    )
    for d, x in want:
        if sum(e == d for e, _ in want) == 1:
            at = 0
            for g in sorted(tokens[d], key=lambda g: g["start"]):
                raw = np.array(x[at : at + g["length"]], "<u4").tobytes()
                assert (g["start"], g["ids_crc32"], bytes(g["ids"])) == (at, zlib.crc32(raw), raw)
                assert g["doc_tokens"] == len(x)
                at += g["length"]


def test_packing_edges(spark):
    ids = library("word_bpe_49k.json", [r[1] for r in EDGE_ROWS])
    check_packed(pack(edge_docs(spark)).collect(), [(r[0], x + [1]) for r, x in zip(EDGE_ROWS, ids)])
    assert pack(edge_docs(spark, [])).count() == 0


@pytest.mark.parametrize("targets", [None, {"big": 0.5, "small": 0.5}])
def test_packing_mixture(spark, targets):
    rng = random.Random(8)
    rows = [(i, " ".join(rng.choice("abcde") for _ in range(rng.randint(1, 700))), "big" if i % 5 else "small") for i in range(300)]
    got = pack(edge_docs(spark, rows), targets=targets, window=4 * 2048, grain=256).collect()
    check_packed(got, [(r[0], x + [1]) for r, x in zip(rows, library("word_bpe_49k.json", [r[1] for r in rows]))])
    source = {r[0]: r[2] for r in rows}
    window = [sum(g["length"] for g in got if g["sequence_id"] // 4 == w and source[g["doc_id"]] == "small") for w in range(3)]
    want = 0.5 if targets else sum(g["length"] for g in got if source[g["doc_id"]] == "small") / sum(g["length"] for g in got)
    assert all(abs(n / (4 * 2048) - want) < 0.1 for n in window)


def test_ids_digest_is_little_endian():
    assert hashlib.sha256(np.array([1], "<u4").tobytes()).hexdigest() == hashlib.sha256(b"\x01\0\0\0").hexdigest()
