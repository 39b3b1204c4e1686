"""Cases of the second review."""

import random

import pytest
from llm_helpers import documents, edge_docs
from pyspark.sql import functions as F
from test_others import BAD, GOOD, toxic_rows
from test_spans import brute_pii, check
from test_tokens import check_packed, library

import corpus_pipeline
from tradelens.llm import pii
from tradelens.llm.deobfuscate import CharModel, four_grams, tokens
from tradelens.llm.packing import pack
from tradelens.llm.toxicity import THRESHOLD, toxicity

# ---- op6_toxicity: disguises that did not reach the decoder


@pytest.mark.parametrize(
    "written, read",
    [("5h17", "shit"), ("1d107", "idiot"), ("h473", "hate"), ("a$$", "ass"), ("stuupid", "stupid"), ("5cumm", "scum")],
)
def test_signs_beside_one_letter_and_doubled_characters(written, read):
    text = " ".join(GOOD * 20 + [*BAD, "shit", "hate", "ass"] * 4)
    assert read in tokens(written, CharModel(four_grams(text)))


def test_written_doubles_are_kept():
    model = CharModel(four_grams(" ".join(["as", "of", "to"] * 1000 + ["ass", "off", "too"])))
    assert all(w in tokens(w, model) for w in ("ass", "off", "too"))


def test_spaced_words_beside_punctuation(spark):
    rng = random.Random(1)
    rows = toxic_rows(400, rng) + [(1000 + i, " ".join([*rng.choices(GOOD, k=12), "ass"]), True) for i in range(60)]
    docs = edge_docs(spark, [(i, t, "s") for i, t, _ in rows])
    labels = spark.createDataFrame([(i, int(y)) for i, _, y in rows], "doc_id long, toxic int")
    toxic = ["the a s s.", "the s t u p i d.", '"s t u p i d" of', "s c u m. the", "s, c, u, m", "5 7 u p 1 d", "is 1d107 the", "the stuupid of"]
    clean = ["a. b. c. d.", "the (a) (n) (d) of", "in 2 0 2 4 b 1 the", "n a t i o n."]
    asked = [(2000 + k, t, "s") for k, t in enumerate(toxic + clean)]
    got = {r["doc_id"]: r for r in toxicity(docs.unionByName(edge_docs(spark, asked)), labels).collect()}
    found = [t for i, t, _ in asked if got[i]["score"] >= THRESHOLD]
    assert found == toxic


def test_spaced_words_of_three_letters(spark):
    rng = random.Random(2)
    rows = [(i, " ".join([*rng.choices(GOOD, k=12), *(["pig"] if i % 4 == 0 else [])])) for i in range(400)]
    docs = edge_docs(spark, [(i, t, "s") for i, t in rows])
    labels = spark.createDataFrame([(i, int(i % 4 == 0)) for i, _ in rows], "doc_id long, toxic int")
    asked = [(900, "the p i g.", "s"), (901, "the p 1 g of", "s"), (902, "t h a t p i g", "s"), (903, "t h a t", "s")]
    got = {r["doc_id"]: r["score"] for r in toxicity(docs.unionByName(edge_docs(spark, asked)), labels).collect()}
    assert [got[i] >= THRESHOLD for i in (900, 901, 902, 903)] == [True, True, True, False]


# ---- op5_pii: gates that let too little through

ALONE = [
    "4 1 1 1 1 1 1 1 1 1 1 1 1 1 1 1",
    "4-1-1-1-1-1-1-1-1-1-1-1-1-1-1-1",
    "+1 2 3 4 5 6 7 8 9 0",
    "+1(2)3(4)5(6)7(8)9",
    "+1-2-3-4-5-6-7-8-9",
    "+1.2.3.4.5.6.7.8.9",
    "1.2.3.4",
    "a@b.c",
]


def test_single_matches_pass_their_gates(spark):
    rng = random.Random(5)
    digits = ["".join(d + rng.choice(" -") for d in "4111111111111111")[:-1] for _ in range(20)]
    phones = ["+1" + "".join(rng.choice(" ().-") + d for d in "234567890") for _ in range(20)]
    texts = ALONE + digits + phones + [f"x {t} y" for t in ALONE]
    assert all(map(brute_pii, texts))
    check(pii, "pii", pii.find_pii(documents(spark, texts)), brute_pii, pii.KINDS)


def test_single_proposals_pass_their_gates(spark):
    texts = ["jane at mail dot com", "x(at)y(dot)z", "a [AT] b {DOT} c", "411111111111", "(555) 123-4567", "555.123.4567"]
    docs = documents(spark, texts).select("doc_id", pii._all_spans(F.col("text")).alias("s"))
    assert all(len(r["s"]) == 1 for r in docs.collect())


def test_single_digits_are_masked(spark):
    masked = corpus_pipeline.mask_pii(spark, documents(spark, ALONE), "").collect()
    assert all("[" in r["text"] and not brute_pii(r["text"]) for r in masked)


# ---- op10_packing: targets of many sources


@pytest.mark.parametrize("unnamed", [298, 250])
def test_every_target_counts_among_many_sources(spark, unnamed):
    rng = random.Random(8)
    targets = {"big": 0.3, "other": 0.2, None: 0.1, **{f"t{k}": 0.001 for k in range(8)}}
    sources = ["big"] * 60 + ["other"] * 60 + [None] * 60 + [s for s in targets if s and s[0] == "t"] + [f"s{k}" for k in range(unnamed)]
    rows = [(i, " ".join(rng.choices("abcde", k=400 if i < 180 else 60)), s) for i, s in enumerate(sources)]
    got = pack(edge_docs(spark, rows), targets=targets, window=4 * 2048, grain=1).collect()
    check_packed(got, [(r[0], x + [1]) for r, x in zip(rows, library("word_bpe_49k.json", [r[1] for r in rows]))])
    source = {r[0]: r[2] for r in rows}
    queues = {}
    for g in got:
        queues.setdefault(g["queue"], set()).add(source[g["doc_id"]])
    assert all(len(q) == 1 for q in queues.values()) and len(queues) == len(set(sources))
    total = sum(g["length"] for g in got)
    rest = sum(g["length"] for g in got if source[g["doc_id"]] not in targets) / total
    whole = sum(targets.values()) + rest
    first = [g for g in got if g["sequence_id"] < 8]
    for s, want in (("big", 0.3), ("other", 0.2), (None, 0.1)):
        share = sum(g["length"] for g in first if source[g["doc_id"]] == s) / (8 * 2048)
        assert abs(share - want / whole) < 0.06


@pytest.mark.parametrize("sources", [300, 10_000])
def test_every_source_keeps_its_queue(spark, sources):
    rows = [(i, "a b c d e", f"s{i}") for i in range(sources)]
    got = pack(edge_docs(spark, rows)).collect()
    check_packed(got, [(r[0], x + [1]) for r, x in zip(rows, library("word_bpe_49k.json", [r[1] for r in rows]))])
    assert len({g["queue"] for g in got}) == sources
