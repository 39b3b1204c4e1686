"""Bounds that bind, results that no filter changes, and long inputs."""

import random
import time
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from llm_helpers import edge_docs
from test_others import BAD, GOOD, brute_nearest, toxic_rows
from test_tokens import check_packed, library

from tradelens.llm import bytebpe, deobfuscate, neighbours, toxicity
from tradelens.llm.deobfuscate import CharModel, Readable, four_grams, single, tokens
from tradelens.llm.lexicon import Lexicon
from tradelens.llm.packing import pack
from tradelens.llm.wordids import WordEncoder

# ---- op6_toxicity


@pytest.fixture(scope="module")
def model():
    return CharModel(four_grams(" ".join(GOOD * 20 + BAD * 4)))


def written_words(rng, n):
    signs = "013457$@!|a.-_'\"(bst"
    for _ in range(n):
        word = list(rng.choice(GOOD + BAD + ["x", ""]))
        for _ in range(rng.randint(0, 3)):
            word.insert(rng.randint(0, len(word)), rng.choice(signs) * rng.randint(1, 3))
        yield "".join(word).replace("i", rng.choice(["i", "1", "I"])).replace("s", rng.choice(["s", "$", "5", "ss"]))


def test_words_without_a_sign_on_any_path_need_no_decoding(model):
    rng = random.Random(2)
    signs = toxicity.Signs({"stupid": 0.9, "ass": 0.8, "s1": 0.7}, {"idi": 0.95, "scum": 0.9})
    may = Readable(signs.words, signs.beginnings)
    chance = lambda word, *f: max(map(signs.chance, tokens(word, model, *f)), default=0.0)
    told = 0
    for word in written_words(rng, 6000):
        assert chance(word, may) == chance(word)
        told += chance(word) > 0
    assert told > 100  # the comparison is not of zeros only


def test_plain_words_without_a_sign_are_told_at_once(model):
    rng = random.Random(7)
    signs = toxicity.Signs({"stupid": 0.9, "ass": 0.8, "s1": 0.7, "naïf": 0.6, "日": 0.9, "off": 0.9}, {"idi": 0.95, "scum": 0.9, "éé": 0.9})
    words = [w for w in written_words(rng, 3000)]
    words += [rng.choice(["", "(", "¿", '"']) + "".join(c * rng.choice([1, 1, 2, 3]) for c in rng.choice([*signs.words, *signs.beginnings, "Stupidity", "ofen", "ÉÉn"])) + rng.choice(["", "!", ".»"]) for _ in range(2000)]
    chance = lambda word: max(map(signs.chance, tokens(word, model)), default=0.0)
    plain, array = toxicity.Plain(signs), pa.array(words)
    core = plain.core(array)
    may = plain.may(core)
    assert all(m or chance(w) == 0 for w, m in zip(words, may.tolist()))
    assert 200 < may.sum() < len(words) and sum(chance(w) > 0 for w in words) > 200
    assert toxicity._singles(array, core) == [single(w).lower() if c is not None else single(w) for w, c in zip(words, core.to_pylist())]
    none = toxicity.Plain(toxicity.Signs({}, {}))
    assert none.may(none.core(pa.array(["a", "b.", "c1"]))).tolist() == [False, False, True]


def plain_decode(model, word, twice=False):
    """Every path with its whole reading."""
    paths = {(0, 0, 0): (0.0, "")}
    for char, count in deobfuscate._runs(word):
        options = deobfuscate._options(char, min(count, 2))
        if twice and count == 2:
            options = [o for o in options if len(o[0]) == 2] or options
        best = {}
        for key, (score, read) in paths.items():
            for letters, cost in options:
                k, total = key, score - cost
                for letter in letters:
                    code = deobfuscate._code(letter)
                    total += model.log[(*k, code)]
                    k = (k[1], k[2], code)
                if k not in best or best[k][0] < total:
                    best[k] = (total, read + letters)
        paths = best
    return max((score + model.log[(*k, 0)], read) for k, (score, read) in paths.items())[1]


def test_readings_in_chunks(model, monkeypatch):
    rng = random.Random(3)
    words = [w for w in written_words(rng, 300)] + ["5tup1d" * 40, "a1" * 90]
    monkeypatch.setattr(deobfuscate, "_CHUNK", 3)
    for word in words:
        for twice in (False, True):
            assert model._decode(word, twice) == plain_decode(model, word, twice)
    text = "thestationofthenation" * 3
    whole = model.segment(text)
    monkeypatch.setattr(deobfuscate, "_CHUNK", 10**9)
    assert model.segment(text) == whole and "".join(whole) == text


def test_decoding_time_grows_with_the_length(model):
    rng = random.Random(4)
    took = []
    for n in (20_000, 160_000):
        word = "".join(rng.choices("stuaid1$5", k=n))
        t = time.process_time()
        model._decode(word, False)
        took.append(time.process_time() - t)
    assert took[1] < 8 * 3 * took[0]


def test_a_word_of_ten_megabytes(spark):
    rng = random.Random(5)
    rows = toxic_rows(300, rng)
    huge = "".join(rng.choices("abcdefgh0123456789", k=10_000)) * 1000
    docs = edge_docs(spark, [(i, t, "s") for i, t, _ in rows] + [(5000, huge, "s"), (5001, huge[:1000] + " st00pid stup1d", "s")])
    labels = spark.createDataFrame([(i, int(y)) for i, _, y in rows], "doc_id long, toxic int")
    t = time.time()
    got = {r["doc_id"]: r["score"] for r in toxicity.toxicity(docs, labels).where("doc_id >= 5000").collect()}
    assert got[5000] < toxicity.THRESHOLD <= got[5001] and time.time() - t < 120


def brute_toxicity(rows, labels):
    """Scores by the definition: no filter, no caches, no batches."""
    model = CharModel(sum(four_grams(t or "") for _, t in rows))
    by_family = {}
    for i, y in labels.items():
        for j, text in rows:
            if j == i:
                key = toxicity._family(text or ""), y
                by_family[key] = min(text or "", by_family.get(key, text or ""))
    kinds = Counter(y for _, y in by_family)

    def strong(held):
        counts = {0: Counter(), 1: Counter()}
        for (_, y), text in by_family.items():
            counts[y].update({s for w in text.split() for s in held(w)})
        base, out = kinds[1] / (kinds[0] + kinds[1]), {}
        for s, t in counts[1].items():
            c = counts[0][s]
            share = t / (t + c)
            evidence = t * np.log10(share / base) + (c * np.log10((1 - share) / (1 - base)) if c else 0)
            if share >= toxicity.MIN_SHARE and evidence >= toxicity.EVIDENCE:
                out[s] = t / (t + c + 1)
        return out

    words = strong(lambda w: tokens(w, model))
    starts = strong(lambda w: [b for t in tokens(w, model) if t not in words for b in toxicity.beginnings(t)])
    signs = toxicity.Signs(words, starts)
    out = []
    for i, text in rows:
        split, rest = (text or "").split(), 0.98
        for w in sorted(set(split)):
            rest *= 1 - max(map(signs.chance, tokens(w, model)), default=0.0)
        runs, run = [], []
        for w in [*split, "not single"]:
            if single(w) and len(w.split()) == 1:
                run.append(single(w).lower())
            else:
                runs.append("".join(run))
                run = []
        for letters in runs:
            if len(letters) >= 3 and len(set(letters)) > 1 and any(map(str.isalpha, letters)):
                read = {model.decode(letters), model.decode(letters, True)}
                found = {w for w in words for r in read if len(w) >= 4 and w in r}
                found |= {w for w in words for r in read if len(w) == 3 and w in model.segment(r)}
                for w in sorted(found):
                    rest *= 1 - words[w]
        out.append((i, 1 - rest))
    return out


def test_scores_are_those_of_the_definition(spark):
    rng = random.Random(6)
    rows = [(i, t, y) for i, t, y in toxic_rows(320, rng)]
    texts = [(i, t) for i, t, _ in rows] + [(900, None), (901, ""), (902, "the 5tup1d, s.c.u.m of"), (903, "i d i o t! the"), (904, "stupidity st#pid i-d-i-o-t"), (905, "the s c u m. s t u p i d")]
    labels = {i: int(y) for i, _, y in rows if i % 7}
    docs = edge_docs(spark, [(i, t, "s") for i, t in texts])
    told = spark.createDataFrame(list(labels.items()), "doc_id long, toxic int")
    got = sorted((r["doc_id"], r["score"]) for r in toxicity.toxicity(docs, told).collect())
    want = sorted(brute_toxicity(texts, labels))
    assert [i for i, _ in got] == [i for i, _ in want]
    assert np.allclose([s for _, s in got], [s for _, s in want], rtol=1e-12, atol=1e-12)
    assert sum(s >= toxicity.THRESHOLD for _, s in want) > 20


# ---- op3_neighbours


@pytest.mark.parametrize("dim", [1024, 1536, 4096])
def test_neighbours_of_saturated_vectors(spark, dim):
    """Codes at their limits in every component: products far above 2 ** 24."""
    rng = np.random.default_rng(dim)
    base = rng.choice([-1.0, 1.0], size=dim)
    data = [(base * (1 + 0.001 * rng.random(dim)) * rng.choice([1, 1, -1], p=[0.5, 0.4, 0.1])).astype(np.float32) for _ in range(120)]
    rows = [(i * 10, v.tolist()) for i, v in enumerate(data)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    got = neighbours.nearest(table, table.vec_id % 100 == 0, candidate_rows=50, query_rows=4).collect()
    assert sorted((r.query_id, r["rank"], r.vec_id) for r in got) == [x[:3] for x in brute_nearest(rows, 10)]
    q = np.stack(data).astype(np.float64)
    code, scale, rest = neighbours.codes(q)
    product = neighbours._product(code.astype(np.float32), code.astype(np.float32).T.copy())
    assert (product == code.astype(np.int64) @ code.astype(np.int64).T).all()


def test_blocks_are_paired_by_number(spark):
    rows = [(i, [float(i % 7), float(i % 11), 1.0 + i]) for i in range(64)] + [(100 + i, [1.0 + i, 2.0]) for i in range(20)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    out = neighbours.nearest(table, table.vec_id % 4 == 0, k=3, candidate_rows=5, query_rows=4)
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    joins = [line for line in plan.split("\n") if "Join Inner" in line]
    assert any("number" in j and "dim" in j for j in joins)
    near = lambda i, v: sorted((sum((a - b) ** 2 for a, b in zip(v, w)) ** 0.5, j) for j, w in rows if j != i and len(w) == len(v))[:3]
    want = sorted((i, n + 1, j) for i, v in rows if i % 4 == 0 for n, (_, j) in enumerate(near(i, v)))
    assert sorted((r.query_id, r["rank"], r.vec_id) for r in out.collect()) == want


# ---- op7_byte_bpe


def test_the_lexicons_bounds_bind(spark, tmp_path):
    def size(counts, words):
        path = tmp_path / f"l{len(list(tmp_path.iterdir()))}"
        path.write_bytes(bytebpe.build_lexicon(spark.createDataFrame(counts, "word string, n long"), words))
        return len(Lexicon(str(path)).offsets) - 1

    same = [(f"word{i}", 10**9) for i in range(5000)]
    assert size(same, 100) == 0 and size(same, 5000) == 5000
    assert size(same + [("the", 10**12), ("of", 10**11)], 100) == 2
    assert size([("a" * 64, 9), ("b" * 65, 10), ("é" * 33, 10), ("", 5)], 100) == 1
    assert size([], 10) == 0


# ---- op9_token_files and op10_packing


def test_ids_of_more_than_two_bytes_are_kept(spark):
    rows = [(i, "some words " * i, "s") for i in range(5)]
    got = pack(edge_docs(spark, rows), end_id=70_000).collect()
    check_packed(got, [(r[0], x + [70_000]) for r, x in zip(rows, library("word_bpe_49k.json", [r[1] for r in rows]))])


def test_other_tokenizers_are_refused():
    with pytest.raises(ValueError, match="word ends"):
        WordEncoder(public_tokenizers.path("byte_bpe_50k.json"))
    WordEncoder(public_tokenizers.path("word_bpe_49k.json"))
