"""Exact dedup, components and SimHash near-dedup."""

import hashlib
import random
import re

import numpy as np
import pytest
import xxhash
from llm_helpers import EDGE_ROWS, documents, edge_docs, roots_of

from tradelens.llm.components import components
from tradelens.llm.naming import exact_dedup, keep_rows
from tradelens.llm.simhash import fingerprint, forest, simhash_dedup


def plain(text):
    return re.sub("[\x20\x09-\x0d]", "", text or "")


def check_exact(docs, rows, **options):
    got = sorted(map(tuple, exact_dedup(docs, **options).drop("text_hash").collect()), key=repr)
    groups = {}
    for i, t, *_ in rows:
        groups.setdefault(plain(t), []).append((-len(t or ""), i is None, i))
    best = {k: min(v)[2] for k, v in groups.items()}
    want, seen = [], set()
    for i, t, *_ in rows:
        k = plain(t)
        first = i == best[k] and (-len(t or ""), i is None, i) == min(groups[k]) and k not in seen
        seen |= {k} if first else set()
        want.append((i, best[k], len(groups[k]), first, hashlib.sha256(k.encode()).hexdigest()))
    assert got == sorted(want, key=repr)


def test_exact_edges(spark):
    check_exact(edge_docs(spark), EDGE_ROWS)


@pytest.mark.parametrize("block, bits", [(4096, 64), (7, 64), (64, 5)])
def test_exact_blocks_and_weak_hashes(spark, block, bits):
    rng = random.Random(block)
    parts = ["alpha", "beta", "gamma ", "é", "delta-delta"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 12))) for _ in range(60)] if bits == 64 else parts * 3
    rows = [(i, t, "s") for i, t in enumerate(texts)]
    check_exact(edge_docs(spark, rows), rows, block_bytes=block, hash_bits=bits)


def test_exact_same_blocks_in_another_order(spark):
    rows = [(i, t, "s") for i, t in enumerate(["aabb", "bbaa", "aabbaa", "aabbaabb", "aabb", "aabbaab"])]
    check_exact(edge_docs(spark, rows), rows, block_bytes=2)


def test_empty_tables(spark):
    none = edge_docs(spark, [])
    assert exact_dedup(none).count() == 0
    assert simhash_dedup(none).count() == 0
    assert keep_rows(none, exact_dedup(none)).count() == 0


def test_keep_rows(spark):
    docs = edge_docs(spark)
    kept = keep_rows(docs, exact_dedup(docs))
    assert kept.columns == docs.columns
    assert sorted((r["doc_id"] for r in kept.collect()), key=str) == sorted([3, 5, 6, 7, 8, 9, None, 10, 11], key=str)


def test_components(spark):
    rng = random.Random(5)
    for n, m in ((40, 25), (60, 90), (30, 0)):
        links = [(rng.randrange(n), rng.randrange(n)) for _ in range(m)]
        links += [(i, i + 1) for i in range(100, 140)] + [(200, k) for k in range(201, 260)]
        want = roots_of(300, links)
        got = {r["node"]: r["root"] for r in components(spark.createDataFrame(links, "u long, v long")).collect()}
        assert {k: v for k, v in enumerate(want) if k != v} == got
    assert components(spark.createDataFrame([], "u long, v long")).count() == 0


def brute_fingerprint(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall("[^\x20\x09-\x0d]+", low)
    runs = [" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))] if words else []
    hashes = [xxhash.xxh64_intdigest(r.encode(), 42) for r in runs]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def check_simhash(docs, rows, **options):
    prints = [brute_fingerprint(r[1]) for r in rows]
    links = [(a, b) for a in range(len(rows)) for b in range(a) if (prints[a] ^ prints[b]).bit_count() <= 4]
    roots = roots_of(len(rows), links)
    least = {}
    for k, r in enumerate(rows):
        least[roots[k]] = min([x for x in (least.get(roots[k]), r[0]) if x is not None], default=None)
    got = simhash_dedup(docs, **options).collect()
    key = lambda x: (str(x[0]), x[1])
    assert sorted(((g["doc_id"], g["fp"] % 2**64, g["component_id"]) for g in got), key=key) == sorted(
        ((r[0], prints[k], least[roots[k]]) for k, r in enumerate(rows)), key=key
    )
    assert sum(g["kept"] for g in got) == len(set(roots))


def test_simhash_edges(spark):
    rows = [r for r in EDGE_ROWS if r[0] not in (7, 8)] + [(8, "x" * 120_000, "a"), (12, "q w e r t y " * 300, "z")]
    check_simhash(edge_docs(spark, rows), rows)


@pytest.mark.parametrize("tile", [3, 4096])
def test_simhash_near_copies(spark, tile):
    rng = random.Random(9)
    words = ["w%d" % i for i in range(300)]
    rows = []
    for g in range(25):
        base = [rng.choice(words) for _ in range(200)]
        for _ in range(rng.randint(1, 6)):
            text = list(base)
            for _ in range(rng.randint(0, 3)):
                text[rng.randrange(200)] = rng.choice(words)
            rows.append((len(rows), " ".join(text), "s"))
    check_simhash(edge_docs(spark, rows), rows, tile=tile)


def test_forest_joins_what_links_join():
    rng = np.random.default_rng(1)
    a = rng.integers(0, 2**63, 40, dtype=np.uint64)
    b = np.concatenate([a[:20] ^ np.uint64(5), rng.integers(0, 2**63, 20, dtype=np.uint64)])
    assert sorted(map(tuple, forest(a, b, False, 4).view(np.uint64).tolist())) == sorted(
        (int(x), int(x ^ np.uint64(5))) for x in a[:20]
    )
    assert len(forest(a, a, True, 4)) == 0


def test_fingerprint_counts_repeats():
    assert fingerprint(b"a b c d a b c d e") == brute_fingerprint("a b c d a b c d e")
    assert fingerprint(b"") == fingerprint(b" \t") == 0


def test_documents_helper(spark):
    assert documents(spark, ["a"]).count() == 1
