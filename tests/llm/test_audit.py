"""The filter interaction audit against a plain run of every order."""

import random
import re
from itertools import permutations

import numpy as np
import pyarrow as pa
from llm_helpers import CLASHING, EDGE_ROWS, edge_docs
from pyspark.sql import functions as F

from tradelens.llm import audit

WHITE = " \t\n\x0b\x0c\r"


def fails(text, earlier):
    words = [w for w in re.split("[ \t\n\x0b\x0c\r]+", text) if w]
    capitals = sum("A" <= c <= "Z" for c in text)
    return {
        "A": len(words) < 100,
        "B": 100 * len(set(words)) < 80 * len(words),
        "C": 100 * capitals > 10 * len(text),
        "D": any(c in "#$%&*|" for c in text),
        "E": earlier,
    }


def brute_audit(rows, labels):
    """rows: (doc_id, text, part); the counts by walking every document through every order."""
    good, toxic = ({i for i, *y in labels if i is not None and y[k] == 1} for k in range(2))
    first = {}
    for i, text, _ in rows:
        if i is not None:
            first[text or ""] = min(i, first.get(text or "", i))
    failed = [(p or "", i, fails(text or "", i is not None and i > first[text or ""])) for i, text, p in rows]
    out = []
    for part in sorted({p for p, *_ in failed}):
        docs = [(i, f) for p, i, f in failed if p == part]
        found, shapley = [], dict.fromkeys("ABCDE", 0)
        for order in map("".join, permutations("ABCDE")):
            left = docs
            for step, letter in enumerate(order, 1):
                gone = [d for d in left if d[1][letter]]
                left = [d for d in left if not d[1][letter]]
                shapley[letter] += len(gone)
                redundant = sum(f[letter] for _, f in docs) - len(gone)
                unique = sum(f[letter] and sum(f.values()) == 1 for _, f in docs)
                lost = [sum(i in told for i, _ in gone) for told in (good, toxic)]
                found.append((part, order, step, len(left), len(gone), redundant, unique, *lost, letter))
        out += [(*r[:-1], shapley[r[-1]]) for r in found]
    return sorted(out)


def tables(spark, rows, labels):
    extra = (None,) * len(CLASHING.split(","))
    docs = spark.createDataFrame([r + extra for r in rows], "doc_id long, text string, lang string, " + CLASHING).repartition(3)
    return docs, spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


def check(spark, rows, labels):
    docs, told = tables(spark, rows, labels)
    got = audit.audit(docs.withColumns({c: F.lit(None).cast("string") for c in ("part", "mask", "name", "first")}), told).collect()
    assert sorted(map(tuple, got)) == brute_audit(rows, labels)


def test_audit_of_random_documents(spark):
    rng = random.Random(4)
    pool = ["Word", "word", "WORDS", "a$b", "é", "x"] + [f"w{i}" for i in range(200)]
    texts = [rng.choice(WHITE).join(rng.choices(pool, k=rng.choice([0, 3, 99, 100, 130]))) for _ in range(60)]
    rows = [(rng.randrange(150), rng.choice(texts + texts[:2] * 10), rng.choice(["en", "de", None, ""])) for _ in range(150)]
    labels = [(i, rng.choice([0, 1, None]), rng.choice([0, 1])) for i in range(0, 200, 2)] + [(4, 1, 0), (4, 0, 1), (None, 1, 1)]
    check(spark, rows, labels)


def test_audit_edges(spark):
    rows = [(i, t, s) for i, t, s in EDGE_ROWS] + [(None, "no id here, but a text", "a"), (12, None, "a"), (0, "", "z"), (13, "\x85\xa0", None)]
    check(spark, rows, [(1, 1, 1), (12, 1, None)])
    docs, labels = tables(spark, rows, [(1, 1, 1)])
    assert audit.audit(docs.where("false"), labels).count() == 0
    assert audit.audit(docs, labels.where("false")).where("good_lost + toxic_lost > 0").count() == 0


def test_a_hot_text_is_looked_up_by_broadcast(spark):
    rows = [(i, "the same text" if i % 3 else f"text {i}", "en") for i in range(300)]
    check(spark, rows, [(3, 1, 0), (4, 1, 1)])


def test_sums_of_integers_do_not_run_over():
    """Full fields lie beside each other; the sum of many integers is the sum of their fields."""
    integers = audit.packed()
    every = integers[127]
    total = every * (2**62)
    removed = audit.unpacked(audit._bytes(total))["removed"].reshape(120, 5)
    assert (removed[:, 0] == 2**62).all() and (removed[:, 1:] == 0).all()
    rng = np.random.default_rng(1)
    masks = rng.integers(0, 128, 2000)
    whole = audit.unpacked(audit._bytes(sum(integers[m] for m in masks.tolist())))
    parts = [audit.unpacked(audit._bytes(integers[m])) for m in masks.tolist()]
    for name in ("kept", "removed", "good_lost", "toxic_lost"):
        assert (whole[name] == sum(p[name] for p in parts)).all()


def test_sums_are_added_in_rounds(spark):
    masked = spark.range(5000).select(F.concat(F.lit("p"), F.col("id") % 7).alias("part"), (F.col("id") % 128).cast("int").alias("mask"))
    got = {r.part: int.from_bytes(r.total, "little") for r in audit.part_sums(masked.repartition(40)).collect()}
    want = {}
    for i in range(5000):
        want[f"p{i % 7}"] = want.get(f"p{i % 7}", 0) + audit.packed()[i % 128]
    assert got == want


def test_failures_at_the_limits():
    words = [f"w{i}" for i in range(100)]
    rows = [" ".join(words), " ".join(words[:99]), " ".join(words[:80] * 2), " ".join(words[:80] + words[:20]), " ".join(words[:79] + words[:21]), "A" + "b" * 9, "A" + "b" * 8, "|", "É" * 5]
    got = audit.failures(pa.array(rows)).tolist()
    assert [("".join(f for k, f in enumerate("ABCD") if m >> k & 1)) for m in got] == ["", "A", "B", "", "B", "A", "AC", "AD", "A"]
