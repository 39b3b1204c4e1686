"""Rows that every operator must take, and plain forms to hold results against."""

import random

#: doc_id, text, source; with columns named like what the operators make.
EDGE_ROWS = [
    (1, None, "a"),
    (2, "", "a"),
    (3, " \t\n\x0b\x0c\r ", None),
    (4, "one two three four five six seven", "b"),
    (4, "one two three four five six seven", "b"),
    (5, "one two three four five six  seven", "b"),
    (6, "ONE two three four five six seven", "b"),
    (7, "word " * 40_000, "a"),
    (8, "x" * 120_000, "a"),
    (9, "one two", ""),
    (None, "no id here, but a text", "a"),
    (10, "é😀 naïve ﬁ \x85   end", "c"),
    (11, "a b c d", "c"),
]
CLASHING = "id long, row long, n long, score double, restored string, pii string, secrets string, kept string, ids string, queue string, at long"
SCHEMA = "doc_id long, text string, source string, " + CLASHING


def edge_docs(spark, rows=None):
    rows = EDGE_ROWS if rows is None else rows
    extra = (None,) * len(CLASHING.split(","))
    return spark.createDataFrame([r + extra for r in rows], SCHEMA).repartition(3)


def documents(spark, texts, ids=None):
    rows = [(i, t, "s") for i, t in zip(ids or range(len(texts)), texts)]
    return edge_docs(spark, rows)


def random_text(rng: random.Random, alphabet: str, length: int) -> str:
    return "".join(rng.choice(alphabet) for _ in range(rng.randint(0, length)))


def roots_of(n, linked):
    """Smallest reachable node of each of n nodes by a plain union-find."""
    parent = list(range(n))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in linked:
        a, b = sorted((find(a), find(b)))
        parent[b] = a
    return [find(x) for x in range(n)]
