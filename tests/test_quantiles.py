import random

from hypothesis import given, settings
from hypothesis import strategies as st

from helpers import route_quartiles_by_row_number

from tradelens.operators import quantiles as Q


def reference_quartile(values, p):
    """The original rule, literally: rank lookup, else weighted ranks floor/ceil (clamped to 1)."""
    v = sorted(values)
    n = len(v)
    if n == 0:
        return None
    pos = p * (n + 1)
    fl, ce = int(pos // 1), -int(-pos // 1)
    if 1 <= fl <= n:
        return v[fl - 1]
    lo, hi = v[max(fl, 1) - 1], v[max(ce, 1) - 1]
    return (ce - pos) * lo + (pos - fl) * hi


def _durations(spark, rows):
    return spark.createDataFrame(
        rows,
        "source_chain string, destination_chain string, user_init_us long, cobi_init_us long, "
        "user_redeem_us long, cobi_redeem_us long",
    )


def _check(spark, rows):
    d = _durations(spark, rows)
    fast = {(r.source_chain, r.destination_chain): r.asDict() for r in Q.route_quartiles_us(d).collect()}
    slow = {(r.source_chain, r.destination_chain): r.asDict() for r in route_quartiles_by_row_number(d).collect()}
    assert fast == slow
    for (s, t), got in fast.items():
        for i, m in enumerate(("user_init", "cobi_init", "user_redeem", "cobi_redeem")):
            vals = [r[2 + i] for r in rows if (r[0], r[1]) == (s, t) and r[2 + i] is not None]
            assert got[f"q1_{m}_us"] == reference_quartile(vals, 0.25)
            assert got[f"q3_{m}_us"] == reference_quartile(vals, 0.75)
    return fast


def test_small_n_and_all_null_metric(spark):
    rows = []
    for n in range(1, 8):
        for i in range(n):
            rows.append((f"s{n}", "d", (i * 7919) % 13, None, i, 2**50 + i))
    rows.append(("empty", "d", None, None, None, None))
    got = _check(spark, rows)
    assert got[("empty", "d")]["q1_user_init_us"] is None
    assert got[("s1", "d")]["q3_cobi_redeem_us"] == 2**50


def test_large_values_and_ties(spark):
    rng = random.Random(7)
    rows = []
    for _ in range(3000):
        route = rng.choice(["a", "b", "c"])
        big = rng.choice([0, 1, 2**21 - 1, 2**21, 2**42 - 1, 2**42, 2**62 + rng.randrange(1000)])
        rows.append((route, "x", rng.randrange(50), rng.randrange(10**9), big, None if rng.random() < 0.3 else rng.randrange(5)))
    _check(spark, rows)


@settings(max_examples=15, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["r1", "r2"]), st.integers(min_value=0, max_value=2**40)), min_size=1, max_size=40))
def test_quartile_is_one_of_the_inputs(spark, pairs):
    rows = [(r, "d", v, None, None, None) for r, v in pairs]
    got = _check(spark, rows)
    for (r, _), q in got.items():
        vals = {v for rr, v in pairs if rr == r}
        assert q["q1_user_init_us"] in vals and q["q3_user_init_us"] in vals


def test_reference_rule_never_interpolates():
    for n in range(1, 400):
        v = list(range(10, 10 * (n + 1), 10))
        for p, num in ((0.25, 1), (0.75, 3)):
            assert reference_quartile(v, p) == v[max(1, (num * (n + 1)) // 4) - 1]


def test_select_ranks_any_rank(spark):
    rng = random.Random(3)
    vals = {g: [rng.choice([0, 5, 2**22 + 7, 2**43 + 1, rng.randrange(10**12)]) for _ in range(n)] for g, n in (("a", 1), ("b", 50), ("c", 333))}
    values = spark.createDataFrame([(g, v) for g, vs in vals.items() for v in vs], "g string, v long")
    wanted = [(g, j, r) for g, vs in sorted(vals.items()) for j, r in enumerate((1, len(vs), (len(vs) + 1) // 2))]
    got = {(r.g, r.q): r for r in Q.select_ranks(values, wanted, ["g"])}
    for g, q, r in wanted:
        v = sorted(vals[g])
        assert got[(g, q)].lo == got[(g, q)].hi == v[r - 1]
        assert got[(g, q)].r == r - v.index(v[r - 1])
