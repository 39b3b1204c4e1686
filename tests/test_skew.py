"""A block shared by a third of all requests is joined by broadcast, not in one task."""

from helpers import blocks_df, final_rows, tx_df

from tradelens.operators import enrich
from pyspark.sql import functions as F

from tradelens.operators.joins import HOT_KEYS, hot_keys, lookup_join


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_hot_blocks_of_transactions_go_through_the_broadcast_branch(spark):
    """A third of the orders share a block that only their transactions name."""
    n = 6000
    rows = [
        {"create_order_id": f"o{i:05d}", "source_chain": "ethereum", "user_init_tx_hash": f"t{i}", "cobi_init_block_number": 10 + i}
        for i in range(n)
    ]
    f = final_rows(spark, rows)
    tx = tx_df(spark, [("ethereum", f"t{i}", 1 if i % 3 == 0 else 10 + i, None) for i in range(n)])
    blocks = blocks_df(spark, [(c, b, 1000 + b, None) for c in ("ethereum", "base") for b in [1] + [10 + i for i in range(n)]])
    requests = enrich.lookup_requests(f)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        res = enrich.resolve_all(requests, blocks, tx)
        plan = _plan(res)
        got = {(r.create_order_id, r.event): r.block_time for r in res.collect()}
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "approx_top_k" in plan and "BroadcastHashJoin" in plan
    # whole: every request exactly once, with its time
    assert len(got) == 2 * n and None not in got.values()
    assert got["o00000", "user_init"] == 1001 and got["o00001", "user_init"] == 1011 and got["o00001", "cobi_init"] == 1011
    keyed = spark.createDataFrame([("ethereum", 1 if i % 3 == 0 else 10 + i) for i in range(n)], "chain string, k long")
    assert [tuple(r) for r in hot_keys(keyed, ["chain", "k"]).collect()] == [("ethereum", 1)]


def test_hot_keys_are_few(spark):
    flat = spark.range(200_000).select(F.lit("c").alias("chain"), F.concat(F.lit("h"), "id").alias("tx_hash"))
    assert hot_keys(flat, ["chain", "tx_hash"]).count() <= HOT_KEYS
    assert hot_keys(flat.limit(0), ["chain", "tx_hash"]).count() == 0


def test_repeated_hash_gives_one_whole_row(spark):
    tx = tx_df(spark, [("bitcoin", "a", 9, 50), ("bitcoin", "a", 3, 70), ("bitcoin", "a", None, 1), ("bitcoin", "b", None, 8)])
    got = {r.tx_hash: (r.tx_block_number, r.tx_time) for r in enrich.tx_records(tx).collect()}
    assert got == {"a": (3, 70), "b": (None, 8)}


def test_lookup_join_split_is_exact(spark):
    left = spark.createDataFrame([(k % 4 if k % 2 else 0, k) for k in range(4000)], "key long, id long")
    right = spark.createDataFrame([(k, f"v{k}") for k in range(0, 4)], "key long, v string")
    plain = sorted(map(tuple, left.join(right, ["key"], "left").collect()))
    salt = -(F.col("id") + 1)
    for hot in (hot_keys(left, ["key"]), spark.createDataFrame([(0,), (1,), (7,)], "key long"), left.select("key").limit(0)):
        split = lookup_join(left, right, ["key"], hot, salt)
        assert sorted(map(tuple, split.select("key", "id", "v").collect())) == plain
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = _plan(lookup_join(left, right, ["key"], hot_keys(left, ["key"]), salt))
        assert "BroadcastHashJoin" in plan and "SortMergeJoin" in plan
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
