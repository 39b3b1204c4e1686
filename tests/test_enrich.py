from helpers import blocks_df, final_rows, ts, tsn, tx_df

from tradelens.operators import enrich


def _run(spark, rows, blocks, txs):
    f = final_rows(spark, rows)
    req = enrich.lookup_requests(f)
    res = enrich.resolve_all(req, blocks_df(spark, blocks), tx_df(spark, txs))
    return f, req, res


def test_block_chain_lookup_and_hex(spark):
    rows = [
        {"create_order_id": "o1", "source_chain": "base", "destination_chain": "hyperliquid",
         "user_init_block_number": 100, "cobi_init_block_number": 7},
    ]
    blocks = [("base", 100, 1_000_000, "1000000"), ("hyperliquid", 7, 255, "0xff")]
    f, req, res = _run(spark, rows, blocks, [])
    got = {r.event: r.block_time for r in res.collect()}
    assert got == {"user_init": 1_000_000, "cobi_init": 255}
    e = enrich.enriched_orders(f, res).collect()[0]
    assert e.user_init == tsn("1970-01-12T13:46:40") and e.cobi_init == tsn("1970-01-01T00:04:15")


def test_transaction_chain_uses_tx_block(spark):
    rows = [{"create_order_id": "o1", "source_chain": "ethereum", "destination_chain": "arbitrum",
             "user_init_block_number": 1, "user_init_tx_hash": "t1",
             "cobi_init_block_number": 2, "cobi_init_tx_hash": "t2"}]
    blocks = [("ethereum", 50, 5000, "5000"), ("ethereum", 1, 1, "1")]
    txs = [("ethereum", "t1", 50, None)]  # t2 unknown
    _, _, res = _run(spark, rows, blocks, txs)
    got = {r.event: r.block_time for r in res.collect()}
    assert got == {"user_init": 5000, "cobi_init": None}


def test_bitcoin_hash_cut_and_block_fallback(spark):
    rows = [{"create_order_id": "o1", "source_chain": "bitcoin", "destination_chain": "bitcoin",
             "user_init_block_number": 10, "user_init_tx_hash": "aa:0",
             "cobi_init_block_number": 11, "cobi_init_tx_hash": "bb",
             "cobi_redeem_block_number": None, "cobi_redeem_tx_hash": "cc:1"}]
    blocks = [("bitcoin", 11, 1100, "1100"), ("bitcoin", 10, 1000, "1000")]
    txs = [("bitcoin", "aa", 10, 999), ("bitcoin", "bb", 11, None)]
    _, _, res = _run(spark, rows, blocks, txs)
    got = {r.event: r.block_time for r in res.collect()}
    # own tx time; tx without time -> the order's block; unknown tx without block number -> none
    assert got == {"user_init": 999, "cobi_init": 1100, "cobi_redeem": None}


def test_set_times_never_overwritten_and_epoch_zero_missing(spark):
    rows = [{"create_order_id": "o1", "user_init": ts("1997-01-01T00:00:05"), "user_init_block_number": 1,
             "cobi_init_block_number": 2, "user_redeem_block_number": 3}]
    blocks = [("base", 1, 111, "111"), ("base", 2, 0, "0"), ("base", 3, 333, "333")]
    f, req, res = _run(spark, rows, blocks, [])
    assert {r.event for r in req.collect()} == {"cobi_init", "user_redeem"}
    e = enrich.enriched_orders(f, res).collect()[0]
    assert e.user_init == tsn("1997-01-01T00:00:05")
    assert e.cobi_init is None and e.user_redeem == tsn("1970-01-01T00:05:33")


def test_unsupported_chain_counts_as_failed(spark):
    rows = [
        {"create_order_id": "o1", "source_chain": "solana", "destination_chain": "solana", "user_init_block_number": 1},
        {"create_order_id": "o2", "user_init_block_number": 1},
        {"create_order_id": "o3", "user_init": ts("1997-01-01T00:00:00"), "user_init_block_number": 1},
    ]
    blocks = [("base", 1, 100, "100"), ("solana", 1, 100, "100")]
    f, req, res = _run(spark, rows, blocks, [])
    assert [r.create_order_id for r in req.collect()] == ["o2"]
    rep = {r.create_order_id: r.status for r in enrich.enrichment_report(f, res).collect()}
    assert rep == {"o1": "failed", "o2": "updated"}
    summary = {r.status: r.orders for r in enrich.enrichment_summary(enrich.enrichment_report(f, res)).collect()}
    assert summary == {"failed": 1, "updated": 1}


def test_duplicate_lookup_rows_do_not_multiply_orders(spark):
    rows = [{"create_order_id": "o1", "user_init_block_number": 1}]
    blocks = [("base", 1, 100, "100"), ("base", 1, 90, "90")]
    f, _, res = _run(spark, rows, blocks, [])
    assert res.count() == 1
    assert enrich.enriched_orders(f, res).count() == 1


def test_candidates_gate(spark):
    rows = [
        {"create_order_id": "a", "user_init_block_number": 1},
        {"create_order_id": "b", "user_init_block_number": 1, "user_init": ts("1997-01-01T00:00:00")},
        {"create_order_id": "c", "user_init_tx_hash": "x", "source_chain": "ethereum"},
    ]
    f = final_rows(spark, rows)
    assert [r.create_order_id for r in enrich.timestamp_candidates(f).collect()] == ["a"]
    # an explicit id list admits orders the same way (semi join)
    ids = spark.createDataFrame([("a",), ("c",)], "create_order_id string")
    assert {r.create_order_id for r in enrich.lookup_requests(f, ids).collect()} == {"a", "c"}


def test_event_time_display(spark):
    df = spark.createDataFrame([("o", "user_init", "base", 0), ("o", "cobi_init", "base", 1_700_000_000),
                                ("o", "user_redeem", "base", None)],
                               "create_order_id string, event string, chain string, block_time long")
    got = {r.event: r.display_time for r in enrich.event_time_display(df).collect()}
    assert got == {"user_init": None, "cobi_init": "2023-11-15 03:43:20.000+05:30", "user_redeem": None}
