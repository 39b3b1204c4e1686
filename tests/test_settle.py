import datetime as dt

from helpers import create_orders_df, final_rows, matched_df, swaps_df, ts

from tradelens.operators.settle import append_new_orders, settled_orders, table_profile


def _swap(sid, chain="base", it="it", rt=None, ft=None, ib=10, rb=None, fb=None):
    return {
        "swap_id": sid, "updated_at": ts("1997-01-01T00:00:00"), "chain": chain,
        "initiate_tx_hash": it, "redeem_tx_hash": rt, "refund_tx_hash": ft,
        "initiate_block_number": ib, "redeem_block_number": rb, "refund_block_number": fb,
    }


def _sources(spark, swaps, matches=None):
    co = create_orders_df(spark, [
        {"create_id": f"co{i}", "created_at": ts("1997-01-01T00:00:00"), "source_chain": "base",
         "destination_chain": "ethereum", "secret_hash": f"h{i}"} for i in range(1, 6)
    ])
    mo = matched_df(spark, matches or [
        {"create_order_id": f"co{i}", "source_swap_id": f"s{i}", "destination_swap_id": f"d{i}",
         "created_at": ts("1997-01-01T00:00:00")} for i in range(1, 6)
    ])
    return co, mo, swaps_df(spark, swaps)


def test_role_mapping_and_gating(spark):
    swaps = [
        # order 1: source redeemed (cobi redeem), destination redeemed (user redeem)
        _swap("s1", it="si1", rt="sr1", ft="", ib=10, rb=20, fb=0),
        _swap("d1", chain="ethereum", it="di1", rt="dr1", ft=None, ib=11, rb=21, fb=None),
    ]
    co, mo, sw = _sources(spark, swaps)
    r = settled_orders(co, mo, sw).collect()
    assert len(r) == 1
    row = r[0].asDict()
    assert row["user_init_block_number"] == 10 and row["user_init_tx_hash"] == "si1"
    assert row["cobi_init_block_number"] == 11 and row["cobi_init_tx_hash"] == "di1"
    assert row["user_redeem_block_number"] == 21 and row["user_redeem_tx_hash"] == "dr1"
    assert row["cobi_redeem_block_number"] == 20 and row["cobi_redeem_tx_hash"] == "sr1"
    # empty hash -> NULL, and its block number is dropped with it
    assert row["user_refund_tx_hash"] is None and row["user_refund_block_number"] is None
    assert row["cobi_refund_tx_hash"] is None and row["cobi_refund_block_number"] is None
    assert all(row[e] is None for e in ("user_init", "cobi_init", "user_redeem", "cobi_redeem", "user_refund", "cobi_refund"))


def test_settle_predicate(spark):
    swaps = [
        _swap("s1", rt="r", rb=5), _swap("d1", ft="f", fb=6),                 # both settled
        _swap("s2", rt="r", rb=5, ib=0), _swap("d2", rt="r", rb=5),           # initiate block 0
        _swap("s3", rt="", rb=5), _swap("d3", rt="r", rb=5),                  # empty redeem hash, no refund
        _swap("s4", rt="r", rb=0, ft="f", fb=7), _swap("d4", rt="r", rb=5),   # refund block carries it
        _swap("s5", rt="r", rb=None), _swap("d5", rt="r", rb=5),              # no positive block
    ]
    co, mo, sw = _sources(spark, swaps)
    got = sorted(r.create_order_id for r in settled_orders(co, mo, sw).collect())
    assert got == ["co1", "co4"]


def test_missing_leg_or_order_drops_match(spark):
    swaps = [_swap("s1", rt="r", rb=5)]  # d1 missing
    co, mo, sw = _sources(spark, swaps)
    assert settled_orders(co, mo, sw).count() == 0


def test_first_write_wins_and_append_is_idempotent(spark):
    swaps = [
        _swap("s1", rt="r", rb=5), _swap("d1", rt="r", rb=5),
        _swap("s1b", rt="r", rb=9), _swap("d1b", rt="r", rb=9),
        _swap("s2", rt="r", rb=5), _swap("d2", rt="r", rb=5),
    ]
    matches = [
        {"create_order_id": "co1", "source_swap_id": "s1b", "destination_swap_id": "d1b"},
        {"create_order_id": "co1", "source_swap_id": "s1", "destination_swap_id": "d1"},
        {"create_order_id": "co2", "source_swap_id": "s2", "destination_swap_id": "d2"},
    ]
    co, mo, sw = _sources(spark, swaps, matches)
    cand = settled_orders(co, mo, sw)
    assert cand.count() == 3
    first = append_new_orders(cand, None)
    rows = {r.create_order_id: r for r in first.collect()}
    assert set(rows) == {"co1", "co2"}
    assert rows["co1"].source_swap_id == "s1"  # smallest (source, destination) swap ids
    # already stored orders are skipped; appending the result again adds nothing
    stored = first.where("create_order_id = 'co2'")
    new = append_new_orders(cand, stored)
    assert [r.create_order_id for r in new.collect()] == ["co1"]
    assert append_new_orders(cand, stored.unionByName(new)).count() == 0


def test_table_profile(spark):
    df = final_rows(spark, [{"create_order_id": "a", "user_init": ts("1997-01-01T00:00:10")}, {"create_order_id": "b"}])
    prof = {r.column_name: r for r in table_profile(df).collect()}
    assert len(prof) == 25
    assert prof["create_order_id"].nullable is False and prof["create_order_id"].non_null_rows == 2
    assert prof["user_init"].data_type == "timestamp" and prof["user_init"].non_null_rows == 1
    assert prof["user_init_block_number"].data_type == "bigint"
    assert all(r.total_rows == 2 for r in prof.values())
