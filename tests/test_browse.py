import json
import random

import pytest
from conftest import SF_SMALL
from helpers import create_orders_df, matched_df, swaps_df, ts

from tradelens.operators import browse, ranking
from tradelens.sources.fixtures import derive_sources


def test_page_args():
    assert browse.page_args(None, None) == (1, 10)
    assert browse.page_args(0, 0) == (1, 10)
    with pytest.raises(ValueError):
        browse.page_args(-1, 10)
    with pytest.raises(ValueError):
        browse.page_args(1, -5)


def test_pages_are_consecutive_and_newest_first(spark):
    s = derive_sources(spark, SF_SMALL)
    p1 = browse.matched_orders_page(s.matched_orders, s.create_orders, s.swaps, 1, 7).collect()
    p2 = browse.matched_orders_page(s.matched_orders, s.create_orders, s.swaps, 2, 7).collect()
    both = browse.matched_orders_page(s.matched_orders, s.create_orders, s.swaps, 1, 14).collect()
    assert [r.row_no for r in p1 + p2] == list(range(1, 15))
    key = lambda r: (r.create_order.create_id, r.source_swap.swap_id)
    assert [key(r) for r in p1 + p2] == [key(r) for r in both]
    times = [r.created_at for r in both]
    assert times == sorted(times, reverse=True)


def test_page_past_the_end_is_empty_and_info(spark):
    s = derive_sources(spark, SF_SMALL)
    assert browse.matched_orders_page(s.matched_orders, s.create_orders, s.swaps, 10_000, 10).count() == 0
    info = browse.page_info(s.matched_orders, 1, 10).collect()[0]
    assert info.total_items == 1364 and info.total_pages == 137
    assert browse.listable_items(s.matched_orders, s.create_orders, s.swaps).collect()[0].listable_items == 1364


def test_successful_page_filters(spark):
    s = derive_sources(spark, SF_SMALL)
    rows = browse.successful_matched_orders_page(s.matched_orders, s.create_orders, s.swaps, 1, 50).collect()
    assert rows
    for r in rows:
        assert r.source_swap.redeem_tx_hash and r.destination_swap.redeem_tx_hash


def test_every_page_holds_its_ranks(spark):
    """Pages of ties, of missing times and of repeated matches against one sort of all rows."""
    times = [None, "2020-01-03", "2020-01-03", "2020-01-02", "1969-12-31", "2020-01-03", None, "2020-01-02"]
    times = [t and ts(f"{t}T00:00:00") for t in times]
    matched = [{"create_order_id": f"o{i}", "source_swap_id": f"s{i}", "destination_swap_id": f"d{i}", "created_at": t} for i, t in enumerate(times)]
    matched += [matched[2], {**matched[3], "destination_swap_id": "gone"}, {**matched[3], "create_order_id": "gone"}]
    orders = create_orders_df(spark, [{"create_id": f"o{i}"} for i in range(8)])
    swaps = swaps_df(spark, [{"swap_id": f"{k}{i}"} for i in range(8) for k in "sd"])
    table = matched_df(spark, matched)
    want = ["o0", "o6", "o1", "o2", "o2", "o5", "o3", "o7", "o4"]
    assert browse.listable_items(table, orders, swaps).collect()[0].listable_items == len(want)
    for per_page in (1, 2, 4, 9, 20):
        got = []
        for page in range(1, len(want) // per_page + 2):
            rows = browse.matched_orders_page(table, orders, swaps, page, per_page).collect()
            assert [r.row_no for r in rows] == list(range((page - 1) * per_page + 1, (page - 1) * per_page + 1 + len(rows)))
            got += [r.create_order.create_id for r in rows]
        assert got == want


def test_page_document(spark):
    s = derive_sources(spark, SF_SMALL)
    page = browse.matched_orders_page(s.matched_orders, s.create_orders, s.swaps, 2, 3)
    doc = json.loads(browse.page_document(page, browse.page_info(s.matched_orders, 2, 3)).collect()[0].document)
    assert (doc["page"], doc["per_page"], doc["total_items"], doc["total_pages"]) == (2, 3, 1364, 455)
    assert [r["create_order"]["create_id"] for r in doc["data"]] == [r.create_order.create_id for r in page.collect()]
    assert "refund_tx_hash" in doc["data"][0]["source_swap"] and doc["data"][0]["created_at"].endswith("Z")
    none = browse.matched_orders_page(s.matched_orders, s.create_orders, s.swaps, 9999, 3)
    assert json.loads(browse.page_document(none, browse.page_info(s.matched_orders, 9999, 3)).collect()[0].document)["data"] == []


def tied_tables(spark, n):
    """Matches of one hot time that differ in ids only (some in other times only, some repeated), and a few around it."""
    rng = random.Random(7)
    rows = []
    for i in range(n):
        oid = rng.choice(["order-", "order-é", "o", "order-00000000"]) + str(rng.randrange(n))
        row = {"create_order_id": oid, "source_swap_id": f"s{rng.randrange(4)}", "destination_swap_id": f"d{rng.randrange(4)}", "created_at": ts("2020-01-02T00:00:00")}
        if rng.random() < 0.1:
            row["updated_at"] = rng.choice([None, ts("2020-03-01T00:00:00"), ts("1960-03-01T00:00:00")])
        if rng.random() < 0.05:
            row["created_at"] = rng.choice([None, ts("2020-01-03T00:00:00"), ts("2020-01-01T00:00:00")])
        rows += [row] * rng.choice([1, 1, 1, 3])
    orders = create_orders_df(spark, [{"create_id": r["create_order_id"]} for r in rows if not r["create_order_id"].endswith("7")]).distinct()
    swaps = swaps_df(spark, [{"swap_id": f"{k}{i}"} for i in range(3) for k in "sd"])
    held = [r for r in rows if not r["create_order_id"].endswith("7") and r["source_swap_id"] != "s3" and r["destination_swap_id"] != "d3"]
    low = ts("1900-01-01T00:00:00")
    newest_first = lambda r: -r["created_at"].timestamp() if r["created_at"] else -1e18
    key = lambda r: (newest_first(r), r["create_order_id"].encode(), r["source_swap_id"], r["destination_swap_id"], r.get("updated_at") or low)
    return matched_df(spark, rows), orders, swaps, sorted(held, key=key)


def shown(rows):
    return [(r.row_no, r.create_order.create_id, r.source_swap.swap_id, r.destination_swap.swap_id, r.updated_at) for r in rows]


@pytest.mark.parametrize("first_rows", [0, 1_000])
def test_pages_inside_a_tied_time(spark, monkeypatch, first_rows):
    monkeypatch.setattr(browse, "FIRST_ROWS", first_rows)
    table, orders, swaps, held = tied_tables(spark, 600)
    want = [
        (i + 1, r["create_order_id"], r["source_swap_id"], r["destination_swap_id"], r.get("updated_at") and r["updated_at"].replace(tzinfo=None))
        for i, r in enumerate(held)
    ]
    assert len(want) > 300
    for page, per_page in ((1, 7), (9, 7), (20, 10), (len(want) // 7 + 1, 7)):
        got = browse.matched_orders_page(table, orders, swaps, page, per_page).collect()
        assert shown(got) == want[(page - 1) * per_page : page * per_page]


def test_few_rows_are_ranked_inside_a_tied_time(spark):
    """What lies between a page's places: at most the page and one more page for either place."""
    table, _, _, _ = tied_tables(spark, 3_000)
    rows = browse._ordered(table.groupBy(*browse.MATCH).count().withColumnRenamed("count", "copies"), 1577923200000000)
    rows.persist()
    total = rows.agg({"copies": "sum"}).first()[0]
    for first, room in ((1, 5), (total // 2, 5), (total // 3, 40), (total - 5, 5)):
        start, end = (ranking.find_place(rows, browse._ORDER, r, room, "copies") for r in (first, first + room - 1))
        near = rows.where(start.onwards(browse._ORDER) & end.upto(browse._ORDER))
        assert near.count() <= 3 * room
        before = rows.where(~start.onwards(browse._ORDER)).agg({"copies": "sum"}).first()[0] or 0
        assert before == start.before < first
    rows.unpersist()


def test_first_pages_look_up_few_matches(spark, monkeypatch):
    """The first page meets the orders and swaps through a broadcast of its candidates, and builds no listing."""
    table, orders, swaps, held = tied_tables(spark, 600)
    seen = []
    looked_up = browse._looked_up
    monkeypatch.setattr(browse, "_listable", lambda *a: pytest.fail("the listing is built"))
    monkeypatch.setattr(browse, "_looked_up", lambda keys, *a: seen.append(keys.count()) or looked_up(keys, *a))
    rows = browse.matched_orders_page(table, orders, swaps, 1, 10).collect()
    assert [r.create_order.create_id for r in rows] == [r["create_order_id"] for r in held[:10]]
    assert len(seen) <= 2 and seen[0] <= 30
    # none of the newest can be listed: the search goes on to older ones
    few = orders.where(orders.create_id == held[-1]["create_order_id"])
    seen.clear()
    rows = browse.matched_orders_page(table, few, swaps, 1, 10).collect()
    assert {r.create_order.create_id for r in rows} == {held[-1]["create_order_id"]} and len(seen) >= 3
    assert browse.matched_orders_page(table, orders.limit(0), swaps, 1, 10).collect() == []


def test_pages_of_an_empty_table(spark):
    table, orders, swaps, _ = tied_tables(spark, 20)
    assert browse.matched_orders_page(table.limit(0), orders, swaps, 1, 10).count() == 0
    assert browse.listable_items(table.limit(0), orders, swaps).collect()[0].listable_items == 0
