import datetime as dt

from helpers import route_quartiles_by_row_number, final_rows, ts

from tradelens.operators import durations as D
from tradelens.operators import quantiles as Q
from tradelens.operators import routes as R
from tradelens.plans.pipelines import analysis

W = ("1997-01-01", "1997-12-31")


def _orders(spark):
    base = ts("1997-03-01T00:00:00")
    rows = []
    for i in range(12):
        t0 = base.replace(hour=i)
        rows.append({
            "create_order_id": f"o{i:02d}", "created_at": t0,
            "user_init": t0.replace(minute=1), "cobi_init": t0.replace(minute=2),
            "user_redeem": t0.replace(minute=3 + (40 if i == 11 else 0)), "cobi_redeem": t0.replace(minute=50),
        })
    rows += [
        # negative gap clamps to 0; missing cobi_init with a redeem gives user_redeem 0
        {"create_order_id": "neg", "created_at": base.replace(hour=20), "user_init": base.replace(hour=19),
         "user_redeem": base.replace(hour=21)},
        # window ends are inclusive
        {"create_order_id": "start", "created_at": ts("1997-01-01T00:00:00"), "user_init": ts("1997-01-01T00:00:03")},
        {"create_order_id": "end", "created_at": ts("1997-12-31T00:00:00"), "user_init": ts("1997-12-31T00:00:03")},
        {"create_order_id": "after", "created_at": ts("1997-12-31T00:00:01"), "user_init": ts("1997-12-31T00:00:03")},
        # no timestamp at all: not eligible
        {"create_order_id": "none", "created_at": base},
        # refunded order on another route
        {"create_order_id": "rf", "created_at": base, "source_chain": "bera", "destination_chain": "starknet",
         "user_init": base.replace(minute=1), "cobi_init": base.replace(minute=2),
         "cobi_refund": base.replace(hour=3), "user_refund": base.replace(hour=4)},
    ]
    return final_rows(spark, rows)


def test_durations_edges(spark):
    d = {r.create_order_id: r for r in D.order_durations(_orders(spark), *W).collect()}
    assert {"start", "end"} <= set(d) and "after" not in d and "none" not in d
    assert d["neg"].user_init_duration == 0.0 and d["neg"].user_redeem_duration == 0.0
    assert d["neg"].cobi_init_duration is None
    assert d["rf"].cobi_refund_duration == 3 * 3600 - 120 - 7200
    assert d["rf"].user_refund_duration == 3600
    assert d["o00"].overall_duration == 60 + 60 + 60 + 47 * 60


def test_split_is_complementary(spark):
    a = analysis(_orders(spark), *W)
    n = {r.create_order_id for r in a.normal_us.collect()}
    x = {r.create_order_id for r in a.anomalous_us.collect()}
    e = {r.create_order_id for r in a.durations_us.collect()}
    assert n | x == e and not (n & x)
    assert "o11" in x  # its user_redeem stage is far beyond the route's fence


def test_averages_and_matrix(spark):
    a = analysis(_orders(spark), *W)
    av = {(r.source_chain, r.destination_chain): r for r in R.route_averages(a.normal_us).collect()}
    rf = av[("bera", "starknet")]
    assert rf.total_orders == 1 and rf.avg_cobi_init_duration == 0.0  # refunded: cobi_init average falls back to 0
    assert rf.avg_user_redeem_duration is None
    grid = R.route_matrix(R.route_averages(a.normal_us)).collect()
    assert len(grid) == 64
    empty = [r for r in grid if r.route == "arbitrum-arbitrum"][0]
    assert empty.total_orders == 0 and empty.avg_cobi_init_duration is None


def test_fences_long_form(spark):
    a = analysis(_orders(spark), *W)
    f = R.route_fences(a.quartiles_us).collect()
    assert {r.metric for r in f} == {"user_init_duration", "cobi_init_duration", "user_redeem_duration", "cobi_redeem_duration"}
    for r in f:
        if r.q1 is not None:
            assert r.upper_fence == r.q3 + 1.5 * (r.q3 - r.q1)
            assert r.lower_fence == r.q1 - 1.5 * (r.q3 - r.q1)


def test_last_updated_default_and_value(spark):
    empty = final_rows(spark, [{"create_order_id": "x"}])
    assert R.last_updated(empty).collect()[0].last_updated == "1970-01-01T00:00:00.000Z"
    one = final_rows(spark, [{"create_order_id": "x", "user_init": ts("1997-01-01T00:00:00"), "user_init_block_number": 5,
                              "created_at": ts("1997-02-03T04:05:06")}])
    assert R.last_updated(one).collect()[0].last_updated == "1997-02-03T04:05:06.000Z"


def test_window_validation():
    import pytest

    with pytest.raises(ValueError):
        D.parse_window("not a date", None)
    s, e = D.parse_window("", None)
    assert (e - s).days == 30


def test_orders_by_route_rows(spark):
    a = analysis(_orders(spark), *W)
    docs = R.orders_by_route(R.normal_orders(a.durations_us, a.quartiles_us)).collect()
    assert all(d.route == "base-base" or d.route == "bera-starknet" for d in docs)
    assert all(d.order_json.startswith('{"create_order_id":') for d in docs)


def test_radix_matches_row_number_on_analysis(spark):
    a = analysis(_orders(spark), *W)
    fast = sorted(map(tuple, Q.route_quartiles_us(a.durations_us).collect()))
    slow = sorted(map(tuple, route_quartiles_by_row_number(a.durations_us).collect()))
    assert fast == slow


def test_averages_document_and_route_files(spark):
    import glob
    import json
    import os

    from tradelens.plans.pipelines import averages_report
    from tradelens.session import checkpoint_dir

    rep = averages_report(_orders(spark), *W)
    doc = json.loads(rep["document"].collect()[0].document)
    assert len(doc["averages"]) == 64 and doc["averages"]["arbitrum-arbitrum"]["total_orders"] == 0
    assert doc["averages"]["base-base"]["total_orders"] >= 1
    assert set(doc["thresholds"]["base-base"]) == {"user_init_duration", "cobi_init_duration", "user_redeem_duration", "cobi_redeem_duration"}
    assert doc["last_updated"] == "1970-01-01T00:00:00.000Z"  # no block numbers in these rows

    a = analysis(_orders(spark), *W)
    out = f"{checkpoint_dir(spark)}/route-docs-test"
    R.write_orders_by_route(R.orders_by_route(R.normal_orders(a.durations_us, a.quartiles_us)), out)
    local = out[len("file:"):] if out.startswith("file:") else out
    routes = sorted(os.path.basename(p) for p in glob.glob(f"{local}/route=*"))
    assert routes == ["route=base-base", "route=bera-starknet"]
    n_docs = 0
    for f in glob.glob(f"{local}/route=base-base/*.txt"):
        stamps = [json.loads(x)["created_at"] for x in open(f)]
        assert stamps == sorted(stamps)  # each file in created_at order
        n_docs += len(stamps)
    normal = R.normal_orders(a.durations_us, a.quartiles_us)
    assert n_docs == normal.where("source_chain = 'base' AND destination_chain = 'base'").count()


def test_averages_by_route_map(spark):
    a = analysis(_orders(spark), *W)
    m = R.averages_by_route(R.route_matrix(R.route_averages(a.normal_us))).collect()[0].averages
    assert len(m) == 64 and m["bera-starknet"]["total_orders"] == 1 and m["arbitrum-base"]["avg_user_init_duration"] is None


def test_thresholds_only_for_routes_with_normal_orders(spark):
    """Four orders of one route, each the outlier of another metric, and one order of another route."""
    import json

    from tradelens.plans.pipelines import averages_report

    t0 = ts("1997-01-01T00:00:00")
    rows = []
    for i in range(4):
        gap = [dt.timedelta(hours=10 if k == i else 1) for k in range(4)]
        at = [t0 + sum(gap[: k + 1], dt.timedelta()) for k in range(4)]
        rows.append({"create_order_id": f"x{i}", "created_at": t0, "user_init": at[0], "cobi_init": at[1], "user_redeem": at[2], "cobi_redeem": at[3]})
    rows.append({"create_order_id": "y", "created_at": t0, "source_chain": "bera", "user_init": t0 + dt.timedelta(hours=1)})
    rep = averages_report(final_rows(spark, rows), *W)
    doc = json.loads(rep["document"].collect()[0].document)
    assert rep["thresholds"].where("source_chain = 'base'").count() == 4
    assert doc["averages"]["base-base"]["total_orders"] == 0 and list(doc["thresholds"]) == ["bera-base"]
