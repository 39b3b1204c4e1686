"""Plan shapes that matter at scale (checked on the physical plan, not on results)."""

import re

import pytest
from conftest import SF_SMALL

import __spark_entry__ as entry
from tradelens.operators import browse, settle
from tradelens.operators.durations import order_durations_us
from tradelens.plans import registry
from tradelens.plans.pipelines import enrichment
from tradelens.sources import store


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture()
def at_scale(spark):
    """Plan as on large inputs: no size-based broadcasts, static plan."""
    old = {k: spark.conf.get(k) for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled")}
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    yield spark
    for k, v in old.items():
        spark.conf.set(k, v)


@pytest.mark.parametrize("name", sorted(registry.QUERIES))
def test_no_cross_products(spark, at_scale, name):
    plan = _plan(entry.queries()[name](spark, SF_SMALL))
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_window_reaches_the_scan(spark):
    st = registry.state(spark, SF_SMALL)
    window = store.read_orders_table(spark, st.enriched_path, *st.window)
    plan = _plan(order_durations_us(window, registry.WINDOW_START, registry.WINDOW_END))
    assert re.search(r"PartitionFilters: \[.*created_month", plan)
    assert re.search(r"PushedFilters: \[.*created_at", plan)
    # column pruning: block numbers and hashes are not read for durations
    read = re.findall(r"FileScan parquet \[([^\]]*)\]", plan)
    assert read and all("tx_hash" not in r and "block_number" not in r for r in read)


def test_settle_and_append_shuffle_each_input_once(spark, at_scale):
    st = registry.state(spark, SF_SMALL)
    cand = settle.settled_orders(st.src.create_orders, st.src.matched_orders, st.src.swaps)
    plan = _plan(settle.append_new_orders(cand, st.stored))
    exchanges = re.findall(r"Exchange hashpartitioning\((\w+)#", plan)
    # legs and swaps on swap_id; the fold, create_orders and the stored ids on create_order_id
    assert sorted(exchanges) == sorted(["swap_id", "swap_id", "create_order_id", "create_order_id", "create_order_id"])


def test_enrichment_shuffles_each_lookup_table_once(spark, at_scale):
    st = registry.state(spark, SF_SMALL)
    plan = _plan(enrichment(st.stored, st.src).enriched)
    scans = re.findall(r"FileScan parquet \[([^\]]*)\]", plan)
    blocks_scans = [s for s in scans if "block_time_raw" in s]
    tx_scans = [s for s in scans if "tx_hash" in s and "block_time" in s and "block_time_raw" not in s]
    # the hot-key branch probes the same shuffled, de-duplicated table (ReusedExchange)
    assert len(blocks_scans) == 1 and len(tx_scans) == 1
    assert "ReusedExchange" in plan


def test_enriched_orders_reads_the_table_twice_and_the_requests_once_written(spark, at_scale):
    st = registry.state(spark, SF_SMALL)
    plan = _plan(st.run.enriched)
    scans = [line for line in plan.split("\n") if "FileScan" in line]
    assert sum("secret_hash" in line for line in scans) <= 2  # the touched and the untouched rows; requests are stored


@pytest.mark.parametrize("page", [40, 60])  # found progressively, and in the whole listing
def test_pages_never_shuffle_the_wide_swaps(spark, at_scale, page):
    st = registry.state(spark, SF_SMALL)
    s = st.src
    plan = _plan(browse.matched_orders_page(s.matched_orders, s.create_orders, s.swaps, page, 20))
    lines = plan.split("\n")
    depth = lambda line: len(re.match(r"[\s:+|*()\d-]*", line)[0])
    for i, line in enumerate(lines):
        if "FileScan" in line and "redeem_tx_hash" in line:
            above, at = [], depth(line)
            for up in reversed(lines[:i]):
                if depth(up) < at:
                    above.append(up)
                    at = depth(up)
            # rows meet the broadcast page before anything is exchanged
            first_join = next(k for k, u in enumerate(above) if "BroadcastHashJoin" in u)
            assert not any("Exchange hashpartitioning" in u for u in above[:first_join])


def test_quartiles_scan_the_durations_only(spark):
    an = registry.state(spark, SF_SMALL).an
    assert "FileScan" not in _plan(an.quartiles_us)  # found by two passes, at most one row per route
    assert _plan(registry.q_route_matrix(spark, SF_SMALL)).count("FileScan") == 1
