import uuid

from conftest import SF_SMALL

from tradelens.operators import browse
from tradelens.plans import pipelines
from tradelens.session import checkpoint_dir
from tradelens.sources import store
from tradelens.sources.fixtures import derive_sources
from tradelens.sources.schemas import FINAL_ORDER_COLUMNS


def test_store_and_enrich_a_snapshot(spark):
    path = f"{checkpoint_dir(spark)}/store-test-{uuid.uuid4().hex[:8]}"
    empty = store.ensure_table(spark, path)
    assert empty.columns == FINAL_ORDER_COLUMNS and empty.count() == 0
    src = derive_sources(spark, SF_SMALL)
    store.write_orders(pipelines.new_orders(src, empty), path)
    t = store.read_orders_table(spark, path)
    assert t.count() == 1197 and t.select("create_order_id").distinct().count() == 1197
    assert pipelines.new_orders(src, t).count() == 0  # nothing is appended twice
    snap = pipelines.enrich_store(spark, src, path, path + "-v2")
    assert snap.count() == 1197
    # a window read lists only the months it touches, and filters by month
    w = pipelines.read_window(spark, path + "-v2", "1996-01-01", "1996-03-31")
    months = {r.created_at.strftime("%Y-%m") for r in w.select("created_at").collect()}
    assert months <= {"1996-01", "1996-02", "1996-03"}


def test_created_before_bound(spark):
    s = derive_sources(spark, SF_SMALL)
    page = browse.matched_orders_page(s.matched_orders, s.create_orders, s.swaps, 1, 5, created_before="1997-01-01")
    rows = page.collect()
    assert len(rows) == 5 and all(r.created_at.year < 1997 for r in rows)


def test_read_source_parquet(spark):
    df = store.read_source(spark, f"{SF_SMALL}/orders.parquet")
    assert df.count() == 1500 and "o_orderdate" in df.columns
