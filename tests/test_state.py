"""What the registered queries read, and that no result depends on the session's time zone."""

import shutil
import tempfile

import pyarrow.parquet as pq
import pytest
from conftest import SF_SMALL
from helpers import final_rows, ts
from pyspark.sql import functions as F

from tradelens.functions.columns import ist_display, iso_utc
from tradelens.operators.durations import eligible_orders
from tradelens.plans import pipelines, registry
from tradelens.session import checkpoint_dir
from tradelens.sources import store


def test_replaced_input_is_read_again(spark):
    root = tempfile.mkdtemp(prefix="tl-input-")
    shutil.copyfile(f"{SF_SMALL}/orders.parquet", f"{root}/orders.parquet")
    query = registry.QUERIES["settled_orders"]
    assert query(spark, root).count() == 1197
    first = registry.state(spark, root)
    assert registry.state(spark, root) is first  # same files, same tables
    pq.write_table(pq.read_table(f"{SF_SMALL}/orders.parquet").slice(0, 100), f"{root}/orders.parquet")
    assert query(spark, root).count() < 100
    assert registry.state(spark, root).base != first.base


def test_another_session_writes_its_own_tables(spark, monkeypatch):
    here = registry.state(spark, SF_SMALL).base
    monkeypatch.setattr(registry, "_STATES", {})
    assert registry.state(spark, SF_SMALL).base != here


class _Context:
    def __init__(self, master):
        self.master = master

    def getConf(self):
        return self

    def get(self, key, default):
        return default

    def getCheckpointDir(self):
        return None


@pytest.mark.parametrize("master", ["spark://host:7077", "yarn", "local-cluster[2,1,1024]", "k8s://x"])
def test_no_private_folder_on_a_cluster(master):
    session = type("Session", (), {"sparkContext": _Context(master)})()
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        checkpoint_dir(session)


@pytest.fixture(params=["UTC", "America/New_York", "Asia/Kolkata"])
def zone(spark, request):
    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", request.param)
    yield request.param
    spark.conf.set("spark.sql.session.timeZone", old)


def test_months_windows_and_text_are_utc(spark, zone):
    # near month ends, and in the hour that New York's clocks skip
    stamps = ["2025-01-31T23:30:00", "2025-02-01T02:00:00", "2025-02-28T23:59:59.999", "2025-03-01T00:00:00", "2025-03-09T02:30:00.123"]
    rows = [{"create_order_id": f"o{i}", "created_at": ts(t), "user_init": ts(t)} for i, t in enumerate(stamps)]
    path = f"{tempfile.mkdtemp(prefix='tl-zone-')}/orders"
    store.write_orders(final_rows(spark, rows), path)
    months = {r.created_month.isoformat() for r in spark.read.parquet(path).select("created_month").distinct().collect()}
    assert months == {"2025-01-01", "2025-02-01", "2025-03-01"}
    w = pipelines.read_window(spark, path, "2025-02-01", "2025-02-28T23:59:59.999")
    got = {r.create_order_id: r.t for r in eligible_orders(w, "2025-02-01", "2025-02-28T23:59:59.999").select("create_order_id", iso_utc("created_at").alias("t")).collect()}
    assert got == {"o1": "2025-02-01T02:00:00.000Z", "o2": "2025-02-28T23:59:59.999Z"}
    text = {r.t for r in store.read_orders_table(spark, path).select(iso_utc("created_at").alias("t")).collect()}
    assert "2025-03-09T02:30:00.123Z" in text and "2025-01-31T23:30:00.000Z" in text
    shown = spark.createDataFrame([(1741487400,), (0,), (None,), (-1,)], "e long").select(ist_display("e").alias("t"), F.col("e"))
    assert {r.e: r.t for r in shown.collect()} == {
        1741487400: "2025-03-09 08:00:00.000+05:30", 0: None, None: None, -1: "1970-01-01 05:29:59.000+05:30"
    }


def test_analysis_is_the_same_in_every_zone(spark, zone):
    root = tempfile.mkdtemp(prefix="tl-zone-")
    shutil.copyfile(f"{SF_SMALL}/orders.parquet", f"{root}/orders.parquet")
    st = registry.state(spark, root)
    assert st.stored.count() == 1197
    assert (st.an.normal_us.count(), st.an.anomalous_us.count()) == (535, 59)
    newest = registry.q_last_updated(spark, root).collect()[0].last_updated
    assert newest == registry.q_last_updated(spark, SF_SMALL).collect()[0].last_updated
