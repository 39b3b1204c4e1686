"""Quartiles of any window from histograms by month, and route arrays in chunks."""

import datetime as dt
import json
import random
import re
import tempfile

import pytest
from conftest import SF_SMALL
from pyspark.sql import Row
from pyspark.sql import functions as F

from tradelens.operators import routes
from tradelens.operators.durations import order_durations_us
from tradelens.operators.quantiles import route_quartiles_us
from tradelens.plans import duration_store, registry

EVENTS = ("user_init", "cobi_init", "user_redeem", "cobi_redeem", "user_refund", "cobi_refund")


def rows_of(df):
    return sorted(map(str, df.collect()))


def same(spark, table, root, start, end):
    want = route_quartiles_us(order_durations_us(table, start, end))
    assert rows_of(duration_store.window_quartiles_us(spark, root, start, end)) == rows_of(want)


@pytest.fixture(scope="module")
def st(spark):
    return registry.state(spark, SF_SMALL)


def test_random_windows_are_exact(spark, st):
    rng = random.Random(5)
    first = dt.datetime(1992, 1, 1)
    windows = [("1994-05-02T00:00:00", "1994-05-20T00:00:00"), ("1994-05-31T23:59:59", "1994-06-01T00:00:01"), ("2030-01-01", "2031-01-01")]
    for _ in range(3):
        a, b = sorted(first + dt.timedelta(seconds=rng.randrange(2400 * 86400)) for _ in range(2))
        windows.append((a.isoformat(), b.isoformat()))
    for start, end in windows:
        same(spark, st.enriched, st.durations_path, start, end)


def test_months_are_replaced(spark, st):
    root = f"{tempfile.mkdtemp(prefix='tl-durations-')}/d"
    duration_store.refresh(st.enriched, root)
    # one month loses all its times, another its refunds; the rest is not written again
    month = F.date_format("created_at", "yyyy-MM")
    gone = [F.when(month == "1995-03", F.lit(None).cast("timestamp")).otherwise(F.col(e)).alias(e) for e in EVENTS]
    changed = st.enriched.select(*[c for c in st.enriched.columns if c not in EVENTS], *gone).select(*st.enriched.columns)
    changed = changed.withColumn("user_refund", F.when(month == "1995-04", F.lit(None).cast("timestamp")).otherwise(F.col("user_refund")))
    duration_store.refresh(changed.where(month.isin("1995-03", "1995-04")), root)
    for window in (("1995-01-10", "1995-06-10"), ("1995-03-05", "1995-03-20"), ("1995-03-05", "1995-04-20"), ("1995-02-28", "1995-05-01")):
        same(spark, changed, root, *window)


def test_values_are_read_in_the_ranges_of_ranks(spark, st, monkeypatch):
    seen = []
    original = duration_store.quartiles_of
    monkeypatch.setattr(duration_store, "quartiles_of", lambda hist, values_in: seen.append(values_in) or original(hist, values_in))
    duration_store.window_quartiles_us(spark, st.durations_path, "1994-03-15", "1997-10-20")
    ranges = [Row(metric="user_init", lo=10**7, hi=10**8), Row(metric="cobi_init", lo=5, hi=10**8)]
    old = spark.conf.get("spark.sql.maxMetadataStringLength")
    spark.conf.set("spark.sql.maxMetadataStringLength", "5000")
    values = seen[0](ranges)
    plan = values._jdf.queryExecution().executedPlan().toString()
    spark.conf.set("spark.sql.maxMetadataStringLength", old)
    found = values.agg(F.min("v"), F.max("v"), F.count_distinct("metric")).first()
    assert found[0] >= 5 and found[1] <= 10**8 and found[2] == 2
    assert re.search(r"PartitionFilters: \[[^\]]*created_month", plan)
    assert re.search(r"PushedFilters: \[.*GreaterThanOrEqual\(v,", plan)


@pytest.mark.parametrize("size", [1, 7, 10_000])
def test_chunks_are_the_routes_arrays(spark, st, size):
    docs = routes.orders_by_route(routes.normal_orders(st.an.durations_us, st.an.quartiles_us))
    chunks = routes.route_chunks(docs, size, f"{tempfile.mkdtemp(prefix='tl-chunks-')}/c").collect()
    listed = {}
    for r in docs.orderBy("created_at", "create_order_id").collect():
        listed.setdefault(r.route, []).append(json.loads(r.order_json))
    got = {}
    for c in sorted(chunks, key=lambda c: (c.route, c.chunk)):
        found = json.loads(c.orders_json)
        assert len(found) == c.rows <= size and c.first_row == c.chunk * size == len(got.get(c.route, []))
        got.setdefault(c.route, []).extend(found)
    assert got == listed
