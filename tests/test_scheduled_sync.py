import datetime as dt
import glob
import hashlib
import random
import re
import tempfile
import uuid
from dataclasses import replace

import pytest
from conftest import SF_SMALL
from helpers import final_rows, ts
from pyspark.sql import functions as F

from tradelens.operators import enrich, settle
from tradelens.operators.enrich import timestamp_candidates
from tradelens.operators.settle import rejected, storable
from tradelens.plans import scheduled_sync
from tradelens.plans.scheduled_sync import candidates, enrich_months, not_stored, run_once, sync
from tradelens.sources import store
from tradelens.sources.fixtures import derive_sources
from tradelens.sources.lookups import add_lookups, open_lookups, write_lookups


@pytest.fixture(scope="module")
def src(spark):
    """The source tables as the service's databases hold them."""
    root, derived = tempfile.mkdtemp(prefix="tl-src-"), derive_sources(spark, SF_SMALL)
    for name in ("create_orders", "matched_orders", "swaps", "blocks", "transactions"):
        getattr(derived, name).write.parquet(f"{root}/{name}")
        derived = replace(derived, **{name: spark.read.parquet(f"{root}/{name}")})
    return derived


@pytest.fixture(scope="module")
def early_src(src):
    """Only orders before 1998 have arrived, and the blocks of 1996 are not known yet."""
    late = F.col("block_time").between(int(ts("1996-01-01T00:00:00").timestamp()), int(ts("1997-01-01T00:00:00").timestamp()))
    early = F.col("created_at") < F.lit(ts("1998-01-01T00:00:00"))
    return replace(src, create_orders=src.create_orders.where(early), blocks=src.blocks.where(~late))


def folder():
    return f"{tempfile.mkdtemp(prefix='tl-sync-')}/orders"


def ids(df):
    return sorted(r.create_order_id for r in df.select("create_order_id").collect())


def rows_of(df):
    return sorted(map(str, df.collect()))


def digests(root):
    return {f: hashlib.sha1(open(f, "rb").read()).hexdigest() for f in glob.glob(f"{root}/*/*/*.parquet")}


def month_files(found):
    """File names and contents by month."""
    out = {}
    for f, d in found.items():
        out.setdefault(re.search("created_month=([^/]*)", f)[1], set()).add((f, d))
    return out


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_new_and_late_settled_orders_between_two_runs(spark, src, early_src):
    root = folder()
    first = run_once(spark, early_src, root)
    n1 = first.count()
    assert 0 < n1 < 1197
    before, open1 = digests(root), timestamp_candidates(first).count()
    filled1 = first.where("user_init IS NOT NULL").count()

    second = run_once(spark, src, root)
    early = F.col("created_at") < F.lit(ts("1998-01-01T00:00:00"))
    assert second.count() == 1197 and len(set(ids(second))) == 1197
    assert second.where(early).where("user_init IS NOT NULL").count() > filled1
    assert timestamp_candidates(second.where(early)).count() < open1
    one, two = month_files(before), month_files(digests(root))
    same = [m for m in one if two[m] == one[m]]
    assert same and not any(m.startswith("1996") for m in same)  # months without a newly found time keep their files

    third = run_once(spark, src, root)
    assert third.count() == 1197 and digests(root) == {f: d for m in two.values() for f, d in m}  # nothing left to do
    full = folder()
    assert rows_of(third) == rows_of(run_once(spark, src, full))


def test_a_run_that_fails_changes_nothing(spark, src, early_src, monkeypatch):
    root = folder()
    run_once(spark, early_src, root)
    before, rows = digests(root), rows_of(store.read_orders_table(spark, root))

    def broken(df):
        """Rows of which one cannot be made."""
        cannot = F.when(F.col("create_order_id") == ids(df)[-1], F.raise_error(F.lit("lost")).cast("string"))
        return df.withColumn("secret_hash", F.coalesce(cannot, F.col("secret_hash")))

    write = store.write_orders
    for stop in ("new", "staging", "commit"):
        with monkeypatch.context() as m:
            if stop == "new":
                m.setattr(scheduled_sync, "not_stored", lambda *a, f=not_stored: broken(f(*a)))
                call = lambda: sync(spark, src, root)
            elif stop == "staging":
                m.setattr(store, "write_orders", lambda df, path, mode="append": write(broken(df), path, mode))
                call = lambda: enrich_months(spark, src, root)
            else:
                m.setattr(store, "_stored", lambda s, p, f=store._stored: broken(f(s, p)) if "staging" in p else f(s, p))
                call = lambda: enrich_months(spark, src, root)
            with pytest.raises(Exception, match="lost"):
                call()
        assert digests(root) == before and rows_of(store.read_orders_table(spark, root)) == rows
    assert run_once(spark, src, root).count() == 1197


def test_the_anti_join_reads_months_of_candidates_only(spark, src):
    root, work = folder(), folder()
    sync(spark, src, root)
    found = candidates(spark, src, work).where(F.col("created_at").between(F.lit(ts("1996-02-01T00:00:00")), F.lit(ts("1996-03-31T00:00:00"))))
    new = not_stored(spark, found, root)
    filters = re.findall(r"PartitionFilters: \[([^\]]*created_month[^\]]*)\]", plan_of(new))
    assert filters and "1996-02-01" in filters[0] and "1996-03-01" in filters[0]
    scanned = new._jdf.queryExecution().executedPlan()
    assert new.count() == 0 and scanned is not None
    held = store.read_months(spark, root, store.months_of(found))
    assert {(r.y, r.m) for r in held.select(F.year("created_at").alias("y"), F.month("created_at").alias("m")).distinct().collect()} == {(1996, 2), (1996, 3)}


def test_the_search_for_missing_times_skips_closed_rows(spark, src):
    root = folder()
    table = run_once(spark, src, root)
    gate = enrich.missing_time_gate()
    open_rows = store.read_orders_table(spark, root, only_open=True)
    assert re.search(r"PartitionFilters: \[[^\]]*is_open", plan_of(open_rows))
    assert ids(timestamp_candidates(open_rows)) == ids(timestamp_candidates(table))
    closed = table.count() - table.where(gate).count()
    assert closed > 0 and open_rows.count() == table.where(gate).count()


def test_months_whose_last_row_was_closed(spark):
    """The open part of such a month is replaced too, and its place holder is never read."""
    root = folder()
    done = {"user_init_block_number": 5, "user_init": ts("1997-01-02T00:00:00")}
    rows = [{"create_order_id": f"o{i}", "created_at": ts(f"1997-0{1 + i % 3}-01T00:00:00"), "user_init_block_number": 5} for i in range(6)]
    store.write_orders(final_rows(spark, rows), root)
    months = [dt.date(1997, 1, 1), dt.date(1997, 2, 1)]
    changed = [dict(r, **(done if i % 3 == 0 else {})) for i, r in enumerate(rows) if i % 3 < 2]
    store.replace_months(spark, final_rows(spark, changed), months, root, folder())
    table = store.read_orders_table(spark, root)
    assert ids(table) == [f"o{i}" for i in range(6)]
    assert ids(store.read_orders_table(spark, root, only_open=True)) == ["o1", "o2", "o4", "o5"]
    assert table.where("created_at IS NULL").count() == 0


def test_enrichment_of_an_empty_table(spark, src):
    assert enrich_months(spark, src, folder()).count() == 0


# ---- settling what has changed


def test_settling_changes_equals_the_full_settle(spark, src):
    """After random updates the table that takes changes only is the one that settles all anew."""
    rng, root, full = random.Random(3), folder(), folder()
    known = {k: [r.asDict() for r in getattr(src, k).collect()] for k in ("create_orders", "matched_orders", "swaps")}
    runs = [ts(f"2030-01-0{d}T00:00:00") for d in range(1, 5)]
    some = lambda key, share: {i: rng.randrange(4) for i in key if rng.random() < share}
    finishes = some([s["swap_id"] for s in known["swaps"]], 0.5)  # the run by which it has
    matched = some([m["create_order_id"] for m in known["matched_orders"]], 0.2)
    ordered = some([o["create_id"] for o in known["create_orders"]], 0.1)
    swapped = [{**m, "source_swap_id": m["destination_swap_id"], "destination_swap_id": m["source_swap_id"]} for m in rng.sample(known["matched_orders"], 200)]

    def table(name, rows):
        schema = getattr(src, name).schema
        aware = lambda v: v.replace(tzinfo=dt.timezone.utc) if isinstance(v, dt.datetime) else v
        return spark.createDataFrame([tuple(aware(r[f.name]) for f in schema.fields) for r in rows], schema)

    def when(at, n, old):
        return runs[at] if at is not None and at <= n else ts(old)

    last = None
    for n, now in enumerate(runs):
        swaps = []
        for s in known["swaps"]:
            at = finishes.get(s["swap_id"])
            gone = {"redeem_tx_hash": None, "refund_tx_hash": None} if at is not None and at > n else {}
            swaps.append({**s, **gone, "updated_at": when(at, n, "2020-01-01T00:00:00")})
        matches = [{**m, "updated_at": when(matched.get(m["create_order_id"]), n, "2020-01-01T00:00:00")} for m in known["matched_orders"] if matched.get(m["create_order_id"], 0) <= n]
        matches += [{**m, "updated_at": runs[2]} for m in swapped if n >= 2]
        orders = [{**o, "created_at": when(ordered.get(o["create_id"]), n, "1997-05-05T00:00:00")} for o in known["create_orders"] if ordered.get(o["create_id"], 0) <= n]
        now_src = replace(src, create_orders=table("create_orders", orders), matched_orders=table("matched_orders", matches), swaps=table("swaps", swaps))
        sync(spark, now_src, root, since=last)
        sync(spark, now_src, full)
        assert rows_of(store.read_orders_table(spark, root)) == rows_of(store.read_orders_table(spark, full))
        last = now
    assert store.read_orders_table(spark, root).count() == 1197


def test_changed_orders(spark, src):
    since = ts("1998-01-01T00:00:00")
    tables = (src.create_orders, src.matched_orders, src.swaps)
    changed = settle.changed_orders(*tables, since)
    assert 0 < settle.settled_changes(*tables, changed).count() < 1197
    assert changed.count() == src.create_orders.where(F.col("created_at") >= F.lit(since)).count()
    assert changed.where("create_order_id IS NULL").count() == 0


# ---- bucketed lookups


def test_bucketed_lookups_are_not_shuffled(spark, src):
    old = {k: spark.conf.get(k) for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled")}
    name, where = f"tl_{uuid.uuid4().hex}", folder()
    lookups = write_lookups(spark, src.blocks, src.transactions, where, name)
    requests = enrich.lookup_requests(sync(spark, src, folder()))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plan = plan_of(enrich.resolve_all(requests, lookups.blocks, lookups.transactions, folder()))
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    # the requests, with their blocks by now, are dealt out; the lookup table and its hot keys' rows are read where they lie
    assert plan.count("Exchange hashpartitioning(") == 1 and plan.count("SortMergeJoin") == 1
    assert plan.count("Bucketed: true") == 2 and "HashAggregate(keys=[chain" not in plan
    raw = enrich.resolve_all(requests, src.blocks, src.transactions)
    assert rows_of(enrich.resolve_all(requests, lookups.blocks, lookups.transactions)) == rows_of(raw)


def test_lookups_grow_and_are_opened_again(spark, src):
    name, where = f"tl_{uuid.uuid4().hex}", folder()
    half = F.xxhash64("chain", "block_number") % 2 == 0
    first = write_lookups(spark, src.blocks.where(half), src.transactions.where(half), where, name, 4)
    grown = add_lookups(spark, first, src.blocks, src.transactions, where, name, 4)
    assert rows_of(grown.blocks) == rows_of(enrich.block_times(src.blocks))
    assert ids_of(grown.transactions) == ids_of(enrich.tx_records(src.transactions))
    again = open_lookups(spark, where, f"tl_{uuid.uuid4().hex}", 4)
    assert rows_of(again.blocks) == rows_of(grown.blocks) and rows_of(again.transactions) == rows_of(grown.transactions)
    twice = add_lookups(spark, again, src.blocks, src.transactions, where, name, 4)
    assert twice.blocks.count() == grown.blocks.count()


def ids_of(df):
    return sorted((r.chain, r.tx_hash) for r in df.collect())


def test_rows_without_required_columns_are_refused_and_reported(spark):
    good = final_rows(spark, [{"create_order_id": "a"}])
    bad = good.withColumns({"create_order_id": F.lit("b"), "created_at": F.lit(None).cast("timestamp"), "source_chain": F.lit(None).cast("string")})
    both = good.unionByName(bad)
    assert ids(storable(both)) == ["a"]
    assert [(r.create_order_id, r.missing) for r in rejected(both).collect()] == [("b", ["created_at", "source_chain"])]
