"""What is written and shuffled on the way to the analysis table: keys and times once, wide rows no more than needed."""

import glob
import os
import re
import shutil
import tempfile

import pyarrow.parquet as pq
import pytest
from conftest import SF_SMALL
from helpers import final_rows, ts

from tradelens.operators import enrich
from tradelens.plans import registry, scheduled_sync
from tradelens.sources import store
from tradelens.sources.fixtures import derive_sources


@pytest.fixture()
def at_scale(spark):
    """Plan as on large inputs: no size-based broadcasts, static plan."""
    old = {k: spark.conf.get(k) for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled")}
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    yield spark
    for k, v in old.items():
        spark.conf.set(k, v)


@pytest.fixture()
def fresh(spark):
    """The state of an input that no other test has read."""
    root = tempfile.mkdtemp(prefix="tl-moved-")
    shutil.copyfile(f"{SF_SMALL}/orders.parquet", f"{root}/orders.parquet")
    return registry.state(spark, root)


def shuffled(df):
    """The column names of every hash exchange, by its keys."""
    mode = df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    text = df._jdf.queryExecution().explainString(mode)
    found = re.findall(r"Exchange\nInput \[\d+\]: \[([^\]]*)\]\nArguments: hashpartitioning\((.*), \d+\)", text)
    bare = lambda t: tuple(re.sub(r"#\d+L?", "", c.strip()) for c in t.split(","))
    return [(bare(keys), bare(columns)) for columns, keys in found]


def test_blocks_and_transactions_are_compared_by_their_keys(spark, at_scale):
    s = derive_sources(spark, SF_SMALL)
    assert shuffled(s.blocks) == [(("chain", "block_number"), ("chain", "block_number"))]
    assert shuffled(s.transactions) == [(("chain", "tx_hash"), ("chain", "tx_hash", "block_number"))]
    # one row per key already lies where the lookup table's bucket is
    assert [k for k, _ in shuffled(enrich.tx_records(s.transactions))] == [("chain", "tx_hash")]


def test_requests_travel_with_one_copy_of_their_key(spark, fresh, at_scale):
    run = fresh.run
    (keys, columns), *rest = shuffled(run.resolved)
    assert not rest and keys == ("chain", "_k")
    assert sorted(columns) == sorted(["create_order_id", "event", "chain", "tx_time", "_hot", "_hot_found_time", "_k"])


def test_a_time_of_its_own_and_a_missing_block(spark):
    """A request without a block takes its transaction's time, and meets no block whatever number one has."""
    rows = [
        {"create_order_id": "own", "source_chain": "bitcoin", "user_init_tx_hash": "a:0", "user_init_block_number": 7},
        {"create_order_id": "block", "source_chain": "bitcoin", "user_init_tx_hash": "b:0", "user_init_block_number": 7},
        {"create_order_id": "none", "source_chain": "ethereum", "user_init_tx_hash": "c", "user_init_block_number": 7},
    ]
    requests = enrich.lookup_requests(final_rows(spark, rows)).where("event = 'user_init'")
    salted = spark.range(1).selectExpr("'none' AS create_order_id", "'user_init' AS event").selectExpr(
        "'ethereum' AS chain", "-(pmod(xxhash64(create_order_id, event), 1 << 30) + 1) AS block_number", "9L AS block_time", "'9' AS block_time_raw"
    )
    blocks = spark.createDataFrame([("bitcoin", 7, 700, "700"), ("ethereum", 7, 701, "701")], salted.schema).unionByName(salted)
    tx = spark.createDataFrame([("bitcoin", "a", 7, 50), ("bitcoin", "b", 7, 0)], "chain string, tx_hash string, block_number long, block_time long")
    for path in (None, f"{tempfile.mkdtemp(prefix='tl-moved-')}/staged"):
        got = {r.create_order_id: r.block_time for r in enrich.resolve_all(requests, blocks, tx, path).collect()}
        assert got == {"own": 50, "block": 700, "none": None}


def test_tables_are_written_once_and_packed(spark, fresh):
    registry.q_route_matrix(spark, fresh.sf_dir).collect()
    assert not {"blocks", "transactions"} & set(os.listdir(fresh.base.removeprefix("file:")))  # the lookups hold them
    files = glob.glob(f"{fresh.base.removeprefix('file:')}/**/*.parquet", recursive=True)
    kinds = {pq.ParquetFile(f).metadata.row_group(0).column(0).compression for f in files if pq.ParquetFile(f).metadata.num_row_groups}
    assert files and kinds == {"ZSTD"}
    assert fresh.src.blocks.count() == 5540 and fresh.src.transactions.count() == 1865


def test_a_sync_derives_no_lookups(spark, fresh):
    registry.q_synced_orders(spark, fresh.sf_dir).count()
    assert "lookups" not in vars(fresh) and "src" not in vars(fresh)


def test_candidates_of_months_without_rows_meet_no_join(spark, at_scale):
    root = f"{tempfile.mkdtemp(prefix='tl-moved-')}/orders"
    day = lambda m, d: ts(f"1997-{m:02}-{d:02}T00:00:00")
    stored = final_rows(spark, [{"create_order_id": f"o{i}", "created_at": day(3, 1 + i)} for i in range(4)])
    found = final_rows(spark, [{"create_order_id": f"o{i}", "created_at": day(3 if i < 8 else 4, 1 + i)} for i in range(12)])
    store.ensure_table(spark, root)
    first = scheduled_sync.not_stored(spark, found, root)
    assert "Join" not in first._jdf.queryExecution().executedPlan().toString() and first.count() == 12
    store.write_orders(stored, root)
    new = scheduled_sync.not_stored(spark, found, root)
    assert sorted(r.create_order_id for r in new.collect()) == sorted(f"o{i}" for i in range(4, 12))


def test_the_job_writes_no_copy_of_the_open_rows(spark, fresh, monkeypatch):
    work = tempfile.mkdtemp(prefix="tl-moved-")
    root = f"{tempfile.mkdtemp(prefix='tl-moved-')}/orders"
    store.write_orders(fresh.stored, root)
    monkeypatch.setattr(scheduled_sync, "work_folder", lambda _: work)
    table = scheduled_sync.enrich_months(spark, fresh.lookups, root)
    assert sorted(os.listdir(work)) == ["found", "requests", "staging"]
    assert sorted(map(str, table.collect())) == sorted(map(str, fresh.enriched.collect()))
