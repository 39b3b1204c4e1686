from conftest import SF_SMALL

from tradelens.sources.fixtures import derive_sources


def test_fixture_counts_match_fixtures_md(spark):
    s = derive_sources(spark, SF_SMALL)
    assert s.create_orders.count() == 1500
    assert s.matched_orders.count() == 1364
    assert s.swaps.count() == 3000
    assert s.blocks.count() == 5540
    assert s.transactions.count() == 1865


def test_lookup_keys_unique(spark):
    s = derive_sources(spark, SF_SMALL)
    assert s.blocks.groupBy("chain", "block_number").count().where("count > 1").count() == 0
    assert s.transactions.groupBy("chain", "tx_hash").count().where("count > 1").count() == 0
