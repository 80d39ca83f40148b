"""Registered queries against their DuckDB twins on sf0.001 (set PATHLATTICE_FULL_ORACLE=1 for all of them)."""

import os

import pytest

import __spark_entry__ as E
from pathlattice import catalog
from pathlattice.checks import compare, duck

SF = "/root/testdata/sf0.001"
CORE = ["k_shortest_paths", "k_shortest_many_queries", "k_shortest_multi_source", "ranked_results", "top_k_per_node",
        "meet_in_middle", "node_documents", "snapshot_tolerant_read", "edge_upsert", "edge_message_parse",
        "reweight_paths", "stream_reweight_paths", "stream_snapshot_publish", "path_overlay", "topic_demux"]
NAMES = list(catalog.QUERIES) if os.environ.get("PATHLATTICE_FULL_ORACLE") else CORE


def test_every_query_has_an_oracle():
    assert set(catalog.QUERIES) == set(catalog.ORACLES)
    assert set(catalog.QUERIES) <= set(E.queries()) and set(E.oracle_sql()) <= set(E.queries())


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns == ["query_id", "total", "line", "hops"]
    assert df.count() == 1427


@pytest.fixture(scope="module")
def con():
    return duck(SF)


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, con, name):
    ok, msg = compare(E.queries()[name](spark, SF), con, E.oracle_sql()[name])
    assert ok, msg
