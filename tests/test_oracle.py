"""Every registered query equals its DuckDB oracle on the small fixture."""

import pytest

import __spark_entry__ as E
from rowtide.operators import ordered
from rowtide.plans.oracle import SQL
from rowtide.plans.queries import QUERIES
from rowtide.plans.verify import compare, duck_connection

from .conftest import SF_SMALL


# Queries with nothing to return on the one log file of the small fixture.
EMPTY_ON_SMALL: set[str] = set()


@pytest.fixture(scope="module")
def con():
    return duck_connection(SF_SMALL)


def test_every_query_has_oracle():
    assert set(QUERIES) == set(SQL)
    assert set(QUERIES) <= set(E.queries()) and set(SQL) <= set(E.oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    rep = compare(spark, con, name, SF_SMALL, QUERIES, SQL)
    assert rep["ok"], rep
    assert rep["spark_rows"] > 0 or name in EMPTY_ON_SMALL, f"{name} compares nothing"


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() >= 0
    assert "n_changes" in df.columns


SHUFFLE_PATH = ["schema_asof", "table_include", "table_exclude", "known_tables", "attach_primary", "db_allow"]


@pytest.mark.parametrize("name", SHUFFLE_PATH)
def test_unbroadcast_paths_match_oracle(spark, con, name, monkeypatch):
    """With the broadcast bound at 0 every lookup side takes the shuffle / bucketed path."""
    from rowtide.operators import joins
    monkeypatch.setattr(joins, "MAX_BROADCAST_ROWS", 0)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        rep = compare(spark, con, name, SF_SMALL, QUERIES, SQL)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert rep["ok"], rep


ZONE_SENSITIVE = ["envelope", "envelope_json", "query_passthrough", "decode_timestamp", "rate_tumbling",
                  "rate_session", "header_split", "stream_envelope", "decode_datetime_int", "change_table",
                  "table_scan", "envelope_variant", "stream_rate", "stream_sessions"]


@pytest.mark.parametrize("name", ZONE_SENSITIVE)
def test_results_do_not_depend_on_session_zone(spark, con, name):
    spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
    try:
        rep = compare(spark, con, name, SF_SMALL, QUERIES, SQL)
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert rep["ok"], rep


PARTITION_SENSITIVE = ["key_history", "continuity", "log_file_fill", "rate_session", "schema_intervals",
                       "pair_update", "latest_state_partial", "merge_feeds", "ordered_delivery"]


SF_MID = "/root/testdata/sf0.01"        # ten log files: ten position buckets per key


@pytest.fixture(scope="module")
def con_mid():
    return duck_connection(SF_MID)


@pytest.mark.parametrize("name", PARTITION_SENSITIVE)
def test_results_do_not_depend_on_partitioning(spark, con_mid, name, monkeypatch):
    """No AQE, three shuffle partitions and no broadcast, over several buckets per key:
    bucket edges and their carried neighbours land in other tasks."""
    monkeypatch.setattr(ordered, "HOT_ROWS", 0)  # every key is split
    conf = {"spark.sql.adaptive.enabled": "false", "spark.sql.shuffle.partitions": "3",
            "spark.sql.autoBroadcastJoinThreshold": "-1"}
    old = {k: spark.conf.get(k) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        rep = compare(spark, con_mid, name, SF_MID, QUERIES, SQL)
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    assert rep["ok"], rep
