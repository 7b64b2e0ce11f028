"""Plan rules for every batch query: no cartesian or nested-loop joins, no Python evaluation,
and scans read only the columns the query needs."""

import re

import pytest

from rowtide.plans.queries import QUERIES

from .conftest import SF_SMALL

# Queries that run a stream or land a table while being built; their final reads are plain scans.
RUNS_WHILE_BUILT = {"stream_envelope", "stream_latest", "stream_progress", "ordered_delivery", "change_table",
                    "table_scan", "envelope_variant", "stream_from_position", "stream_reordered", "stream_rate_late", "stream_change_table_compacted"}
FORBIDDEN = ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython",
             "FlatMapGroupsInPandas", "MapInPandas")


# Row numbering inside a multi-row event orders by every lineitem column (the fixture's rule).
ALL_LINEITEM_COLUMNS = {"flatten_insert", "flatten_delete", "pair_update", "pair_update_long", "event_envelopes"}
WIDTH = {"lineitem": 11, "orders": 6}


@pytest.mark.parametrize("name", sorted(set(QUERIES) - RUNS_WHILE_BUILT))
def test_plan_rules(spark, name):
    plan = QUERIES[name](spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
    assert not [f for f in FORBIDDEN if f in plan], plan
    scans = re.findall(r"FileScan parquet \[([^\]]*)\][^\n]*?Location: [^\n]*?\[([^\]]*)\]", plan)
    assert scans and len(scans) == plan.count("FileScan parquet"), plan
    for cols, path in scans:
        table = path.rsplit("/", 1)[-1].removesuffix(".parquet")
        if table in WIDTH and not (table == "lineitem" and name in ALL_LINEITEM_COLUMNS):
            assert len(cols.split(",")) < WIDTH[table], (name, table, cols)
