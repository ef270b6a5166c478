"""What the plans of the registered queries must not contain, and what they must."""

import pytest

from tablesync.checks.queries import QUERIES

SF = "/root/testdata/sf0.001"
WRITING = {
    "merge_table",
    "stream_changes",
    "landing_files",
    "landing_changes",
    "missing_load",
    "full_load_log",
    "control_rewrite",
    "ledger_changes",
    "routed_changes",
    "declared_types",
    "split_buckets",
    "run_history",
    "bookmark_reads",
    "staged_publish",
    "reconcile_checksums",
}


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(set(QUERIES) - WRITING))
def test_no_pairing_of_everything(spark, name):
    text = plan(QUERIES[name](spark, SF))
    assert "CartesianProduct" not in text
    assert "NestedLoopJoin" not in text
    assert "Python" not in text


def test_only_needed_columns_are_read(spark):
    text = plan(QUERIES["missing_tables"](spark, SF))
    assert text.count("ReadSchema: struct<o_orderkey:bigint,o_custkey:bigint>") == 2
    assert "ReadSchema: struct<text:string,lang:string>" in plan(QUERIES["overlength"](spark, SF))


def test_filters_reach_the_scan(spark):
    text = plan(QUERIES["apply_changes"](spark, SF))
    assert "PushedFilters: [IsNotNull(c_custkey)]" in text and "c_custkey:bigint,c_acctbal:double" in text
    assert text.count("Exchange") == 2


def test_unlisted_joins_shuffle_reduced_sides(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = plan(QUERIES["missing_tables"](spark, SF))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    # Both sides are distinct before they are joined.
    assert text.index("SortMergeJoin") < text.index("HashAggregate")
