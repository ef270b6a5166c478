"""A key with most of the rows: joins beyond the broadcast limit are split at it."""

import pytest
from pyspark.sql import functions as F

from tablesync.operators.keys import KeyList
from tablesync.sinks.target import TargetTable


@pytest.fixture
def small_limits(spark):
    """Lets partitions of a few kilobytes count as skewed."""
    limits = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "4KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "8KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.shuffle.partitions": "8",
    }
    before = {name: spark.conf.get(name, None) for name in limits}
    for name, value in limits.items():
        spark.conf.set(name, value)
    yield
    for name, value in before.items():
        if value is None:
            spark.conf.unset(name)
        else:
            spark.conf.set(name, value)


def final_plan(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("keep", [True, False])
def test_key_list(spark, small_limits, keep):
    rows = spark.range(0, 40000, 1, 8).selectExpr("if(id % 3 = 0, id, 7) as k", "uuid() as u")
    keys = spark.range(20).select(F.col("id").alias("k"))
    made = KeyList.of(keys, ["k"], broadcast_bytes=0)
    assert "skew=true" in final_plan(made.keep(rows) if keep else made.drop(rows))


def test_large_merge(spark, small_limits, tmp_path, monkeypatch):
    plans = []
    write = TargetTable._write

    def kept(self, df):
        plans.append(df)
        write(self, df)

    target = TargetTable(
        f"{tmp_path}/t", ("id",), ("ts",), schema="id int, u string, ts int, schema_name string"
    )
    rows = spark.range(0, 30000, 1, 8).selectExpr(
        "'app1' as schema_name", "cast(if(id % 3 = 0, id, 7) as int) as id", "uuid() as u"
    )
    target.load(rows, rows.select("schema_name"))
    changes = spark.range(0, 3000).selectExpr(
        "'app1' as schema_name", "cast(id * 12 as int) as id", "'new' as u", "1 as ts"
    )
    monkeypatch.setattr(TargetTable, "_write", kept)
    # Read in small pieces, so that there is something to split.
    spark.conf.set("spark.sql.files.maxPartitionBytes", "64KB")
    joins = []
    merged = TargetTable._merged

    def seen(self, *args):
        result = merged(self, *args)
        joins.append(final_plan(result))
        return result

    monkeypatch.setattr(TargetTable, "_merged", seen)
    try:
        target.merge(changes, broadcast_bytes=0)
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")

    assert len(joins) == 1
    assert "LeftOuter, " in joins[0] and "skew=true" in joins[0]
    live = target.current(spark)
    assert live.where("u = 'new'").count() == 3000
    assert live.where("id = 7").count() == 20000
