from datetime import datetime

from pyspark.sql import functions as F

from tablesync.functions import names as n
from tablesync.sources.frames import column_rows, empty_frame, sql_over


def test_names(spark):
    df = spark.createDataFrame([("App1", "t.x")], "s string, t string")
    full = n.qualified("s", "t")
    row = df.select(
        full.alias("full"),
        n.quoted("s", "t").alias("quoted"),
        n.schema_part(full).alias("schema"),
        n.table_part(full).alias("table"),
        n.same_name("s").alias("same"),
        n.path_part(F.lit("a/b/c"), 2).alias("part"),
    ).first()
    assert tuple(row) == ("App1.t.x", '"APP1"."T.X"', "App1", "t.x", "APP1", "b")


def test_sql_quotes():
    assert n.quote_identifier("a`b", "t", quote="`") == "`a``b`.`t`"
    assert n.quote_literal("o'x") == "'o''x'"


def test_lower(spark):
    df = spark.createDataFrame([("AbC", None)], "One string, TWO string")
    low = n.lower_values(n.lower_columns(df))
    assert low.columns == ["one", "two"]
    assert tuple(low.first()) == ("abc", None)


def test_stamped(spark):
    at = datetime(2024, 5, 6, 7, 8, 9)
    df = n.stamped(spark.range(2), "at", at).select(n.timestamp_text("at"))
    assert [r[0] for r in df.collect()] == ["2024-05-06 07:08:09"] * 2
    now = n.stamped(spark.range(50, numPartitions=4), "at").select("at").distinct()
    assert now.count() == 1


def test_frames(spark):
    assert empty_frame(spark, "a int").count() == 0
    assert sql_over(spark, "SELECT id FROM {rows} WHERE id > 0", rows=spark.range(2)).count() == 1
    rows = column_rows(spark, "s", "t", spark.range(1).schema).collect()
    assert [tuple(r) for r in rows] == [("s", "t", "id", "bigint")]
