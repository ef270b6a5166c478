"""The inputs of the registered queries, as views over the given tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _app() -> Column:
    return F.concat(F.lit("app"), (F.col("o_custkey") % 50).cast("string"))


def _tbl() -> Column:
    return F.concat(F.lit("tbl_"), F.col("o_orderkey").cast("string"))


def src_catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select(
        _app().alias("table_schema"),
        _tbl().alias("table_name"),
        F.when(F.col("o_orderstatus") == "P", "VIEW").otherwise("BASE TABLE").alias("table_type"),
    )


def wh_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        table(spark, sf_dir, "orders")
        .where("o_orderkey % 10 <> 0")
        .select(F.upper(_app()).alias("table_schema"), F.upper(_tbl()).alias("table_name"))
    )


def wh_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    columns = {"ID": "NUMBER", "NAME": "TEXT", "UPDATED_AT": "TIMESTAMP_NTZ"}
    described = F.array(
        *[
            F.struct(F.lit(name).alias("column_name"), F.lit(kind).alias("data_type"))
            for name, kind in columns.items()
        ]
    )
    return wh_tables(spark, sf_dir).select("table_schema", "table_name", F.inline(described))


def landing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select(
        "event_id",
        F.concat(
            F.lit("events/"),
            F.upper("event_type"),
            F.lit("/u"),
            F.col("user_id").cast("string"),
            F.lit("/"),
            F.col("event_id").cast("string"),
            F.lit(".parquet"),
        ).alias("path"),
    )


def control(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        table(spark, sf_dir, "events")
        .where("event_type <> 'signup'")
        .select(F.col("event_type").alias("app_id"))
        .distinct()
        .withColumn("flag", F.col("app_id").isin("click", "view", "error"))
    )


def run_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    too_long = "String is too long and would be truncated"
    # One tenant has no failures at any scale.
    fails = F.col("event_type") != "view"
    return (
        table(spark, sf_dir, "events")
        .where(F.col("event_type").isin("click", "view", "error"))
        .select(
            F.col("event_type").alias("app_id"),
            F.concat(F.lit("u"), F.col("user_id").cast("string")).alias("table_name"),
            F.when(fails & (F.col("value") > 255), "failed").otherwise("ok").alias("status"),
            F.when(fails & (F.col("value") > 300), too_long)
            .when(fails & (F.col("value") > 255), "connection reset")
            .alias("message"),
        )
    )


def target_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        table(spark, sf_dir, "customer")
        .where("c_custkey % 3 <> 0")
        .select(
            F.col("c_custkey").alias("id"),
            F.col("c_acctbal").alias("amount"),
            F.lit(None).cast("string").alias("last_type"),
        )
    )


def changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    kind = F.col("event_type")
    return table(spark, sf_dir, "events").select(
        F.col("user_id").alias("id"),
        F.col("value").alias("amount"),
        kind.alias("last_type"),
        "ts",
        F.col("event_id").alias("seq"),
        F.when(kind == "error", "D").when(kind == "signup", "I").otherwise("U").alias("op"),
    )


def src_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        table(spark, sf_dir, "orders")
        .where("o_orderkey % 7 <> 0")
        .select(F.col("o_orderkey").alias("id"), F.col("o_totalprice").alias("amount"))
    )


def tenant_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select(
        _app().alias("schema_name"), F.col("o_orderkey").alias("id"), F.col("o_totalprice").alias("amount")
    )


def tgt_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    price = F.col("o_totalprice")
    return (
        table(spark, sf_dir, "orders")
        .where("o_orderkey % 13 <> 0")
        .select(
            F.col("o_orderkey").alias("id"),
            F.when(F.col("o_orderkey") % 11 == 0, price + 1).otherwise(price).alias("amount"),
        )
    )
