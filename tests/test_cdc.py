import random

import pytest
from pyspark.sql import functions as F, types as T

from tablesync.operators import cdc

SCHEMA = "tenant string, id int, ts int, seq int, value string, op string"
KEYS, ORDER = ["tenant", "id"], ["ts", "seq"]


def made(n=400, seed=3):
    draw = random.Random(seed)
    found = []
    for seq in range(n):
        # A third of all changes hit one key.
        key = ("hot", 1) if draw.random() < 0.34 else (f"app{draw.randrange(3)}", draw.randrange(20))
        op = draw.choice("IUUD")
        found.append((*key, draw.randrange(30), seq, f"v{draw.randrange(9)}", op))
    return found


def brute(target, changes):
    state = dict(target)
    newest = {}
    for tenant, key, ts, seq, value, op in changes:
        if (tenant, key) not in newest or (ts, seq) > newest[tenant, key][:2]:
            newest[tenant, key] = (ts, seq, value, op)
    for key, (_, _, value, op) in newest.items():
        if op == "D":
            state.pop(key, None)
        else:
            state[key] = value
    return sorted(((*key, value) for key, value in state.items()), key=repr)


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_apply_changes_against_brute_force(spark):
    target = {("hot", 1): "old", ("app0", 5): "old", ("app9", 99): "kept"}
    frame = spark.createDataFrame(
        [(*k, v) for k, v in target.items()], "tenant string, id int, value string"
    )
    changes = made()
    df = spark.createDataFrame(changes, SCHEMA)
    found = cdc.apply_changes(frame, df, KEYS, ORDER, op_col="op")
    assert rows(found) == brute(target, changes)
    # The result does not depend on the order of the input.
    random.Random(1).shuffle(changes)
    again = spark.createDataFrame(changes, SCHEMA).repartition(7)
    assert rows(cdc.apply_changes(frame, again, KEYS, ORDER, op_col="op")) == rows(found)


@pytest.mark.parametrize("pieces", [1, 2, 5])
def test_late_and_repeated_changes(spark, pieces):
    changes = made(200, seed=pieces)
    df = spark.createDataFrame(changes, SCHEMA)
    target = spark.createDataFrame(
        [("app0", 5, "old", None, None, False)],
        "tenant string, id int, value string, ts int, seq int, deleted boolean",
    )
    parts = [df.where(F.col("seq") % pieces == i) for i in reversed(range(pieces))]
    for part in [*parts, parts[0]]:
        target = cdc.apply_changes(target, part, KEYS, ORDER, op_col="op")
    live = target.where("not deleted").select("tenant", "id", "value")
    assert rows(live) == brute({("app0", 5): "old"}, changes)


def test_without_operation_column_everything_is_an_upsert(spark):
    target = spark.createDataFrame([("a", 1, "x")], "tenant string, id int, value string")
    change = spark.createDataFrame([("a", 1, 1, 1, "y", "D"), ("a", 2, 1, 2, "z", None)], SCHEMA)
    assert rows(cdc.apply_changes(target, change, KEYS, ORDER)) == [("a", 1, "y"), ("a", 2, "z")]


def test_equal_order_has_one_result(spark):
    same = [("a", 1, 1, 1, v, "U") for v in "cab"]
    for part in (1, 3):
        df = spark.createDataFrame(same, SCHEMA).repartition(part)
        assert rows(cdc.latest_change(df, KEYS, ORDER)) == [("a", 1, 1, 1, "c", "U")]


def test_null_order_is_oldest(spark):
    df = spark.createDataFrame([("a", 1, None, 9, "x", "U"), ("a", 1, 0, 1, "y", "U")], SCHEMA)
    assert rows(cdc.latest_change(df, KEYS, ORDER)) == [("a", 1, 0, 1, "y", "U")]


def test_columns_without_an_order(spark):
    df = spark.createDataFrame(
        [(1, 1, {"a": 1}), (1, 2, {"a": 2})], "id int, ts int, tags map<string,int>"
    )
    assert cdc.latest_change(df, ["id"], ["ts"]).first()["tags"] == {"a": 2}


def test_one_row_per_key_before_the_shuffle(spark):
    df = spark.createDataFrame(made(), SCHEMA)
    plan = cdc.latest_change(df, KEYS, ORDER)._jdf.queryExecution().toString()
    assert "partial_max" in plan and plan.count("Exchange hashpartitioning") == 1


def test_align(spark):
    df = spark.createDataFrame([("7", "x", 1)], "ID string, Name string, extra int")
    schema = T.StructType.fromDDL("id int, name string, at timestamp")
    with pytest.raises(ValueError, match="extra"):
        cdc.align(df, schema)
    aligned = cdc.align(df, schema, ignored=["EXTRA"])
    assert aligned.dtypes == [("id", "int"), ("name", "string"), ("at", "timestamp")]
    assert tuple(aligned.first()) == (7, "x", None)


@pytest.mark.parametrize("pieces", [1, 2, 3])
def test_ties_do_not_depend_on_the_split(spark, pieces):
    same = [("a", 1, 1, 1, value, op) for value, op in (("c", "U"), ("b", "D"), ("c", "D"), ("a", "U"))]
    target = spark.createDataFrame([], "tenant string, id int, value string, ts int, seq int, deleted boolean")
    for i in [*range(pieces), 0]:
        part = spark.createDataFrame(same[i::pieces], SCHEMA)
        target = cdc.apply_changes(target, part, KEYS, ORDER, op_col="op")
    # The flag comes before the value in the order of names.
    assert rows(target) == [("a", 1, "c", 1, 1, True)]


def test_columns_that_changes_lack_keep_their_values(spark):
    target = spark.createDataFrame([("a", 1, "x", "keep")], "tenant string, id int, value string, other string")
    change = spark.createDataFrame([("a", 1, 1, 1, "y", "U"), ("a", 2, 1, 1, "z", "U")], SCHEMA)
    found = cdc.apply_changes(target, change, KEYS, ORDER, op_col="op")
    assert rows(found) == [("a", 1, "y", "keep"), ("a", 2, "z", None)]
