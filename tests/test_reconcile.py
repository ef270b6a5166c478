from collections import Counter, defaultdict
import random

import pytest

from tablesync.operators import reconcile as r

ROW = "id int, a string, b string"


def rows(df):
    return sorted((tuple(x) for x in df.collect()), key=repr)


def brute(source, target):
    over = Counter(source)
    over.subtract(Counter(target))
    sides = defaultdict(set)
    for row, net in over.items():
        if net:
            sides[row[0]].add("missing" if net > 0 else "extra")
    found = [(k, s.pop() if len(s) == 1 else "changed") for k, s in sides.items()]
    return sorted(found, key=repr)


@pytest.mark.parametrize("fingerprint", [False, True])
def test_rows_with_repeated_keys(spark, fingerprint):
    draw = random.Random(2)

    def some():
        key = 1 if draw.random() < 0.3 else draw.randrange(60)
        return key, draw.choice(["x", "y", None]), draw.choice(["x", None])

    source = [some() for _ in range(300)]
    target = [row for row in source if draw.random() < 0.9] + [some() for _ in range(20)]
    found = r.reconcile_rows(
        spark.createDataFrame(source, ROW),
        spark.createDataFrame(target, ROW),
        ["id"],
        fingerprint=fingerprint,
    )
    assert rows(found) == brute(source, target)


@pytest.mark.parametrize("fingerprint", [False, True])
def test_null_places_differ(spark, fingerprint):
    source = spark.createDataFrame([(1, "x", None)], ROW)
    target = spark.createDataFrame([(1, None, "x")], ROW)
    assert rows(r.reconcile_rows(source, target, ["id"], fingerprint)) == [(1, "changed")]


def test_columns_are_matched_by_name(spark):
    source = spark.createDataFrame([(1, "x", "y")], ROW)
    target = spark.createDataFrame([("y", "x", 1)], "b string, a string, id int")
    assert rows(r.reconcile_rows(source, target, ["id"])) == []


def test_counts(spark):
    source = spark.createDataFrame([("a", 1), ("a", 2), ("b", 1)], "s string, id int")
    target = spark.createDataFrame([("a", 1), ("c", 1)], "s string, id int")
    assert rows(r.reconcile_counts(source, target, ["s"])) == [
        ("a", 2, 1),
        ("b", 1, 0),
        ("c", 0, 1),
    ]


def test_schema(spark):
    kind = "table_schema string, table_name string, column_name string, data_type string"
    source = spark.createDataFrame(
        [("S", "T", "ID", "INT"), ("s", "t", "name", "text"), ("s", "t", "only", "int")], kind
    )
    target = spark.createDataFrame(
        [("s", "t", "id", "int"), ("S", "T", "NAME", "NUMBER"), ("s", "t", "more", "int")], kind
    )
    assert rows(r.reconcile_schema(source, target)) == [
        ("s", "t", "more", None, "int", "extra"),
        ("s", "t", "name", "text", "number", "type"),
        ("s", "t", "only", "int", None, "missing"),
    ]


def test_overlength(spark):
    df = spark.createDataFrame(
        [("g", "aaaa", "b"), ("g", "aaa", "bbbb"), ("h", None, "b")], "k string, x string, y string"
    )
    assert rows(r.overlength(df, {"x": 2, "y": 3}, ["k"])) == [("g", "x", 2, 4), ("g", "y", 1, 4)]
    assert rows(r.overlength(df, {"x": 3})) == [("x", 1, 4)]


def test_summary(spark):
    log = spark.createDataFrame(
        [
            ("a", "t", "failed", "String 'x' is too long and would be truncated"),
            ("a", "u", "failed", "timeout"),
            ("a", "v", "ok", None),
        ],
        "app_id string, table_name string, status string, message string",
    )
    assert rows(r.run_summary(log)) == [("a", 3, 2, 1)]
