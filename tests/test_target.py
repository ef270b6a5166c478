import os
import random
import re

import pytest

from tablesync.sinks.target import TargetTable

DATA = "id int, value string, ts int, schema_name string"
CHANGE = "schema_name string, id int, value string, ts int, op string"


def table(path, **more):
    return TargetTable(str(path / "t"), ("id",), ("ts",), schema=DATA, **more)


def live(spark, target):
    rows = target.current(spark).select("schema_name", "id", "value").collect()
    return sorted(tuple(r) for r in rows)


def files(path):
    return {
        os.path.join(folder, name)
        for folder, _, names in os.walk(path)
        for name in names
        if name.endswith(".parquet")
    }


def loaded(spark, tmp_path, rows, **more):
    target = table(tmp_path, **more)
    df = spark.createDataFrame(rows, "schema_name string, id int, value string")
    target.load(df, df.select("schema_name"))
    return target


def test_numeric_tenant_names_stay_text(spark, tmp_path):
    target = loaded(spark, tmp_path, [("007", 1, "x"), ("7", 1, "y")])
    assert live(spark, target) == [("007", 1, "x"), ("7", 1, "y")]
    undeclared = TargetTable(target.path, target.keys, target.order)
    assert live(spark, undeclared) == live(spark, target)


@pytest.mark.parametrize("limit", [0, 1 << 26])
def test_merge_against_brute_force(spark, tmp_path, limit):
    draw = random.Random(limit)
    first = [("hot", n, "old") for n in range(90)] + [("a", n, "old") for n in range(30)]
    target = loaded(spark, tmp_path, first, buckets=2, tenant_buckets={"hot": 5})
    state = {(t, n): (v, -1) for t, n, v in first}
    for _ in range(2):
        batch = []
        for _ in range(60):
            tenant = draw.choice(["hot", "hot", "a", "new"])
            batch.append(
                (tenant, draw.randrange(120), f"v{draw.random()}", draw.randrange(10**6), draw.choice("UUD"))
            )
        for tenant, n, value, ts, op in batch:
            if state.get((tenant, n), (None, -1))[1] <= ts:
                state[tenant, n] = (None if op == "D" else value, ts)
        changes = spark.createDataFrame(batch, CHANGE)
        target.merge(changes, op_col="op", broadcast_bytes=limit)
        target.merge(changes, op_col="op", broadcast_bytes=limit)
        wanted = sorted((*k, v) for k, (v, _) in state.items() if v is not None)
        assert live(spark, target) == wanted


def test_only_touched_partitions_are_rewritten(spark, tmp_path):
    rows = [(f"app{t}", n, "x") for t in range(4) for n in range(40)]
    target = loaded(spark, tmp_path, rows, buckets=4)
    before = files(tmp_path)
    target.merge(spark.createDataFrame([("app2", 7, "y", 1, "U")], CHANGE), op_col="op")
    gone = {os.path.dirname(f) for f in before - files(tmp_path)}
    assert len(gone) == 1 and "schema_name=app2" in gone.pop()
    assert len(live(spark, target)) == 160


def test_reads_only_touched_folders(spark, tmp_path):
    target = loaded(spark, tmp_path, [(f"app{t}", 1, "x") for t in range(6)])
    wanted = spark.createDataFrame([("app1",)], "schema_name string")
    found = target.of_tenants(spark, wanted)
    plan = found._jdf.queryExecution().toString()
    assert re.search(r"PartitionFilters: \[[^\]]*concat_ws", plan)
    assert {r.schema_name for r in found.collect()} == {"app1"}


def test_load_empties_tenants_and_leaves_others(spark, tmp_path):
    rows = [("a", n, "x") for n in range(20)] + [("b", 1, "x"), ("c", 1, "x")]
    target = loaded(spark, tmp_path, rows, buckets=3)
    again = spark.createDataFrame([("a", 1, "new")], "schema_name string, id int, value string")
    tenants = spark.createDataFrame([("a",), ("b",)], "schema_name string")
    target.load(again, tenants)
    assert live(spark, target) == [("a", 1, "new"), ("c", 1, "x")]
    # Hidden rows do not get in the way of changes.
    target.merge(spark.createDataFrame([("b", 5, "y", 1, "U")], CHANGE), op_col="op")
    assert ("b", 5, "y") in live(spark, target)


def test_a_tenant_emptied_by_deletes_stays_empty(spark, tmp_path):
    target = loaded(spark, tmp_path, [("a", 1, "x")])
    target.merge(spark.createDataFrame([("a", 1, None, 9, "D")], CHANGE), op_col="op")
    assert live(spark, target) == []
    target.merge(spark.createDataFrame([("a", 1, "late", 5, "U")], CHANGE), op_col="op")
    assert live(spark, target) == []
    target.merge(spark.createDataFrame([("a", 1, "back", 10, "I")], CHANGE), op_col="op")
    assert live(spark, target) == [("a", 1, "back")]


def test_merge_into_nothing_and_of_nothing(spark, tmp_path):
    target = table(tmp_path)
    target.merge(spark.createDataFrame([], CHANGE), op_col="op")
    assert live(spark, target) == []
    target.merge(spark.createDataFrame([("a", 1, "x", 1, "I")], CHANGE), op_col="op")
    assert live(spark, target) == [("a", 1, "x")]


def test_changes_without_key_are_refused(spark, tmp_path):
    target = loaded(spark, tmp_path, [("a", 1, "x")])
    for key in [("a", None), (None, 1)]:
        with pytest.raises(ValueError):
            target.merge(spark.createDataFrame([(*key, "y", 1, "U")], CHANGE), op_col="op")
    assert live(spark, target) == [("a", 1, "x")]


def test_more_partitions_than_the_list_takes(spark, tmp_path, monkeypatch):
    monkeypatch.setattr("tablesync.sinks.target.MAX_PARTITION_LIST", 1)
    target = loaded(spark, tmp_path, [(f"app{t}", 1, "x") for t in range(4)])
    changes = [(f"app{t}", 1, "y", 1, "U") for t in range(3)]
    target.merge(spark.createDataFrame(changes, CHANGE), op_col="op")
    assert [r[2] for r in live(spark, target)] == ["y", "y", "y", "x"]


def test_files_do_not_pile_up(spark, tmp_path):
    target = loaded(spark, tmp_path, [("a b%", n, "x") for n in range(10)], buckets=2)
    for n in range(4):
        target.merge(spark.createDataFrame([("a b%", 100 + n, "y", n, "I")], CHANGE), op_col="op")
    assert len(live(spark, target)) == 14
    assert len(files(tmp_path)) <= 6


def test_repeated_and_missing_keys_in_the_table_stay(spark, tmp_path):
    rows = [("a", 1, "x")] * 200 + [("a", None, "n")] * 100
    for limit in (0, 1 << 26):
        target = loaded(spark, tmp_path / str(limit), rows)
        changes = [("a", 1, "y", 1, "U"), ("a", 2, "z", 1, "I")]
        target.merge(spark.createDataFrame(changes, CHANGE), op_col="op", broadcast_bytes=limit)
        found = target.current(spark).groupBy("id", "value").count().collect()
        assert {tuple(r) for r in found} == {(1, "y", 200), (None, "n", 100), (2, "z", 1)}


def test_a_tenant_is_the_same_in_any_case(spark, tmp_path):
    target = loaded(spark, tmp_path, [("APP1", 1, "x")], tenant_buckets={"App1": 2})
    target.merge(spark.createDataFrame([("App1", 1, "y", 1, "U")], CHANGE), op_col="op")
    assert live(spark, target) == [("app1", 1, "y")]
    tenants = spark.createDataFrame([("APP1",)], "schema_name string")
    assert target.of_tenants(spark, tenants).where("not deleted").count() == 1


def test_stage_is_removed(spark, tmp_path):
    from tablesync.session import shared_dir

    target = loaded(spark, tmp_path, [("a", 1, "x")])
    target.merge(spark.createDataFrame([("a", 1, "y", 1, "U")], CHANGE), op_col="op")
    folder = shared_dir(spark).removeprefix("file:")
    assert not [n for n in os.listdir(folder) if n.startswith("changes-")]


def test_shuffles_grow_with_the_data(spark):
    from tablesync.config import FILE_BYTES
    from tablesync.session import wide_shuffle

    name = "spark.sql.shuffle.partitions"
    before = spark.conf.get(name)
    with wide_shuffle(spark, 50 * FILE_BYTES):
        assert spark.conf.get(name) == "50"
    with pytest.raises(KeyError), wide_shuffle(spark, 0):
        assert spark.conf.get(name) == before
        raise KeyError
    assert spark.conf.get(name) == before


def test_columns_that_changes_lack_keep_their_values(spark, tmp_path):
    for limit in (0, 1 << 26):
        target = loaded(spark, tmp_path / str(limit), [("a", 1, "kept"), ("a", 2, "kept")])
        change = spark.createDataFrame([("a", 1, 5, "U"), ("a", 3, 5, "U"), ("a", 2, 6, "D")], "schema_name string, id int, ts int, op string")
        target.merge(change, op_col="op", broadcast_bytes=limit)
        assert live(spark, target) == [("a", 1, "kept"), ("a", 3, None)]


def test_columns_that_the_table_lacks_are_refused(spark, tmp_path):
    target = loaded(spark, tmp_path, [("a", 1, "x")])
    change = spark.createDataFrame([("a", 1, "y", 1, "U", 9)], CHANGE + ", added int")
    with pytest.raises(ValueError, match="added"):
        target.merge(change, op_col="op")
    target.merge(change, op_col="op", ignored=("added",))
    assert live(spark, target) == [("a", 1, "y")]


def test_empty_tenants_are_refused(spark, tmp_path):
    target = loaded(spark, tmp_path, [("a", 1, "x")])
    change = spark.createDataFrame([("", 1, "y", 1, "U")], CHANGE)
    with pytest.raises(Exception, match="empty schema_name"):
        target.merge(change, op_col="op")
    rows = spark.createDataFrame([("", 1, "y")], "schema_name string, id int, value string")
    with pytest.raises(Exception, match="empty schema_name"):
        target.load(rows, rows.select("schema_name"))
    assert live(spark, target) == [("a", 1, "x")]


@pytest.mark.parametrize("listed", [1000, 0])
def test_a_merge_lists_only_the_folders_it_touches(spark, tmp_path, monkeypatch, listed):
    from tablesync.sinks import target as t

    odd = "a b=c/d%e[1]"
    target = loaded(spark, tmp_path, [(n, i, "x") for n in ("app1", "app2", odd) for i in range(6)], buckets=2)
    monkeypatch.setattr(t, "MAX_FOLDER_LIST", listed)
    whole = []
    read = t.TargetTable.read
    monkeypatch.setattr(t.TargetTable, "read", lambda self, s: whole.append(1) or read(self, s))
    changes = [(odd, 3, "y", 1, "U"), ("new one", 1, "z", 1, "U"), ("app2", 2, None, 1, "D")]
    target.merge(spark.createDataFrame(changes, CHANGE), op_col="op")
    assert bool(whole) == (listed == 0)
    monkeypatch.undo()
    rows = live(spark, target)
    assert len(rows) == 18 and (odd, 3, "y") in rows and ("new one", 1, "z") in rows and ("app2", 2, "x") not in rows
