import os
import random

import pytest

from tablesync.sinks.target import TargetTable
from tablesync.streaming.sync import sync_stream, sync_tables

CHANGE = "id int, value string, ts int, op string"


def brute(rows):
    state = {}
    for tenant, n, value, ts, op in sorted(rows, key=lambda r: r[3]):
        state[tenant, n] = None if op == "D" else value
    return sorted((*k, v) for k, v in state.items() if v is not None)


def live(spark, target):
    return sorted(
        tuple(r) for r in target.current(spark).select("schema_name", "id", "value").collect()
    )


@pytest.fixture
def target(tmp_path):
    return TargetTable(
        f"{tmp_path}/target", ("id",), ("ts",),
        schema="id int, value string, ts int, schema_name string", buckets=2,
    )


def land(spark, tmp_path, rows, files):
    for i in range(files):
        for tenant in sorted({r[0] for r in rows}):
            part = [r[1:] for k, r in enumerate(rows) if r[0] == tenant and k % files == i]
            if part:
                df = spark.createDataFrame(part, CHANGE).coalesce(1)
                df.write.mode("append").parquet(f"{tmp_path}/events/{tenant.upper()}/users")


def changes(n, seed):
    draw = random.Random(seed)
    times = draw.sample(range(10 * n), n)
    return [
        (draw.choice(["app1", "app2"]), draw.randrange(15), f"v{ts}", ts, draw.choice("IUUD"))
        for ts in times
    ]


def run(spark, tmp_path, target, **more):
    query = sync_stream(
        spark, f"{tmp_path}/events", CHANGE, "users", target, f"{tmp_path}/checkpoint",
        op_col="op", **more,
    )
    query.awaitTermination()
    return query


@pytest.mark.parametrize("files,per_batch", [(1, 10), (2, 1)])
def test_stream_gives_the_batch_result(spark, tmp_path, target, files, per_batch):
    rows = changes(80, files)
    land(spark, tmp_path, rows, files)
    run(spark, tmp_path, target, max_files=per_batch)
    assert live(spark, target) == brute(rows)
    # Nothing is read twice; later files are, in any order of their changes.
    idle = run(spark, tmp_path, target)
    assert all(p["numInputRows"] == 0 for p in idle.recentProgress)
    late = changes(40, 9)
    land(spark, tmp_path, late, 1)
    run(spark, tmp_path, target)
    assert live(spark, target) == brute(rows + late)


def test_merges_run_adaptively(spark, tmp_path, target, monkeypatch):
    seen = []
    merge = TargetTable.merge

    def kept(self, rows, *more):
        session = rows.sparkSession
        plan = rows.groupBy("id").count()._jdf.queryExecution().executedPlan().toString()
        seen.append((session.conf.get("spark.sql.adaptive.enabled"), "AdaptiveSparkPlan" in plan))
        merge(self, rows, *more)

    monkeypatch.setattr(TargetTable, "merge", kept)
    land(spark, tmp_path, changes(20, 2), 1)
    run(spark, tmp_path, target)
    assert seen == [("true", True)]


def test_unknown_tables_go_to_quarantine(spark, tmp_path, target):
    rows = changes(30, 4)
    land(spark, tmp_path, rows, 1)
    available = spark.createDataFrame([("APP1", "users")], "schema_name string, table_name string")
    run(spark, tmp_path, target, available=available, quarantine=f"{tmp_path}/aside")
    assert live(spark, target) == brute([r for r in rows if r[0] == "app1"])
    aside = spark.read.parquet(f"{tmp_path}/aside")
    assert aside.count() == sum(r[0] == "app2" for r in rows)
    with pytest.raises(ValueError):
        run(spark, tmp_path, target, available=available)


def test_archive(spark, tmp_path, target):
    land(spark, tmp_path, changes(10, 1), 1)
    more = {"archive": f"{tmp_path}/archive", "max_files": 1}
    run(spark, tmp_path, target, **more)
    land(spark, tmp_path, changes(10, 2), 1)
    run(spark, tmp_path, target, **more)
    moved = [n for _, _, names in os.walk(f"{tmp_path}/archive") for n in names]
    assert [n for n in moved if n.endswith(".parquet")]


def test_several_tables_side_by_side(spark, tmp_path, target):
    rows = changes(30, 6)
    land(spark, tmp_path, rows, 1)
    spark.createDataFrame([(1, "c", 1, "U")], CHANGE).write.parquet(f"{tmp_path}/events/APP1/cats")
    other = TargetTable(
        f"{tmp_path}/cats", ("id",), ("ts",), schema="id int, value string, ts int, schema_name string"
    )
    tables = {"users": (CHANGE, target), "cats": (CHANGE, other)}
    sync_tables(spark, f"{tmp_path}/events", tables, f"{tmp_path}/checkpoints", op_col="op")
    assert live(spark, target) == brute(rows)
    assert live(spark, other) == [("app1", 1, "c")]
    keyless = TargetTable(f"{tmp_path}/none", (), ("ts",), schema=other.schema)
    with pytest.raises(Exception, match="keys"):
        sync_tables(spark, f"{tmp_path}/events", {"cats": (CHANGE, keyless)}, f"{tmp_path}/more")
