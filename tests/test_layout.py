"""Buckets of a tenant that grows."""

import pytest
from pyspark.sql import functions as F

from tablesync.sinks import layout as l
from tablesync.sinks.target import BUCKET, TargetTable

ROW = "id long, value string, ts long, schema_name string"


def table(tmp_path, **more):
    return TargetTable(f"{tmp_path}/t", ("id",), ("ts",), schema=ROW, **more)


def rows_of(spark, ids, value, ts, tenant="app1"):
    return spark.createDataFrame([(i, value, ts, tenant) for i in ids], ROW)


def held(spark, target):
    return sorted((r.schema_name, r.id, r.value) for r in target.current(spark).collect())


def test_numbers_follow_linear_hashing(spark):
    hashed = spark.range(2000).select(F.xxhash64("id").alias("h"))
    counts = {n: [r[0] for r in hashed.select(l.bucket_number(F.col("h"), n)).collect()] for n in range(1, 10)}
    for n in range(1, 9):
        assert set(counts[n]) == set(range(n))
        moved = {(a, b) for a, b in zip(counts[n], counts[n + 1]) if a != b}
        assert moved == {(l.parted_bucket(n), n)}


def test_merge_split_merge(spark, tmp_path):
    target = table(tmp_path, buckets=1, tenant_buckets={"APP2": 2})
    target.merge(rows_of(spark, range(40), "a", 1).union(rows_of(spark, range(10), "x", 1, "App2")))
    assert target.layout(spark).version == 0 and target.layout(spark).own == {"app2": 2}
    before = {f.path: f.length for f in target._files(spark).where("schema_name = 'app2'").collect()}
    target.split(spark, "APP1", 4)
    assert target.layout(spark).own == {"app2": 2, "app1": 5}
    assert {r[0] for r in target.read(spark).where("schema_name = 'app1' and id is not null").select(BUCKET).distinct().collect()} == set(range(5))
    assert {f.path: f.length for f in target._files(spark).where("schema_name = 'app2'").collect()} == before
    # Whoever opens the table with other counts still finds each row.
    other = table(tmp_path, buckets=3)
    other.merge(rows_of(spark, range(20, 60), "b", 2))
    other.split(spark, "app1")
    other.load(rows_of(spark, range(5), "loaded", None, "app2"), spark.createDataFrame([("app2",)], "schema_name string"))
    want = [("app1", i, "a" if i < 20 else "b") for i in range(60)] + [("app2", i, "loaded") for i in range(5)]
    assert held(spark, target) == held(spark, other) == sorted(want)


@pytest.mark.parametrize("ends_at", [0, 1, 2, 3, 4])
def test_a_broken_split_is_finished(spark, tmp_path, monkeypatch, ends_at):
    target = table(tmp_path, buckets=2)
    target.merge(rows_of(spark, range(30), "a", 1))
    want = held(spark, target)
    done, store, write = [], l.Layout.store, TargetTable._write

    def step(call):
        def run(*args):
            if len(done) == ends_at:
                raise OSError("gone")
            done.append(1)
            return call(*args)

        return run

    monkeypatch.setattr(l.Layout, "store", step(store))
    monkeypatch.setattr(TargetTable, "_write", step(write))
    with pytest.raises(OSError):
        target.split(spark, "app1")
    monkeypatch.undo()
    # Nothing is seen twice, or missing, wherever it ended.
    assert held(spark, target) == want
    target.merge(rows_of(spark, range(3), "c", 2))
    assert held(spark, target) == [("app1", i, "c" if i < 3 else "a") for i in range(30)]
    assert not target.layout(spark).moving


def test_two_jobs_cannot_write_the_same_version(spark, tmp_path):
    one = l.Layout(1).store(spark, str(tmp_path))
    with pytest.raises(OSError):
        l.Layout(2).store(spark, str(tmp_path))
    assert l.stored_layout(spark, str(tmp_path)) == one
