import random

from pyspark.sql import functions as F

from tablesync.operators import batches as b


def test_index_and_groups(spark):
    files = spark.createDataFrame(
        [("events/APP1/T/1",), ("events/app1/t/0",), ("events/app2/t/2",)], "path string"
    )
    groups = b.group_files(b.index_paths(files)).orderBy("schema_name").collect()
    assert [tuple(r) for r in groups] == [
        ("app1", "t", 2, "events/APP1/T/1"),
        ("app2", "t", 1, "events/app2/t/2"),
    ]


def test_batch_assign_against_brute_force(spark):
    names = [f"app{n}" for n in range(537)]
    draw = random.Random(5)
    rows = [(draw.choice(names),) for _ in range(4000)]
    df = spark.createDataFrame(rows, "schema_name string").repartition(9)
    # Small partitions stay apart, so that places are counted across them.
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    found = {r.schema_name: r.batch_id for r in b.batch_assign(df, size=50).collect()}
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    ranked = sorted({r[0] for r in rows})
    assert found == {name: i // 50 for i, name in enumerate(ranked)}


def test_members_and_initials(spark):
    index = b.index_paths(
        spark.createDataFrame([("e/Pat/t/1",), ("e/app/t/1",), ("e/x/t/1",)], "path string")
    )
    tenants = spark.createDataFrame([("APP",), ("pat",)], "app_id string")
    assert b.batch_members(index, tenants).count() == 2
    assert [r.schema_name for r in b.initial_filter(index).collect()] == ["Pat"]
    assert b.initial_filter(index, ["x"]).count() == 1


def test_runs_of_the_same_weight(spark):
    rng = random.Random(3)
    weights = {f"app{i}": rng.choice([0, 1, 5, 30, 200]) for i in range(300)} | {"giant": 90_000, None: 17}
    rows = [(n, w // 2) for n, w in weights.items()] + [(n, w - w // 2) for n, w in weights.items()]
    df = spark.createDataFrame(rows, "schema_name string, weight long").repartition(5)
    found = b.batch_by_weight(df, 7).collect()
    total, pieces, runs = sum(weights.values()), {}, {}
    for r in found:
        pieces[r.schema_name] = pieces.get(r.schema_name, 0) + r.weight
        runs[r.batch_id] = runs.get(r.batch_id, 0) + r.weight
    assert pieces == weights and set(runs) == set(range(7))
    assert max(runs.values()) <= total / 7 * 9 / 8 + 1
    giant = [r for r in found if r.schema_name == "giant"]
    assert len(giant) == giant[0].n_pieces > 40 and len({r.batch_id for r in giant}) > 5
    assert b.batch_by_weight(df.limit(0), 3).count() == 0
    assert {r.batch_id for r in b.batch_by_weight(df.withColumn("weight", F.lit(0)), 3).collect()} == {0}
