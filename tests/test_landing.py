import pytest

from tablesync.session import staged
from tablesync.sources import landing as l

CHANGE = "id int, value string, op string"


@pytest.mark.parametrize(
    "fmt,options", [("parquet", {}), ("json", {}), ("csv", {"header": "true", "sep": ";"})]
)
def test_formats_and_places(spark, tmp_path, fmt, options):
    root = f"{tmp_path}/in/events"
    for place in ("APP1/users", "app2/USERS", "app2/other"):
        rows = spark.createDataFrame([(1, place, "U")], CHANGE)
        rows.coalesce(1).write.format(fmt).options(**options).save(f"{root}/{place}")
    found = l.read_changes(spark, root, CHANGE, fmt, options=options)
    assert sorted((r.schema_name, r.table_name, r.value) for r in found.collect()) == [
        ("app1", "users", "APP1/users"),
        ("app2", "other", "app2/other"),
        ("app2", "users", "app2/USERS"),
    ]
    users = l.read_changes(spark, root, CHANGE, fmt, table="users", options=options)
    assert sorted(r.schema_name for r in users.collect()) == ["app1", "app2"]


def test_other_positions(spark, tmp_path):
    root = f"file:{tmp_path}/in/prefix/"
    rows = spark.createDataFrame([(1, "x", "U")], CHANGE)
    rows.coalesce(1).write.parquet(f"{root}2024/app1/day/users/more")
    where = {"schema_pos": 3, "table_pos": 5}
    found = l.read_changes(spark, root, CHANGE, table="users", **where).first()
    assert (found.schema_name, found.table_name) == ("app1", "users")
    index = l.landing_index(spark, root, **where).where("length > 0")
    assert {(r.schema_name, r.table_name) for r in index.collect()} == {("app1", "users")}
    assert index.first().path.startswith("prefix/2024/")
    with pytest.raises(ValueError):
        l.table_glob(root, "users", 3, 3)


def test_stage_survives_a_failure_only_if_asked(spark, tmp_path):
    for keep in (False, True):
        with pytest.raises(KeyError) as info:
            with staged(spark.range(2), "test", keep_on_error=keep):
                raise KeyError
        notes = getattr(info.value, "__notes__", [])
        assert len(notes) == keep
        if keep:
            assert spark.read.parquet(notes[0].split(" in ")[1]).count() == 2


def test_names_with_blanks_and_signs(spark, tmp_path):
    root = f"{tmp_path}/in/a b/events"
    for tenant in ("My App", "a+b", "100%"):
        rows = spark.createDataFrame([(1, tenant, "U")], CHANGE)
        rows.coalesce(1).write.parquet(f"{root}/{tenant}/users")
    found = l.read_changes(spark, root, CHANGE, table="users").collect()
    assert sorted((r.schema_name, r.table_name, r.value) for r in found) == [
        ("100%", "users", "100%"),
        ("a+b", "users", "a+b"),
        ("my app", "users", "My App"),
    ]
    index = l.landing_index(spark, root).where("length > 0")
    assert {r.schema_name.lower() for r in index.collect()} == {"my app", "a+b", "100%"}


def test_a_root_that_is_no_prefix_raises(spark, tmp_path):
    frame = spark.createDataFrame([("/x/other/file",)], "path string")
    with pytest.raises(Exception, match="not below"):
        frame.select(l.below_root("path", "/y/root")).collect()
