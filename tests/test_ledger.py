"""Landing files applied by the batch job: each once, whatever breaks off."""

import pytest

from tablesync.plans import changes as c
from tablesync.sinks.appended import AppendedTable
from tablesync.sinks.ledger import FileLedger
from tablesync.sinks.target import TargetTable

SCHEMA = "id long, value string, ts long, op string"


@pytest.fixture
def job(spark, tmp_path):
    class Job:
        root = f"{tmp_path}/in/events"
        ledger = FileLedger(f"{tmp_path}/ledger")
        users = TargetTable(f"{tmp_path}/users", ("id",), ("ts",), schema="id long, value string, ts long, schema_name string")
        notes = AppendedTable(f"{tmp_path}/notes", "id long, value string, ts long, op string, schema_name string")
        routes = {"USERS": c.Route(users, SCHEMA, "op"), "notes": c.Route(notes, SCHEMA)}

        def land(self, place, *rows):
            df = spark.createDataFrame([(i, v, t, o) for i, v, t, o in rows], SCHEMA)
            df.coalesce(1).write.mode("append").parquet(f"{self.root}/{place}")

        def run(self, **options):
            return c.apply_new(spark, self.root, self.routes, self.ledger, **options)

        def rows(self):
            users = [(r.schema_name, r.id, r.value) for r in self.users.current(spark).collect()]
            notes = [(r.schema_name, r.id, r.value) for r in self.notes.current(spark).collect()]
            return sorted(users), sorted(notes)

    job = Job()
    job.land("App1/users", (1, "a", 1, "U"), (2, "b", 1, "U"))
    job.land("app2/Notes", (1, "n", 1, "U"), (1, "n", 1, "U"))
    return job


def test_applied_files_are_not_read_again(spark, job, monkeypatch):
    log = job.run()
    assert sorted((r.table_name, r.n_files, r.status) for r in log.collect()) == [("notes", 1, "ok"), ("users", 1, "ok")]
    monkeypatch.setattr(c, "read_files", lambda *a, **k: pytest.fail("a file is read again"))
    assert job.run().collect() == []
    monkeypatch.undo()
    job.land("app1/users", (1, "c", 2, "U"), (2, "b", 2, "D"))
    job.land("app2/notes", (3, "m", 1, "U"))
    assert job.run().count() == 2
    assert job.rows() == ([("app1", 1, "c")], [("app2", 1, "n"), ("app2", 1, "n"), ("app2", 3, "m")])


def test_a_broken_run_is_taken_up_again(spark, job, monkeypatch):
    close = FileLedger.close

    def broken(self, spark, run, table):
        raise OSError("gone")

    monkeypatch.setattr(FileLedger, "close", broken)
    with pytest.raises(c.LandingFailed) as failure:
        job.run()
    assert {r.status for r in failure.value.log.collect()} == {"failed"}
    monkeypatch.setattr(FileLedger, "close", close)
    # The rows are there already; new files come with the next run.
    job.land("app2/notes", (3, "m", 1, "U"))
    assert job.run().count() == 3
    assert job.ledger.open_runs(spark) == []
    assert job.rows() == ([("app1", 1, "a"), ("app1", 2, "b")], [("app2", 1, "n"), ("app2", 1, "n"), ("app2", 3, "m")])


def test_one_table_fails_and_the_others_go_on(spark, job):
    job.land("app1/users", (None, "no key", 1, "U"))
    with pytest.raises(c.LandingFailed, match="users"):
        job.run()
    assert job.rows() == ([], [("app2", 1, "n"), ("app2", 1, "n")])
    assert len(job.ledger.open_runs(spark)) == 1
    assert [r.table_name for r in job.ledger.closed(spark).collect()] == ["notes"]


def test_archive_forgets_what_it_moved(spark, job, tmp_path):
    job.run(archive=f"{tmp_path}/done")
    assert not list((tmp_path / "in").rglob("part-*.parquet"))
    assert len(list((tmp_path / "done").rglob("part-*.parquet"))) == 2
    assert job.ledger.closed(spark).count() == 0
    assert job.run(archive=f"{tmp_path}/done").collect() == []
    # Left in place by a job that ended before it archived.
    job.land("app2/notes", (4, "x", 1, "U"))
    job.run()
    job.run(archive=f"{tmp_path}/done")
    assert len(list((tmp_path / "done").rglob("part-*.parquet"))) == 3
    assert job.rows()[1][-1] == ("app2", 4, "x")


def test_runs_of_few_files(spark, job):
    for n in range(4):
        job.land(f"a[{n}] b/notes", (n, "odd {name}", 1, "U"))
    log = job.run(max_files=2)
    assert len({r.run for r in log.collect()}) == 3
    assert len(job.rows()[1]) == 6 and job.ledger.closed(spark).count() == 6


def test_unknown_tables_and_names(spark, job, tmp_path):
    job.land("app9/users", (9, "aside", 1, "U"))
    job.land("app1/other", (9, "no route", 1, "U"))
    available = spark.createDataFrame([("APP1", "users"), ("app2", "notes")], "schema_name string, table_name string")
    with pytest.raises(ValueError):
        job.run(available=available)
    job.run(available=available, quarantine=f"{tmp_path}/aside")
    aside = spark.read.option("recursiveFileLookup", "true").parquet(f"{tmp_path}/aside").collect()
    assert [(r.schema_name, r.value) for r in aside] == [("app9", "aside")]
    assert job.rows()[0] == [("app1", 1, "a"), ("app1", 2, "b")]


def test_a_repeated_run_of_rows_without_keys(spark, tmp_path):
    table = AppendedTable(f"{tmp_path}/t", "id long, schema_name string")
    assert table.current(spark).count() == 0
    rows = spark.createDataFrame([(1, "A"), (1, "a"), (2, "b")], "id long, schema_name string")
    for run in ("r1", "r1", "r2"):
        table.append(rows, run)
    assert sorted(map(tuple, table.current(spark).collect())) == [(1, "a")] * 4 + [(2, "b")] * 2
    with pytest.raises(Exception, match="empty schema_name"):
        table.append(spark.createDataFrame([(1, "")], "id long, schema_name string"), "r3")
