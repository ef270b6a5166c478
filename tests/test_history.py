"""The log of several runs."""

from datetime import datetime

from tablesync.sinks.history import RunHistory

LOG = "app_id string, table_name string, status string, message string"


def test_three_runs(spark, tmp_path):
    history = RunHistory(f"{tmp_path}/log")
    assert history.rows(spark).isEmpty() and history.retry_plan(spark).isEmpty()
    log = lambda *rows: spark.createDataFrame(rows, LOG)
    # Names of runs do not tell their order.
    history.record(log(("App1", "users", "failed", "x"), ("app2", "users", "ok", None)), "z/1", datetime(2024, 1, 1), "users")
    history.record(log(("app1", "seg", "failed", "y")), "z/1", datetime(2024, 1, 1), "seg")
    history.record(log(("app1", "Users", "ok", None)), "a", datetime(2024, 1, 2))
    history.record(log(("app2", "users", "failed", "late"), ("app2", "users", "ok", None)), "m", datetime(2024, 1, 3), "one")
    for _ in range(2):
        history.record(log(("app3", "users", "ok", None)), "m", datetime(2024, 1, 3), "two")
    assert history.rows(spark).count() == 7 and history.of(spark, "z/1").count() == 3
    assert sorted(tuple(r)[:5] for r in history.latest(spark).collect()) == [
        ("app1", "seg", "failed", "y", "z/1"), ("app1", "users", "ok", None, "a"),
        ("app2", "users", "failed", "late", "m"), ("app3", "users", "ok", None, "m"),
    ]
    assert sorted(map(tuple, history.retry_plan(spark).collect())) == [("app1", "seg"), ("app2", "users")]
    assert sorted(map(tuple, history.summary(spark).collect())) == [("app1", 2, 1, 1), ("app2", 2, 0, 1), ("app3", 1, 1, 0)]
