from __future__ import annotations

import pathlib

import pytest
from helpers import AS_OF, event, write_csv
from pyspark.sql import functions as F

from flowledger.operators.constraints import ConstraintViolation
from flowledger.operators.dimensions import MEMBER_KINDS, dimensions_of, seen_members
from flowledger.operators.numbering import stage
from flowledger.plans.pipeline import run_pipeline
from flowledger.store import _KEPT_COMMITS, Warehouse
from flowledger.tables import FACT_BACKLOG_DAILY, FACT_WORKFLOW_RUN, RAW, SLICED


class Lost(RuntimeError):
    pass


@pytest.fixture
def store(spark, tmp_path):
    return Warehouse(spark, str(tmp_path / "warehouse")).create()


def facts(store):
    return {t.name: sorted(map(str, store.read(t).drop("loaded_at").collect())) for t in SLICED}


def test_facts_and_mart_change_together_or_not_at_all(spark, store, tmp_path, monkeypatch):
    run_pipeline(store, write_csv(tmp_path / "a.csv", [event(source_file_name="a.csv")]), as_of=AS_OF)
    before = facts(store)
    other = [event(source_file_name="b.csv", workflow_id="REQ-2", status="failed", assignee_id="")]
    path = write_csv(tmp_path / "b.csv", other)
    commit = Warehouse.commit

    def stops(self, number, changes):
        if len(changes) == len(SLICED):
            raise Lost
        commit(self, number, changes)

    with monkeypatch.context() as patch:
        patch.setattr(Warehouse, "commit", stops)
        with pytest.raises(Lost):
            run_pipeline(store, path, as_of=AS_OF)
    assert facts(store) == before
    assert facts(Warehouse(spark, store.root)) == before
    assert (pathlib.Path(store.root) / FACT_WORKFLOW_RUN.path).is_dir()  # written, but not current

    run_pipeline(store, path, as_of=AS_OF)
    after = facts(Warehouse(spark, store.root))
    assert all(after[t.name] != before[t.name] for t in SLICED if t is not FACT_BACKLOG_DAILY)
    assert [r.workflow_id for r in store.read(FACT_WORKFLOW_RUN).collect()] == ["REQ-2"]
    assert store["fact_exception"].count() == 1


def test_a_new_file_is_loaded_without_a_look_at_stored_rows(spark, store, tmp_path, monkeypatch):
    rows = [event(source_file_name="a.csv", workflow_id=f"REQ-{i}", source_row_number=str(i)) for i in range(3)]
    run_pipeline(store, write_csv(tmp_path / "a.csv", rows), as_of=AS_OF)
    within = Warehouse.within

    def no_history(self, table, partitions):
        assert table is not RAW
        return within(self, table, partitions)

    new = [r | {"source_file_name": "b.csv"} for r in rows]
    with monkeypatch.context() as patch:
        patch.setattr(Warehouse, "within", no_history)
        result = run_pipeline(store, write_csv(tmp_path / "b.csv", new), as_of=AS_OF)
        assert result["row_account"]["raw_new"] == 3
        with pytest.raises(AssertionError):
            run_pipeline(store, write_csv(tmp_path / "c.csv", rows), as_of=AS_OF)
    mixed = [rows[0] | {"queue_name": "later"}, event(source_file_name="d.csv", workflow_id="REQ-9")]
    account = run_pipeline(store, write_csv(tmp_path / "d.csv", mixed), as_of=AS_OF)["row_account"]
    assert (account["raw_new"], account["raw_known"]) == (1, 1)
    assert store[RAW.name].count() == 7
    assert store[RAW.name].where("queue_name = 'later'").count() == 0
    files = {r.source_file_name: (r.n_rows, r.first_row, r.last_row) for r in store.delivered_files().collect()}
    assert files["b.csv"] == (3, 0, 2)


def test_a_stop_between_noting_a_file_and_appending_its_rows_loses_and_repeats_nothing(
    spark, store, tmp_path, monkeypatch
):
    path = write_csv(tmp_path / "a.csv", [event(source_file_name="a.csv")])
    with monkeypatch.context() as patch:
        patch.setattr(Warehouse, "append", lambda *_: (_ for _ in ()).throw(Lost()))
        with pytest.raises(Lost):
            run_pipeline(store, path, as_of=AS_OF)
    assert store[RAW.name].count() == 0
    for _ in range(2):
        run_pipeline(store, path, as_of=AS_OF)
        assert store[RAW.name].count() == store[FACT_WORKFLOW_RUN.name].count() == 1


def backlog(spark, days, workflows=1):
    rows = [(d, 1, 1, 1, workflows, 0, 1.5) for d in days]
    df = spark.createDataFrame(
        rows,
        "date_key int, team_key int, workflow_type_key int, priority_key int, open_workflow_count int, "
        "overdue_workflow_count int, avg_age_hours double",
    )
    return FACT_BACKLOG_DAILY.conform(df.withColumn(FACT_BACKLOG_DAILY.surrogate, F.monotonically_increasing_id()))


def test_nulls_are_refused_while_writing(spark, store):
    table = FACT_BACKLOG_DAILY
    store.replace(table, backlog(spark, [20310310]), [203103])
    broken = backlog(spark, [20310311]).withColumn("team_key", F.lit(None).cast("int"))
    with pytest.raises(ConstraintViolation, match=r"fact_backlog_daily.*team_key \(1 rows\)"):
        store.replace(table, broken, [203103])
    assert [r.date_key for r in store.read(table).collect()] == [20310310]


def test_old_partitions_stay_readable_for_some_commits_and_are_then_removed(spark, store):
    table = FACT_BACKLOG_DAILY
    store.replace(table, backlog(spark, [20310105]), [203101])
    store.replace(table, backlog(spark, [20310310], 0), [203103])
    old = store.read(table).where("date_key = 20310310")
    for n in range(1, _KEPT_COMMITS + 4):
        if n == _KEPT_COMMITS - 1:
            assert old.first().open_workflow_count == 0
        store.replace(table, backlog(spark, [20310310], n), [203103])
    folder = pathlib.Path(store.root) / table.path
    assert len(list(folder.glob("load=*/month_key=203103"))) <= _KEPT_COMMITS
    assert len(list(folder.glob("load=*/month_key=203101"))) == 1
    fresh = Warehouse(spark, store.root)
    rows = {r.date_key: r.open_workflow_count for r in fresh.read(table).collect()}
    assert rows == {20310105: 1, 20310310: _KEPT_COMMITS + 3}
    store.replace(table, backlog(spark, []), [203103])
    assert [r.date_key for r in fresh.read(table).collect()] == [20310105]


def test_members_and_counts_come_from_one_scan(spark, tmp_path):
    rows = [
        ("A", "X", "queued", "2031-03-10 08:00:00", True),
        ("A", None, "completed", "2031-03-10 23:59:59", False),
        (None, "X", "completed", None, True),
        ("", "Y", None, "2031-03-11 00:00:00", False),
    ]
    columns = "team_name string, workflow_type string, status string, created string, exception_flag boolean"
    staging = stage(
        spark.createDataFrame(rows, columns).withColumn("created_at", F.to_timestamp("created"))
    )
    seen = seen_members(staging)
    plan = seen._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Relation [") == 1
    found = {}
    for r in seen.collect():
        key = None if r.kind == "all" else r[r.kind]
        found[r.kind, key if key is None else str(key)] = (r.n_rows, r.n_flagged)
    assert found["all", None] == (4, 2)
    assert found["team_name", "A"] == (2, 1) and found["team_name", None] == (1, 1)
    assert found["workflow_type", None] == (1, 0) and found["status", None] == (1, 0)
    assert found["calendar_date", "2031-03-10"] == (2, 1)
    assert len(found) == 1 + 3 + 3 + 3 + 3 and set(k for k, _ in found) == {"all", *MEMBER_KINDS}
    dims = dimensions_of(stage(seen))
    assert sorted(str(r.team_name) for r in dims["dim_team"].collect()) == ["", "A", "None"]
    assert {r.status_name for r in dims["dim_status"].collect()} == {"queued", "completed"}
    assert {r.date_key for r in dims["dim_date"].collect()} == {20310310, 20310311}
