from __future__ import annotations

import datetime as dt
from decimal import Decimal

import pytest
from helpers import AS_OF, SMALL_FILE, event, write_csv
from pyspark.sql import functions as F

from flowledger.constants import SOURCE_COLUMNS
from flowledger.operators.constraints import ConstraintViolation, audit
from flowledger.plans import pipeline, reports
from flowledger.plans.pipeline import refresh, run_pipeline
from flowledger.store import TableNotFound, Warehouse
from flowledger.tables import ALL_TABLES, QUARANTINE, RAW


@pytest.fixture
def store(spark, tmp_path):
    return Warehouse(spark, str(tmp_path / "warehouse")).create()


def counts(store):
    names = ("workflow_events_raw", "workflow_events_quarantine", "workflow_events_clean")
    facts = ("fact_workflow_run", "fact_exception", "fact_backlog_daily", "kpi_daily_summary")
    return {name: store[name].count() for name in names + facts}


SMALL_COUNTS = {
    "workflow_events_raw": 3,
    "workflow_events_quarantine": 1,
    "workflow_events_clean": 3,
    "fact_workflow_run": 3,
    "fact_exception": 1,
    "fact_backlog_daily": 1,
    "kpi_daily_summary": 3,
}


def test_small_file_end_to_end_twice(spark, store, tmp_path):
    path = write_csv(tmp_path / "small.csv", SMALL_FILE)
    result = run_pipeline(store, path, as_of=AS_OF)
    assert result["validation_summary"]["valid_rows"] == 3
    assert result["validation_summary"]["invalid_rows"] == 1
    assert result["staging_rows"] == 3
    assert result["warehouse_load_counts"]["kpi_daily_summary"] == 3
    assert counts(store) == SMALL_COUNTS

    summary = reports.kpi_summary(store).first()
    assert tuple(summary) == (3, 1, 1, 1, 2, 150.0, 8.0, 1.0, 85.0)
    daily = reports.kpi_daily(store).rows.collect()
    assert [(r.team_name, r.avg_age_hours, r.data_quality_score) for r in daily] == [
        ("FieldOps", Decimal("17.00"), Decimal("80.00")),
        ("RiskOps", Decimal("3.50"), Decimal("80.00")),
        ("RiskOps", Decimal("3.50"), Decimal("95.00")),
    ]
    backlog = reports.backlog(store).rows.first()
    assert (backlog.priority_name, backlog.open_workflow_count) == ("low", 1)
    assert (backlog.overdue_workflow_count, backlog.avg_age_hours) == (1, Decimal("17.00"))
    exception = reports.workflow_exceptions(store, "REQ-11").first()
    assert (exception.exception_type, exception.open_flag) == ("overdue_workflow", True)
    rejected = store.read(QUARANTINE).first()
    assert rejected.validation_errors == ["invalid_due_at", "invalid_priority"]
    day = store["dim_date"].drop("calendar_date").orderBy("date_key").collect()[1]
    assert tuple(day) == (20310310, 1, "Monday", 11, 3, "March", 1, 2031)
    keys = {n: store[n].collect() for n in ("dim_team", "dim_workflow_type", "dim_priority")}

    run_pipeline(store, path, as_of=AS_OF)
    assert counts(store) == SMALL_COUNTS
    assert {n: store[n].collect() for n in keys} == keys
    tables = {name: store[name] for name in ALL_TABLES}
    assert audit(tables, ALL_TABLES).where("violations > 0").count() == 0


def test_dry_run_writes_nothing(spark, store, tmp_path):
    path = write_csv(tmp_path / "small.csv", SMALL_FILE)
    result = run_pipeline(store, path, dry_run=True, as_of=AS_OF)
    assert result == {
        "validation_summary": {
            "input_rows": 4,
            "valid_rows": 3,
            "invalid_rows": 1,
            "quarantined_rows": 1,
        },
        "staging_rows": 3,
        "warehouse_load_counts": {},
    }
    assert set(counts(store).values()) == {0}


def test_redelivery_keeps_raw_and_refreshes_the_rest(spark, store, tmp_path):
    """Raw keeps its first content; staging and facts take the new one under the same raw id."""
    a = event(source_file_name="f.csv")
    bad = event(source_file_name="f.csv", workflow_id="REQ-9", status="odd")
    run_pipeline(store, write_csv(tmp_path / "f1.csv", [a, bad, a | {"source_row_number": "1"}]), as_of=AS_OF)
    before = store[RAW.name].first()
    changed = a | {"queue_name": "changed"}
    worse = bad | {"priority": "odd"}
    run_pipeline(store, write_csv(tmp_path / "f2.csv", [changed, worse]), as_of=AS_OF)
    raw = store[RAW.name].collect()
    assert [(r.raw_event_id, r.queue_name) for r in raw] == [(before.raw_event_id, "vault")]
    staged = store["workflow_events_clean"].collect()
    assert [(r.raw_event_id, r.queue_name) for r in staged] == [(before.raw_event_id, "changed")]
    assert [r.queue_name for r in store["fact_workflow_run"].collect()] == ["changed"]
    rejected = store.read(QUARANTINE).collect()
    assert [r.validation_errors for r in rejected] == [["invalid_status", "invalid_priority"]]


@pytest.mark.parametrize("facts_by", ["date_key", "month_key"])
def test_a_batch_replaces_its_dates_and_empties_slices(spark, tmp_path, facts_by):
    store = Warehouse(spark, str(tmp_path / "warehouse"), facts_by=facts_by).create()
    open_row = {"status": "queued", "completed_at": "", "due_at": "2031-03-10T10:00:00Z"}
    first = [
        event(source_file_name="a.csv", workflow_id="REQ-1", **open_row),
        event(
            source_file_name="a.csv",
            workflow_id="REQ-2",
            created_at="2031-03-14T08:00:00Z",
            started_at="",
            completed_at="2031-03-14T09:00:00Z",
            due_at="",
        ),
    ]
    run_pipeline(store, write_csv(tmp_path / "a.csv", first), as_of=AS_OF)
    assert store["fact_exception"].count() == store["fact_backlog_daily"].count() == 1

    # another file brings a clean workflow for 10 March: the open one disappears from that date
    second = [event(source_file_name="b.csv", workflow_id="REQ-3", team_name="NewTeam")]
    run_pipeline(store, write_csv(tmp_path / "b.csv", second), as_of=AS_OF)
    runs = store["fact_workflow_run"].orderBy("workflow_id").collect()
    assert [(r.workflow_id, r.date_key) for r in runs] == [("REQ-2", 20310314), ("REQ-3", 20310310)]
    assert store["fact_exception"].count() == store["fact_backlog_daily"].count() == 0
    assert store["kpi_daily_summary"].count() == 2
    assert store["workflow_events_clean"].count() == 3
    teams = {r.team_name: r.team_key for r in store["dim_team"].collect()}
    assert teams == {"RiskOps": 1, "NewTeam": 2}
    assert reports.kpi_daily(store, start="2031-03-11", end=dt.date(2031, 3, 31)).meta()["total"] == 1


@pytest.mark.parametrize(
    ("changes", "message"),
    [
        ({"created_at": ""}, r"workflow_events_raw.*created_at \(1 rows\)"),
        ({"payload": "{broken"}, "payload is not JSON"),
        ({"payload": ""}, "payload"),
        ({"exception_flag": "true"}, "fact_exception.*exception_type"),
    ],
)
def test_a_batch_the_tables_cannot_hold_writes_nothing(spark, store, tmp_path, changes, message):
    rows = [event(), event(workflow_id="REQ-2", **changes), event(status="odd")]
    with pytest.raises(ConstraintViolation, match=message):
        run_pipeline(store, write_csv(tmp_path / "x.csv", rows), as_of=AS_OF)
    assert set(counts(store).values()) == {0}


def test_quarantine_falls_back_to_csv(spark, tmp_path):
    tables = [t for t in ALL_TABLES.values() if t is not QUARANTINE]
    store = Warehouse(spark, str(tmp_path / "warehouse")).create(tables)
    assert not store.table_exists(QUARANTINE)
    with pytest.raises(TableNotFound):
        store.read(QUARANTINE)
    path = write_csv(tmp_path / "small.csv", SMALL_FILE)
    refresh(store, path, str(tmp_path / "runs"), "day", AS_OF)
    written = spark.read.option("header", True).option("escape", '"').csv(
        str(tmp_path / "runs/day/diagnostics/workflow_events_quarantine.csv")
    )
    assert written.first().validation_errors == '["invalid_due_at","invalid_priority"]'


def test_refresh_goes_on_behind_the_last_finished_stage(spark, store, tmp_path, monkeypatch):
    path = write_csv(tmp_path / "small.csv", SMALL_FILE)
    runs = str(tmp_path / "runs")

    def fails(*_):
        raise RuntimeError("lost")

    with monkeypatch.context() as patch:
        patch.setattr(pipeline, "load_warehouse", fails)
        with pytest.raises(RuntimeError, match="lost"):
            refresh(store, path, runs, "day", AS_OF)
    with monkeypatch.context() as patch:
        for done in ("load_raw", "load_quarantine", "batch_raw_keys"):
            patch.setattr(pipeline, done, fails)
        result = refresh(store, path, runs, "day", AS_OF)
    assert result["database_row_counts"] == {
        "workflow_events_raw": 3,
        "workflow_events_clean": 3,
        "fact_workflow_run": 3,
        "fact_exception": 1,
        "kpi_daily_summary": 3,
    }


def test_hot_keys_give_the_same_result_as_a_plain_count(spark, store, tmp_path):
    """A third of the rows share a workflow, a third share a (file, row)."""
    rows = []
    for i in range(900):
        row = event(workflow_id=f"REQ-{i:04d}", queue_name=f"q{i}", assignee_id=f"U{i % 7}")
        if i % 3 == 0:
            row |= {"workflow_id": "REQ-HOT", "completed_at": f"2031-03-10T09:{i // 15:02d}:{i % 60:02d}Z"}
        if i % 3 == 1:
            row |= {"source_row_number": "x"}
        rows.append(row)
    run_pipeline(store, write_csv(tmp_path / "hot.csv", rows), as_of=AS_OF)
    assert store[RAW.name].count() == 300 + 1 + 300
    assert store["fact_workflow_run"].count() == 1 + 1 + 300
    hot = store["fact_workflow_run"].where(F.col("workflow_id") == "REQ-HOT").first()
    latest = max((r for r in rows if r["workflow_id"] == "REQ-HOT"), key=lambda r: r["completed_at"])
    assert hot.queue_name == latest["queue_name"]
    kept = store[RAW.name].where("source_row_number = -1").first()
    assert kept.queue_name == "q1"


def test_large_row_numbers_stay_apart(spark, store, tmp_path):
    rows = [event(workflow_id=f"REQ-{i}", source_row_number=str(3_000_000_000 + i)) for i in range(5)]
    result = run_pipeline(store, write_csv(tmp_path / "large.csv", rows), as_of=AS_OF)
    assert result["row_account"]["raw_new"] == result["row_account"]["staged"] == 5
    assert store["fact_workflow_run"].count() == 5


def test_files_of_one_name_in_different_folders_stay_apart(spark, store, tmp_path):
    columns = [c for c in SOURCE_COLUMNS if c not in ("source_file_name", "source_row_number")]
    for folder in ("x", "y z+"):
        (tmp_path / "in" / folder).mkdir(parents=True)
        rows = [event(workflow_id=f"REQ-{folder}-{i}") for i in range(3)]
        write_csv(tmp_path / "in" / folder / "part.csv", rows, columns)
    result = run_pipeline(store, str(tmp_path / "in" / "*" / "part.csv"), as_of=AS_OF)
    assert result["row_account"]["raw_new"] == 6
    names = {r.source_file_name for r in store[RAW.name].collect()}
    assert names == {"x/part.csv", "y z+/part.csv"}


def test_the_newer_version_wins_under_one_row_number_and_others_are_counted(spark, store, tmp_path):
    rows = [
        event(queue_name="old", source_row_number="1"),
        event(queue_name="new", source_row_number="1", completed_at="2031-03-10T12:00:00Z"),
        event(workflow_id="REQ-2", source_row_number="1"),
        event(workflow_id="REQ-3", source_row_number="2"),
    ]
    path = write_csv(tmp_path / "one.csv", rows)
    assert run_pipeline(store, path, dry_run=True, as_of=AS_OF)["staging_rows"] == 2
    result = run_pipeline(store, path, as_of=AS_OF)
    assert result["row_account"] == {
        "source_rows": 4,
        "raw_new": 2,
        "raw_known": 0,
        "raw_repeats": 2,
        "rejected": 0,
        "reject_repeats": 0,
        "staged": 2,
        "older_versions": 1,
        "taken_rows": 1,
    }
    facts = {r.workflow_id: r.queue_name for r in store["fact_workflow_run"].collect()}
    assert facts == {"REQ-1": "new", "REQ-3": "vault"}
    rejected = store.read(QUARANTINE).collect()
    assert [(r.workflow_id, r.validation_errors) for r in rejected] == [("REQ-2", ["source_row_taken"])]


def test_rejects_without_a_number_are_counted(spark, store, tmp_path):
    rows = [event(workflow_id=f"REQ-{i}", status="odd", source_row_number="n") for i in range(4)]
    result = run_pipeline(store, write_csv(tmp_path / "r.csv", [*rows, event()]), as_of=AS_OF)
    account = result["row_account"]
    assert (account["rejected"], account["reject_repeats"]) == (1, 3)
    parts = ("raw_new", "raw_known", "raw_repeats", "rejected", "reject_repeats")
    assert sum(account[p] for p in parts) == account["source_rows"] == 5
    again = run_pipeline(store, write_csv(tmp_path / "r2.csv", [*rows, event()]), as_of=AS_OF)
    assert again["row_account"]["raw_known"] == 1


def test_more_than_a_page_of_exceptions_of_one_workflow(spark, store):
    frames = {n: store[n] for n in ALL_TABLES if store.table_exists(ALL_TABLES[n])}
    one = spark.range(620).selectExpr(
        "'REQ-1' AS workflow_id", "20310310 AS date_key", "1 AS team_key", "1 AS workflow_type_key",
        "1 AS priority_key", "'late' AS exception_type", "'failed' AS status_name",
        "cast(id AS int) AS error_count", "true AS open_flag",
    )
    frames["fact_exception"] = one
    frames["dim_date"] = spark.sql("SELECT 20310310 AS date_key, DATE'2031-03-10' AS calendar_date")
    frames["dim_team"] = spark.sql("SELECT 1 AS team_key, 'RiskOps' AS team_name")
    frames["dim_workflow_type"] = spark.sql("SELECT 1 AS workflow_type_key, 'KycRefresh' AS workflow_type")
    frames["dim_priority"] = spark.sql("SELECT 1 AS priority_key, 'low' AS priority_name")
    assert reports.workflow_exceptions(frames, "REQ-1").count() == 620


def test_a_run_id_takes_a_corrected_file_and_another_moment(spark, store, tmp_path):
    runs = str(tmp_path / "runs")
    path = write_csv(tmp_path / "in.csv", [event(queue_name="first")])
    refresh(store, path, runs, "day", AS_OF)
    write_csv(tmp_path / "in.csv", [event(queue_name="second"), event(workflow_id="REQ-2")])
    result = refresh(store, path, runs, "day", AS_OF)
    assert result["row_account"]["raw_known"] == result["row_account"]["raw_new"] == 1
    facts = {r.workflow_id: r.queue_name for r in store["fact_workflow_run"].collect()}
    assert facts == {"REQ-1": "second", "REQ-2": "vault"}
    again = refresh(store, path, runs, "day")  # the moment is kept with the run
    assert again["row_account"] == result["row_account"]
    refresh(store, path, runs, "day", "2031-03-12T00:00:00Z")
    assert spark.read.json(f"{runs}/day/run").first().as_of == "2031-03-12T00:00:00Z"
