from __future__ import annotations

import csv

from flowledger.constants import SOURCE_COLUMNS

AS_OF = "2031-03-11T00:00:00Z"


def event(**changes) -> dict:
    """A valid source row with the given cells changed; its number is its place unless it is given."""
    row = {
        "source_file_name": "shift.csv",
        "workflow_id": "REQ-1",
        "workflow_type": "KycRefresh",
        "team_name": "RiskOps",
        "assignee_id": "clerk-3",
        "priority": " Medium",
        "status": "Completed ",
        "queue_name": "vault",
        "created_at": "2031-03-10T06:00:00Z",
        "started_at": "2031-03-10T06:45:00Z",
        "completed_at": "2031-03-10T09:30:00Z",
        "due_at": "2031-03-13T06:00:00Z",
        "backlog_flag": "no",
        "exception_flag": "0",
        "exception_type": "",
        "source_system": "ledgerline",
        "records_touched": "7",
        "error_count": "2",
        "payload": '{"batch": 4}',
    }
    return {**row, **changes}


def numbered(rows) -> list[dict]:
    return [{"source_row_number": str(i + 1), **r} for i, r in enumerate(rows)]


def events(spark, *rows: dict):
    """All-text DataFrame of source rows."""
    columns = list(dict.fromkeys([*SOURCE_COLUMNS, *(c for r in rows for c in r)]))
    cells = [tuple(r.get(c) for c in columns) for r in numbered(rows)]
    return spark.createDataFrame(cells, ", ".join(f"{c} string" for c in columns))


def write_csv(path, rows: list[dict], columns=SOURCE_COLUMNS) -> str:
    with open(path, "w", newline="", encoding="utf-8") as file:
        writer = csv.DictWriter(file, fieldnames=list(columns), extrasaction="ignore")
        writer.writeheader()
        writer.writerows(numbered(rows))
    return str(path)


# Two days of one file: a finished request, an open one past its due time, a failed one, a reject.
SMALL_FILE = [
    event(source_file_name="small.csv", workflow_id="REQ-10"),
    event(
        source_file_name="small.csv",
        workflow_id="REQ-11",
        workflow_type="ClaimsValidation",
        team_name="FieldOps",
        assignee_id=" ",
        priority="low",
        status="in_progress",
        created_at="2031-03-10T07:00:00Z",
        started_at="2031-03-10T07:30:00Z",
        completed_at="",
        due_at="2031-03-10T19:00:00Z",
        backlog_flag="yes",
        error_count="0",
    ),
    event(
        source_file_name="small.csv",
        workflow_id="REQ-12",
        status="failed",
        created_at="2031-03-09T22:00:00Z",
        started_at="2031-03-09T22:05:00Z",
        completed_at="2031-03-10T01:30:00Z",
        due_at="2031-03-09T23:00:00Z",
        error_count="0",
    ),
    event(source_file_name="small.csv", workflow_id="REQ-13", priority="asap", due_at="soon"),
]
