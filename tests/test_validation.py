from __future__ import annotations

import datetime as dt
import json

import pytest
from helpers import event, events

from flowledger.operators.validation import (
    missing_columns,
    normalise_source,
    quarantine_records,
    require_columns,
    validate,
)


def test_missing_columns_are_named_in_order(spark):
    df = events(spark, event()).drop("workflow_id", "payload")
    assert missing_columns(df) == ["payload", "workflow_id"]
    with pytest.raises(ValueError, match="Missing required columns: payload, workflow_id"):
        require_columns(df)


# What breaks each rule alone, in the order in which a row lists what it breaks.
BREAKS = {
    "invalid_created_at": {"created_at": "tomorrow"},
    "invalid_started_at": {"started_at": "half past six"},
    "invalid_completed_at": {"completed_at": "2031-02-30"},
    "invalid_due_at": {"due_at": "2031"},
    "empty_workflow_id": {"workflow_id": " \t"},
    "invalid_status": {"status": "parked"},
    "invalid_priority": {"priority": ""},
    "completed_before_created": {"completed_at": "2031-03-10T05:59:59Z", "started_at": ""},
    "due_before_created": {"due_at": "2031-03-10T05:59:59.5Z"},
}


def test_every_rule_alone_and_several_together(spark):
    codes = list(BREAKS)
    together = [codes[1:3] + codes[4:7], codes[:1] + codes[3:6], codes[4:]]
    broken = [[code] for code in codes] + together
    rows = [{k: v for code in row for k, v in BREAKS[code].items()} for row in broken]
    checked = validate(events(spark, *[event(**changes) for changes in rows], event(), event())).staged()
    found = {r.source_row_number: r.validation_errors for r in checked.invalid.collect()}
    assert found == {i: row for i, row in enumerate(broken, 1)}
    assert [r.validation_errors for r in checked.valid.collect()] == [[], []]
    summary = checked.summary.first().asDict()
    assert summary == {
        "input_rows": len(rows) + 2,
        "valid_rows": 2,
        "invalid_rows": len(rows),
        "quarantined_rows": len(rows),
    }


def test_text_and_flags(spark):
    row = normalise_source(
        events(
            spark,
            event(
                workflow_id="\t REQ-9 \n",
                team_name=None,
                assignee_id=" \r\n",
                exception_type=" ",
                backlog_flag=" YES ",
                exception_flag="2",
                queue_name="a b",
            ),
        )
    ).first()
    assert (row.workflow_id, row.team_name, row.assignee_id) == ("REQ-9", "", None)
    assert (row.exception_type, row.backlog_flag, row.exception_flag) == (None, True, False)
    assert row.queue_name == "a b"


def in_order(df):
    return df.orderBy("workflow_id").collect()


def one_per(cases):
    return [event(workflow_id=f"REQ-{i:03d}", **cells) for i, cells in enumerate(cases)]


def test_integers_truncate_or_default(spark):
    expected = {
        "12": 12, " 1.9 ": 1, "-1.9": -1, "1e3": 1000, "abc": 0, "": 0, None: 0, "nan": 0, "1e20": 0, "1d": 0,
        "3000000000": 0,
    }
    cases = [{"records_touched": text, "source_row_number": text} for text in expected]
    rows = in_order(normalise_source(events(spark, *one_per(cases))))
    assert [r.records_touched for r in rows] == list(expected.values())
    numbers = [n if n else -1 for n in expected.values()]
    assert [r.source_row_number for r in rows] == [*numbers[:-1], 3_000_000_000]


def test_timestamps_parse_one_by_one(spark):
    expected = {
        "2031-03-10T08:00:00Z": dt.datetime(2031, 3, 10, 8),
        "2031-03-10T08:00:00+00:00": dt.datetime(2031, 3, 10, 8),
        "2031-03-10T08:00:00.5-02:30": dt.datetime(2031, 3, 10, 10, 30, 0, 500000),
        "2031-03-10 08:00": dt.datetime(2031, 3, 10, 8),
        " 2031-03-10 ": dt.datetime(2031, 3, 10),
    }
    df = normalise_source(events(spark, *one_per({"started_at": t} for t in expected)))
    rows = in_order(df.selectExpr("workflow_id", "cast(started_at as timestamp_ntz) t"))
    assert [r.t for r in rows] == list(expected.values())


def test_bad_timestamps_are_errors_and_blank_ones_are_not(spark):
    bad = ["half past six", "2031", "T08:00:00", "2031-02-30", "2031-03-10T25:00:00Z", "9999-12-31"]
    blank = ["", "  ", None]
    df = validate(events(spark, *one_per({"started_at": t} for t in [*bad, *blank]))).rows
    rows = in_order(df)
    assert [r.started_at for r in rows] == [None] * 9
    assert [r.validation_errors for r in rows] == [["invalid_started_at"]] * 6 + [[]] * 3


def test_blank_created_at_passes_validation(spark):
    row = validate(events(spark, event(created_at=""))).rows.first()
    assert (row.created_at, row.validation_status) == (None, "valid")


def test_blank_team_and_type_pass(spark):
    row = validate(events(spark, event(team_name=" ", workflow_type=""))).rows.first()
    assert (row.validation_status, row.team_name, row.workflow_type) == ("valid", "", "")


def test_quarantine_payload_holds_normalised_row_and_extras(spark):
    source = events(spark, event(started_at="soon", status=" Queued ", region="north"))
    payload = json.loads(quarantine_records(validate(source).invalid).first().raw_payload)
    assert payload["status"] == "queued"
    assert payload["region"] == "north"
    assert payload["started_at"] is None
    assert payload["created_at"] == "2031-03-10T06:00:00.000Z"
    assert payload["validation_status"] == "quarantined"
    assert "validation_errors" not in payload
