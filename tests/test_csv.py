from __future__ import annotations

import csv

import duckdb
import pytest
from helpers import event, write_csv

from flowledger.constants import SOURCE_COLUMNS
from flowledger.operators import numbering
from flowledger.operators.validation import validate
from flowledger.sources import csv_records
from flowledger.sources.workflow_csv import read_workflow_csv


def test_missing_file(spark, tmp_path):
    with pytest.raises(FileNotFoundError, match="nothing.csv"):
        read_workflow_csv(spark, str(tmp_path / "nothing.csv"))


def test_columns_by_name_quotes_and_missing_tokens(spark, tmp_path):
    columns = [*reversed(SOURCE_COLUMNS)]
    path = write_csv(
        tmp_path / "a.csv",
        [event(team_name="NA", payload='{"note": "a, b"}'), event(team_name="nan ", assignee_id="None")],
        columns,
    )
    first, second = read_workflow_csv(spark, path).orderBy("assignee_id").collect()[::-1]
    assert first.team_name is None
    assert first.payload == '{"note": "a, b"}'
    assert second.team_name == "nan "
    assert second.assignee_id is None


def test_row_numbers_are_exact_over_many_splits(spark, tmp_path):
    columns = [c for c in SOURCE_COLUMNS if c not in ("source_file_name", "source_row_number")]
    sizes = {"one.csv": 3000, "two.csv": 1717, "three.csv": 1}
    for name, rows in sizes.items():
        write_csv(
            tmp_path / name, [event(workflow_id=f"{name}:{i + 1}") for i in range(rows)], columns
        )
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "64KB")
    try:
        df = read_workflow_csv(spark, str(tmp_path / "*.csv"))
        got = df.select("source_file_name", "source_row_number", "workflow_id").collect()
        splits = df.select("_input_position.file", "_input_position.block").distinct().count()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert splits > 10
    assert len(got) == sum(sizes.values())
    assert all(r.workflow_id == f"{r.source_file_name}:{r.source_row_number}" for r in got)


def test_files_with_different_columns_are_refused(spark, tmp_path):
    write_csv(tmp_path / "a.csv", [event()])
    write_csv(tmp_path / "b.csv", [event()], [*SOURCE_COLUMNS[1:], SOURCE_COLUMNS[0]])
    with pytest.raises(Exception, match="header"):
        read_workflow_csv(spark, str(tmp_path / "*.csv")).collect()


@pytest.mark.parametrize("ending", ["\n", "\r\n"])
@pytest.mark.parametrize("split", ["128MB", "300", "2KB"])
def test_line_breaks_in_cells_over_many_splits(spark, tmp_path, split, ending):
    columns = [c for c in SOURCE_COLUMNS if c not in ("source_file_name", "source_row_number")]
    notes = ["two\nlines", "\n", 'a "quoted", word\n\n"', "x\n" * 200, "plain", '5" pipe', "\n,\n,", '"']
    want = {}
    for name, n in {"one.csv": 90, "two.csv": 41, "plain.csv": 30}.items():
        cells = ["plain" if name == "plain.csv" else notes[i % len(notes)] for i in range(n)]
        with open(tmp_path / name, "w", newline="") as out:
            writer = csv.DictWriter(out, columns, lineterminator=ending)
            writer.writeheader()
            for i, cell in enumerate(cells):
                row = event(workflow_id=f"w{i}", queue_name=cell)
                writer.writerow({c: row[c] for c in columns})
                if i % 10 == 0:
                    out.write(ending)  # a blank line is no row
        if ending == "\n":  # the other reader takes one kind of line end in a file
            sql = "SELECT queue_name FROM read_csv(?, header=true, all_varchar=true, quote='\"', escape='\"', parallel=false)"
            assert [r[0] for r in duckdb.execute(sql, [str(tmp_path / name)]).fetchall()] == cells
        want |= {(name, str(i + 1)): (f"w{i}", cell) for i, cell in enumerate(cells)}
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", split)
    try:
        rows = read_workflow_csv(spark, str(tmp_path / "*.csv")).collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert len(rows) == len(want)
    got = {(r.source_file_name, r.source_row_number): (r.workflow_id, r.queue_name) for r in rows}
    assert got == want


def test_broken_files_with_line_breaks_are_refused(spark, tmp_path):
    path = write_csv(tmp_path / "a.csv", [event(queue_name="two\nlines"), event()])
    assert read_workflow_csv(spark, path).count() == 2
    (tmp_path / "inch").mkdir()
    (tmp_path / "inch" / "e.csv").write_text('workflow_id,queue_name\nw1,5" pipe\nw2,"a\nb"\n')
    rows = read_workflow_csv(spark, str(tmp_path / "inch" / "e.csv")).collect()
    assert {(r.workflow_id, r.queue_name) for r in rows} == {("w1", '5" pipe'), ("w2", "a\nb")}
    write_csv(tmp_path / "b.csv", [event()], [*SOURCE_COLUMNS[1:], SOURCE_COLUMNS[0]])
    with pytest.raises(Exception, match="header"):
        read_workflow_csv(spark, str(tmp_path / "*.csv")).collect()
    write_csv(tmp_path / "c.csv", [event()], [*SOURCE_COLUMNS, "one_more"])
    with pytest.raises(Exception, match="header"):
        read_workflow_csv(spark, str(tmp_path / "[ac].csv")).collect()
    (tmp_path / "open").mkdir()
    (tmp_path / "open" / "d.csv").write_text('workflow_id,queue_name\nw1,"never closed\nw2,x\n')
    with pytest.raises(ValueError, match="ends inside a quoted cell"):
        read_workflow_csv(spark, str(tmp_path / "open" / "d.csv"))


def test_bookkeeping_columns_stay_out_of_typed_columns(spark, tmp_path):
    path = write_csv(tmp_path / "a.csv", [event()])
    row = validate(read_workflow_csv(spark, path)).rows.first()
    assert row.validation_status == "valid"
    assert row.records_touched == 7


def test_lines_are_dealt_once(spark, tmp_path, monkeypatch):
    path = write_csv(tmp_path / "a.csv", [event(queue_name="one\n\ntwo\n,three") for _ in range(50)])
    staged = []

    def stage(df):
        found = numbering.stage(df)
        staged.append((df._jdf.queryExecution().executedPlan().toString(), found))
        return found

    monkeypatch.setattr(csv_records, "stage", stage)
    lines = numbering.stage(csv_records.read_lines(spark, path))
    assert lines.count() == 201
    assert csv_records.records(lines).count() == 51
    plan, pieces = next((plan, df) for plan, df in staged if {"text", "line"} & set(df.columns))
    assert pieces.count() == 51  # not one row per line, to be dealt again by record
    assert plan.count("Exchange hashpartitioning") == 1
