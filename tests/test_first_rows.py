from __future__ import annotations

import sys
from pathlib import Path

from pyspark.sql import functions as F

from flowledger.operators.keyed import (
    EVENT_NUMBER,
    first_per_key,
    firsts_of_repeated,
    input_order,
    only_firsts,
    only_new,
    pick_numbered,
    pick_one,
)
from flowledger.operators.numbering import stage
from flowledger.plans import reports

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

import __spark_entry__ as registered  # noqa: E402

KEYS = ("source_file_name", "source_row_number")


def rows_of(spark, cells):
    ddl = f"source_file_name string, source_row_number bigint, v string, {EVENT_NUMBER} bigint"
    return stage(spark.createDataFrame([(*c, i + 1) for i, c in enumerate(cells)], ddl))


def numbers(df):
    return sorted(r[0] for r in df.select(EVENT_NUMBER).collect())


def test_the_same_rows_are_kept_as_by_a_window(spark):
    unique = [("a", i, "x") for i in range(100)]
    for extra in ([], [("a", 3, "y"), ("a", 3, "z"), (None, 5, "p"), (None, 5, "q")], [("a", i, "y") for i in range(90)]):
        rows = rows_of(spark, unique + extra)
        wanted = numbers(first_per_key(rows, KEYS))
        assert numbers(only_firsts(rows, firsts_of_repeated(rows, KEYS))) == wanted
        assert numbers(pick_numbered(rows, KEYS, input_order(rows))) == wanted
        newest = [F.col("v").desc(), *input_order(rows)]
        assert numbers(pick_numbered(rows, KEYS, newest)) == numbers(pick_one(rows, KEYS, newest))
    assert firsts_of_repeated(rows_of(spark, unique), KEYS) is None


def test_whole_rows_are_not_shuffled_for_few_repeats(spark):
    rows = rows_of(spark, [("a", i, "x") for i in range(100)] + [("a", 3, "y")])
    kept = only_firsts(rows, firsts_of_repeated(rows, KEYS))
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning" not in plan
    assert "Window" not in plan


def test_new_rows_are_those_without_a_stored_key(spark):
    batch = rows_of(spark, [("a", 1, "x"), ("a", 2, "x"), ("a", 2, "y"), ("b", 1, "x")])
    stored = spark.createDataFrame([("a", 1), ("b", 2)], "source_file_name string, source_row_number bigint")
    found = only_new(batch, stored, KEYS)
    assert found.columns == batch.columns
    wanted = first_per_key(batch, KEYS).join(stored, list(KEYS), "left_anti")
    assert numbers(found) == numbers(wanted)


def test_a_workflow_without_open_exceptions_gives_no_rows(spark, monkeypatch):
    empty = spark.range(0).select(F.lit("").alias("workflow_id"))

    def nothing(tables, workflow_id):
        raise reports.NotFound(workflow_id)

    monkeypatch.setattr(reports, "workflow_exceptions", nothing)
    monkeypatch.setattr(reports, "open_exceptions", lambda tables: empty)
    assert registered._workflow_exceptions("W999", {}).count() == 0
