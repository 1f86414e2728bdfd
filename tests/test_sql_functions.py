from __future__ import annotations

import pytest
from helpers import AS_OF, SMALL_FILE, event, write_csv

from flowledger.plans import reports
from flowledger.plans.pipeline import run_pipeline
from flowledger.plans.sql_functions import register_functions
from flowledger.store import Warehouse
from flowledger.tables import FACT_EXCEPTION


@pytest.fixture(scope="module", params=["date_key", "month_key"])
def store(request, spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("sql")
    store = Warehouse(spark, str(folder / "warehouse"), facts_by=request.param).create()
    late = dict(status="queued", started_at="", completed_at="", due_at="2031-02-28T06:00:00Z", backlog_flag="yes")
    more = [
        event(source_file_name="small.csv", workflow_id=f"REQ-{20 + i}", created_at=f"2031-02-{10 + i}T06:00:00Z", **late)
        for i in range(9)
    ]
    run_pipeline(store, write_csv(folder / "a.csv", [*SMALL_FILE, *more]), as_of=AS_OF)
    assert register_functions(store)
    assert store["fact_exception"].where("open_flag").count() >= 9
    return store


def rows(df):
    return sorted(map(str, df.collect()))


DAYS = {"start": "2031-02-12", "end": "2031-03-10"}


@pytest.mark.parametrize(
    "call, report",
    [
        ("kpi_summary()", reports.kpi_summary),
        ("kpi_summary(team => 'none')", lambda t: reports.kpi_summary(t, team="none")),
        ("kpi_summary(kind => 'KycRefresh')", lambda t: reports.kpi_summary(t, workflow_type="KycRefresh")),
        ("kpi_daily()", reports.team_performance_daily),
        ("kpi_daily(DATE'2031-02-12', DATE'2031-03-10')", lambda t: reports.kpi_daily(t, **DAYS).rows),
        ("team_performance(team => 'FieldOps')", lambda t: reports.team_performance(t, team="FieldOps").rows),
        ("exceptions()", reports.open_exceptions),
        (
            "exceptions(DATE'2031-02-12', team => 'RiskOps', status => 'queued', priority => 'medium')",
            lambda t: reports.exceptions(t, "2031-02-12", team="RiskOps", status="queued", priority="medium").rows,
        ),
        ("exceptions(workflow => 'REQ-21')", lambda t: reports.exceptions(t, workflow_id="REQ-21").rows),
        ("workflow_exceptions('REQ-22')", lambda t: reports.workflow_exceptions(t, "REQ-22")),
        ("backlog(end_day => DATE'2031-02-15')", lambda t: reports.backlog(t, end="2031-02-15").rows),
        ("workflow_detail('REQ-11')", lambda t: reports.workflow_detail(t, "REQ-11")),
    ],
)
def test_functions_give_what_the_reports_give(spark, store, call, report):
    got, want = spark.sql(f"SELECT * FROM {call}"), report(store)
    assert got.columns == want.columns
    assert rows(got) == rows(want)


def test_look_ups_that_find_nothing_give_no_rows(spark, store):
    for name in ("workflow_detail", "workflow_exceptions"):
        assert spark.sql(f"SELECT * FROM {name}('REQ-99')").collect() == []


def test_conditions_fold_and_reach_the_scan(spark, store):
    plan = spark.sql("SELECT * FROM exceptions(DATE'2031-03-01', team => 'RiskOps')")._jdf.queryExecution().toString()
    physical = plan[plan.index("== Physical Plan ==") :]
    assert f"PartitionFilters: [isnotnull({store.layout(FACT_EXCEPTION)}" in physical
    assert "status_name" not in physical.partition("PushedFilters")[2].partition("]")[0]  # not asked for
