from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from flowledger.operators.numbering import number_rows
from flowledger.plans import reports


@pytest.fixture(scope="module")
def tables(spark):
    def table(sql):
        return spark.sql(f"SELECT * FROM VALUES {sql}")

    mart = table(
        "(20250101, 1, 1, 10, 1.00BD), (20250101, 2, 1, 20, 2.00BD), (20250102, 1, 2, 30, 4.00BD), "
        "(20250102, NULL, 1, 40, 8.00BD) AS t(date_key, team_key, workflow_type_key, n, m)"
    )
    measures = {c: F.col("n") for c in reports.MEASURES[:5]}
    measures |= {c: F.col("m") for c in reports.MEASURES[5:]}
    facts = spark.range(500).select(
        F.concat(F.lit("W"), F.lpad((F.col("id") % 250).cast("string"), 3, "0")).alias("workflow_id"),
        (20250101 + F.col("id") % 2).cast("int").alias("date_key"),
        F.lit(1).alias("team_key"),
        F.lit(1).alias("workflow_type_key"),
        F.lit(1).alias("priority_key"),
        F.lit("sla_breach").alias("exception_type"),
        F.lit("queued").alias("status_name"),
        F.col("id").cast("int").alias("error_count"),
        (F.col("id") % 5 != 0).alias("open_flag"),
    )
    return {
        "kpi_daily_summary": mart.withColumns(measures).drop("n", "m"),
        "fact_exception": facts,
        "dim_date": table(
            "(20250101, DATE'2025-01-01'), (20250102, DATE'2025-01-02') AS t(date_key, calendar_date)"
        ),
        "dim_team": table("(1, 'alpha'), (2, 'beta') AS t(team_key, team_name)"),
        "dim_workflow_type": table("(1, 'x'), (2, 'y') AS t(workflow_type_key, workflow_type)"),
        "dim_priority": table("(1, 'low') AS t(priority_key, priority_name)"),
    }


def test_page_bounds():
    assert reports.page_bounds(1, 50) == (50, 0)
    assert reports.page_bounds(3, 9999) == (500, 1000)
    assert reports.page_bounds(-1, 0) == (1, 0)


def test_newest_first_and_missing_team_last(tables):
    rows = reports.kpi_daily(tables).rows.collect()
    assert [(str(r.calendar_date), r.team_name) for r in rows] == [
        ("2025-01-02", "alpha"),
        ("2025-01-02", None),
        ("2025-01-01", "alpha"),
        ("2025-01-01", "beta"),
    ]
    assert reports.team_performance(tables, team="beta").meta() == {
        "page": 1,
        "page_size": 50,
        "returned": 1,
        "total": 1,
    }


def test_summary_is_a_plain_mean_of_daily_figures(tables):
    row = reports.kpi_summary(tables).first()
    assert (row.total_workflows, row.avg_age_hours) == (100, 3.75)
    row = reports.kpi_summary(tables, start="2025-01-02", team="alpha").first()
    assert (row.total_workflows, row.avg_age_hours) == (30, 4.0)
    row = reports.kpi_summary(tables, workflow_type="none").first()
    assert tuple(row) == (0, 0, 0, 0, 0, 0.0, 0.0, 0.0, 0.0)


def test_pages_and_cursors_join_up_to_the_whole(tables):
    def keys(page):
        return [(r.detected_date, r.workflow_id, r.error_count) for r in page.rows.collect()]

    whole = keys(reports.exceptions(tables, page_size=500))
    assert len(whole) == 400
    assert whole == sorted(whole, key=lambda r: (-r[0].toordinal(), r[1], r[2]))
    paged = [k for n in (1, 2, 3, 4, 5) for k in keys(reports.exceptions(tables, page=n, page_size=100))]
    assert paged == whole
    walked, last = [], None
    while True:
        page = reports.exceptions(tables, page_size=150, after=last)
        rows = page.rows.collect()
        if not rows:
            break
        walked += [(r.detected_date, r.workflow_id, r.error_count) for r in rows]
        last = rows[-1].asDict()
    assert walked == whole


def test_a_cursor_passes_nulls(tables):
    order = [(r.calendar_date, r.team_name) for r in reports.kpi_daily(tables).rows.collect()]
    walked, last = [], None
    while rows := reports.kpi_daily(tables, page_size=1, after=last).rows.collect():
        walked.append((rows[0].calendar_date, rows[0].team_name))
        last = rows[0].asDict()
    assert walked == order


def test_the_page_size_in_use_is_reported(tables):
    meta = reports.exceptions(tables, page_size=1000).meta()
    assert meta == {"page": 1, "page_size": 500, "returned": 400, "total": 400}


def test_filters_and_not_found(tables):
    assert reports.exceptions(tables, end="2025-01-01", status="queued").total.first()[0] == 200
    assert reports.exceptions(tables, priority="high").total.first()[0] == 0
    assert reports.workflow_exceptions(tables, "W001").count() == 2
    with pytest.raises(reports.NotFound, match="W999"):
        reports.workflow_exceptions(tables, "W999")


def test_views(spark, tables):
    reports.register_views(tables)
    assert spark.sql("SELECT count(*) FROM v_open_exceptions").first()[0] == 400
    assert spark.sql("SELECT sum(total_workflows) FROM v_team_performance_daily").first()[0] == 100


def test_numbers_are_consecutive_in_sort_order(spark):
    df = spark.range(0, 5000, 1, 13).select((F.col("id") * 7919 % 5000).alias("v"))
    rows = number_rows(df.orderBy("v"), "n", 10).collect()
    assert sorted(r.n for r in rows) == list(range(11, 5011))
    assert all(r.n == r.v + 11 for r in rows)
