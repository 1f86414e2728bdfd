"""The reports as SQL table functions, for users who have nothing but `spark.sql`.

    register_functions(store)
    spark.sql("SELECT * FROM exceptions(team => 'PaymentsOps', start_day => DATE'2025-01-01') ORDER BY error_count")

Every parameter may be left out. A function is one query with optional conditions, so with constant arguments
the conditions that are not asked for fold away, the others reach the scan, and date bounds leave only matching
partitions. Rows come in no order and are not paged: that is for ORDER BY and LIMIT around the call. A look-up
that finds nothing gives no rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from flowledger.plans import reports
from flowledger.plans.reports import MEASURES, Tables

_PREFIX = "flowledger_"  # of the views below the functions
_DAYS = ("start_day", "end_day")


def register_functions(tables: Tables) -> list[str]:
    """Create the functions in the session of the tables; returns their names."""
    mart, facts, backlog = (tables[t] for t in ("kpi_daily_summary", "fact_exception", "fact_backlog_daily"))
    daily = reports.team_performance_daily(tables, keys=_layout(mart))
    open_ = reports.open_exceptions(tables, keys=_layout(facts))
    waiting = reports.backlog_star(tables, keys=_layout(backlog))
    runs = reports.workflow_star(tables)

    team = {"team": "team_name", "kind": "workflow_type"}
    ask = {"priority": "priority_name", "status": "status_name", "workflow": "workflow_id"}
    _rows("kpi_daily", daily, "calendar_date", team)
    _rows("team_performance", daily, "calendar_date", {"team": "team_name"})
    _rows("exceptions", open_, "detected_date", {"team": "team_name", **ask})
    _rows("backlog", waiting, "calendar_date", {"team": "team_name", "priority": "priority_name"})
    _summary(daily, team)
    _latest_run(runs)
    _rows("workflow_exceptions", open_, None, {"workflow": "workflow_id"}, required=True)
    return [
        *("kpi_summary", "kpi_daily", "team_performance", "exceptions", "backlog"),
        *("workflow_exceptions", "workflow_detail"),
    ]


def _layout(table: DataFrame) -> list[str]:
    return [c for c in ("date_key", "month_key") if c in table.columns]


def _view(name: str, df: DataFrame) -> str:
    df.createOrReplaceTempView(_PREFIX + name)
    return _PREFIX + name


def _create(df: DataFrame, name: str, parameters: list[str], columns: dict[str, str], body: str) -> None:
    returned = ", ".join(f"`{c}` {t}" for c, t in columns.items())
    df.sparkSession.sql(
        f"CREATE OR REPLACE TEMPORARY FUNCTION {name}({', '.join(parameters)}) RETURNS TABLE({returned}) RETURN {body}"
    )


def _parameters(day: str | None, equal: dict[str, str], required: bool = False) -> list[str]:
    days = [f"{d} DATE DEFAULT NULL" for d in _DAYS] if day else []
    return days + [f"{p} STRING" + ("" if required else " DEFAULT NULL") for p in equal]


def _conditions(df: DataFrame, day: str | None, equal: dict[str, str]) -> str:
    found = [f"({p} IS NULL OR `{c}` = {p})" for p, c in equal.items()]
    for bound, test in zip(_DAYS if day else (), (">=", "<="), strict=False):
        found.append(f"({bound} IS NULL OR `{day}` {test} {bound})")
        for key, pattern in (("date_key", "yyyyMMdd"), ("month_key", "yyyyMM")):
            if key in df.columns:
                found.append(f"({bound} IS NULL OR {key} {test} CAST(date_format({bound}, '{pattern}') AS INT))")
    return " AND ".join(found)


def _rows(name: str, df: DataFrame, day: str | None, equal: dict[str, str], required: bool = False) -> None:
    columns = {c: t for c, t in df.dtypes if c not in _layout(df)}
    chosen = ", ".join(f"`{c}`" for c in columns)
    body = f"SELECT {chosen} FROM {_view(name, df)} WHERE {_conditions(df, day, equal)}"
    _create(df, name, _parameters(day, equal, required), columns, body)


def _summary(df: DataFrame, equal: dict[str, str]) -> None:
    totals, means = MEASURES[:5], MEASURES[5:]
    chosen = [f"coalesce(sum({c}), 0) AS {c}" for c in totals]
    chosen += [f"coalesce(CAST(sum({c}) AS DOUBLE) / count({c}), 0D) AS {c}" for c in means]
    columns = dict.fromkeys(totals, "bigint") | dict.fromkeys(means, "double")
    where = _conditions(df, "calendar_date", equal)
    body = f"SELECT {', '.join(chosen)} FROM {_view('kpi_summary', df)} WHERE {where}"
    _create(df, "kpi_summary", _parameters("calendar_date", equal), columns, body)


def _latest_run(df: DataFrame) -> None:
    columns = {c: t for c, t in df.dtypes if c != "workflow_run_key"}
    run = ", ".join(f"'{c}', `{c}`" for c in columns)
    latest = f"max_by(named_struct({run}), struct(created_at, workflow_run_key))"
    view = _view("workflow_detail", df)
    body = f"SELECT run.* FROM (SELECT {latest} AS run FROM {view} WHERE workflow_id = workflow) WHERE run IS NOT NULL"
    _create(df, "workflow_detail", ["workflow STRING"], columns, body)
