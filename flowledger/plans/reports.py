"""The read queries, as DataFrames over the stored star schema."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from datetime import date

from pyspark.sql import Column, DataFrame, functions as F

from flowledger.constants import DEFAULT_PAGE_SIZE, MAX_PAGE_SIZE
from flowledger.operators.keyed import pick_one
from flowledger.operators.numbering import stage

Tables = Mapping[str, DataFrame]
Day = date | str | None

MEASURES = (
    "total_workflows",
    "completed_workflows",
    "backlog_workflows",
    "exception_workflows",
    "sla_breach_count",
    "avg_processing_minutes",
    "avg_age_hours",
    "throughput_per_assignee",
    "data_quality_score",
)


class NotFound(LookupError):
    pass


# --- paging -----------------------------------------------------------------------------------


def page_bounds(page: int, page_size: int) -> tuple[int, int]:
    """(limit, offset): 1 to 500 rows per page, pages from 1."""
    limit = min(max(page_size, 1), MAX_PAGE_SIZE)
    return limit, (max(page, 1) - 1) * limit


@dataclass(frozen=True)
class Page:
    rows: DataFrame
    total: DataFrame  # one row, one column: total
    page: int
    page_size: int  # as used

    def meta(self) -> dict[str, int]:
        return {
            "page": self.page,
            "page_size": self.page_size,
            "returned": self.rows.count(),
            "total": self.total.first()[0],
        }


@dataclass(frozen=True)
class SortKey:
    """One column of a total order. Nulls come last, in a descending order first."""

    name: str
    descending: bool = False

    def column(self) -> Column:
        key = F.col(self.name)
        return key.desc_nulls_first() if self.descending else key.asc_nulls_last()

    def equal(self, value) -> Column:
        return F.col(self.name).eqNullSafe(F.lit(value))

    def behind(self, value) -> Column:
        """Whether a row sorts behind the value."""
        key = F.col(self.name)
        if self.descending:
            return key.isNotNull() if value is None else key < F.lit(value)
        return F.lit(False) if value is None else key.isNull() | (key > F.lit(value))


def _behind(order: Sequence[SortKey], last: Mapping) -> Column:
    """Whether a row sorts behind the given one: behind it in one key, equal in all keys before."""
    found, equal = F.lit(False), F.lit(True)
    for key in order:
        value = last[key.name]
        found, equal = found | (equal & key.behind(value)), equal & key.equal(value)
    return F.coalesce(found, F.lit(False))


def paginate(
    df: DataFrame,
    order: Sequence[SortKey],
    page: int = 1,
    page_size: int = DEFAULT_PAGE_SIZE,
    after: Mapping | None = None,
) -> Page:
    """One page in a total order, and the row count over the same filtered rows.

    A page is a top-k over all rows up to its end. To go on at any depth for the price of one page, pass
    the last row of the page before as `after` and leave `page` at 1.
    """
    limit, offset = page_bounds(page, page_size)
    rows = df if after is None else df.where(_behind(order, after))
    rows = rows.orderBy(*[key.column() for key in order]).offset(offset).limit(limit)
    return Page(rows, df.agg(F.count("*").alias("total")), max(page, 1), limit)


# --- filters -------------------------------------------------------------------------------------


def _equal(df: DataFrame, **wanted: str | None) -> DataFrame:
    """Add a condition for each argument that is given."""
    for column, value in wanted.items():
        if value is not None:
            df = df.where(F.col(column) == value)
    return df


def _between_days(df: DataFrame, column: str, start: Day, end: Day) -> DataFrame:
    if start is not None:
        df = df.where(F.col(column) >= F.lit(start).cast("date"))
    if end is not None:
        df = df.where(F.col(column) <= F.lit(end).cast("date"))
    return df


def _as_key(day: Day) -> int:
    return int(str(day).replace("-", "")[:8])


def _slices(df: DataFrame, start: Day, end: Day) -> DataFrame:
    """The same bounds on the layout column, so that only partitions in range are listed and read."""
    by_month = "month_key" in df.columns
    for bound, after in ((start, True), (end, False)):
        if bound is None:
            continue
        key = _as_key(bound)
        columns = [("date_key", key)] + ([("month_key", key // 100)] if by_month else [])
        for column, value in columns:
            df = df.where(F.col(column) >= value if after else F.col(column) <= value)
    return df


# --- stars ------------------------------------------------------------------------------------------


def team_performance_daily(
    tables: Tables, start: Day = None, end: Day = None, keys: Sequence[str] = ()
) -> DataFrame:
    """The daily KPI mart with names; team and type may be missing. `keys` are stored columns to keep."""
    mart = _slices(tables["kpi_daily_summary"], start, end)
    joined = (
        mart.join(tables["dim_date"], "date_key")
        .join(tables["dim_team"], "team_key", "left")
        .join(tables["dim_workflow_type"], "workflow_type_key", "left")
    )
    named = joined.select("calendar_date", "team_name", "workflow_type", *MEASURES, *keys)
    return _between_days(named, "calendar_date", start, end)


def open_exceptions(
    tables: Tables, start: Day = None, end: Day = None, keys: Sequence[str] = ()
) -> DataFrame:
    facts = _slices(tables["fact_exception"].where("open_flag"), start, end)
    named = (
        facts.join(tables["dim_date"], "date_key")
        .join(tables["dim_team"], "team_key")
        .join(tables["dim_workflow_type"], "workflow_type_key")
        .join(tables["dim_priority"], "priority_key")
        .select(
            "workflow_id",
            F.col("calendar_date").alias("detected_date"),
            "team_name",
            "workflow_type",
            "priority_name",
            "exception_type",
            "status_name",
            "error_count",
            "open_flag",
            *keys,
        )
    )
    return _between_days(named, "detected_date", start, end)


def backlog_star(
    tables: Tables, start: Day = None, end: Day = None, keys: Sequence[str] = ()
) -> DataFrame:
    facts = _slices(tables["fact_backlog_daily"], start, end)
    named = (
        facts.join(tables["dim_date"], "date_key")
        .join(tables["dim_team"], "team_key")
        .join(tables["dim_workflow_type"], "workflow_type_key")
        .join(tables["dim_priority"], "priority_key")
        .select(
            "calendar_date",
            "team_name",
            "workflow_type",
            "priority_name",
            "open_workflow_count",
            "overdue_workflow_count",
            "avg_age_hours",
            *keys,
        )
    )
    return _between_days(named, "calendar_date", start, end)


_DETAIL = (
    "workflow_id",
    "calendar_date",
    "team_name",
    "workflow_type",
    "priority_name",
    "status_name",
    "queue_name",
    "source_system",
    "created_at",
    "started_at",
    "completed_at",
    "due_at",
    "processing_minutes",
    "age_hours",
    "records_touched",
    "error_count",
    "backlog_flag",
    "exception_flag",
    "sla_breached",
)


def workflow_star(tables: Tables, workflow_id: str | None = None) -> DataFrame:
    """Workflow runs with names, and the run key for ties."""
    return (
        _equal(tables["fact_workflow_run"], workflow_id=workflow_id)
        .join(tables["dim_date"], "date_key")
        .join(tables["dim_team"], "team_key")
        .join(tables["dim_workflow_type"], "workflow_type_key")
        .join(tables["dim_priority"], "priority_key")
        .join(tables["dim_status"], "status_key")
        .select(*_DETAIL, "workflow_run_key")
    )


# --- queries ------------------------------------------------------------------------------------------


def kpi_summary(
    tables: Tables,
    start: Day = None,
    end: Day = None,
    team: str | None = None,
    workflow_type: str | None = None,
) -> DataFrame:
    """One row, also over no data. Means are plain means of the mart's daily figures."""
    rows = _equal(
        team_performance_daily(tables, start, end), team_name=team, workflow_type=workflow_type
    )
    totals, means = MEASURES[:5], MEASURES[5:]
    return rows.agg(
        *[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in totals],
        *[
            F.coalesce(F.sum(c).cast("double") / F.count(c), F.lit(0.0)).alias(c)
            for c in means
        ],
    )


# Newest day first; a missing team or type sorts last.
_DAILY_ORDER = (SortKey("calendar_date", True), SortKey("team_name"), SortKey("workflow_type"))


def kpi_daily(
    tables: Tables,
    start: Day = None,
    end: Day = None,
    team: str | None = None,
    workflow_type: str | None = None,
    page: int = 1,
    page_size: int = DEFAULT_PAGE_SIZE,
    after: Mapping | None = None,
) -> Page:
    rows = _equal(
        team_performance_daily(tables, start, end), team_name=team, workflow_type=workflow_type
    )
    return paginate(rows, _DAILY_ORDER, page, page_size, after)


def team_performance(
    tables: Tables,
    start: Day = None,
    end: Day = None,
    team: str | None = None,
    page: int = 1,
    page_size: int = DEFAULT_PAGE_SIZE,
    after: Mapping | None = None,
) -> Page:
    return kpi_daily(tables, start, end, team, None, page, page_size, after)


_EXCEPTION_ORDER = (
    SortKey("detected_date", True),
    SortKey("workflow_id"),
    *map(
        SortKey,
        ("team_name", "workflow_type", "priority_name", "exception_type", "status_name", "error_count"),
    ),
    SortKey("open_flag"),
)


def exceptions(
    tables: Tables,
    start: Day = None,
    end: Day = None,
    team: str | None = None,
    priority: str | None = None,
    status: str | None = None,
    workflow_id: str | None = None,
    page: int = 1,
    page_size: int = DEFAULT_PAGE_SIZE,
    after: Mapping | None = None,
) -> Page:
    rows = _equal(
        open_exceptions(tables, start, end),
        team_name=team,
        priority_name=priority,
        status_name=status,
        workflow_id=workflow_id,
    )
    return paginate(rows, _EXCEPTION_ORDER, page, page_size, after)


def workflow_exceptions(tables: Tables, workflow_id: str) -> DataFrame:
    """All open exceptions of one workflow; raises NotFound if it has none."""
    rows = _equal(open_exceptions(tables), workflow_id=workflow_id)
    found = stage(rows)  # looked up once, for the test and for the answer
    if found.isEmpty():
        raise NotFound(f"{workflow_id} has no open exceptions")
    return found.orderBy(*[key.column() for key in _EXCEPTION_ORDER])


def backlog(
    tables: Tables,
    start: Day = None,
    end: Day = None,
    team: str | None = None,
    priority: str | None = None,
    page: int = 1,
    page_size: int = DEFAULT_PAGE_SIZE,
    after: Mapping | None = None,
) -> Page:
    rows = _equal(backlog_star(tables, start, end), team_name=team, priority_name=priority)
    return paginate(rows, [*_DAILY_ORDER, SortKey("priority_name")], page, page_size, after)


def workflow_detail(tables: Tables, workflow_id: str) -> DataFrame:
    """The latest known run of a workflow; raises NotFound if there is none."""
    newest = [F.col("created_at").desc(), F.col("workflow_run_key").desc()]
    latest = workflow_star(tables, workflow_id).orderBy(*newest).limit(1).drop("workflow_run_key")
    found = latest.collect()  # one row, fetched once
    if not found:
        raise NotFound(f"{workflow_id} has no run")
    return latest.sparkSession.createDataFrame(found, latest.schema)


def latest_runs(tables: Tables) -> DataFrame:
    """`workflow_detail` for every workflow at once."""
    order = [F.col("created_at").desc(), F.col("workflow_run_key").desc()]
    return pick_one(workflow_star(tables), ["workflow_id"], order).drop("workflow_run_key")


def dashboard(
    tables: Tables,
    start: Day = None,
    end: Day = None,
    team: str | None = None,
    workflow_type: str | None = None,
) -> dict[str, DataFrame]:
    """Summary, the ten newest daily rows and the ten newest open exceptions."""
    return {
        "summary": kpi_summary(tables, start, end, team, workflow_type),
        "daily": kpi_daily(tables, start, end, team, workflow_type, page_size=10).rows,
        "exceptions": exceptions(tables, start, end, team, page_size=10).rows,
    }


def register_views(tables: Tables) -> None:
    """The two reporting views, for use from SQL."""
    team_performance_daily(tables).createOrReplaceTempView("v_team_performance_daily")
    open_exceptions(tables).createOrReplaceTempView("v_open_exceptions")
