"""The relations of the warehouse: columns, types, defaults and constraints."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession, functions as F


@dataclass(frozen=True, eq=False)
class Table:
    layer: str
    name: str
    # column -> type, with a trailing "!" for NOT NULL
    columns: dict[str, str]
    surrogate: str | None = None
    unique: tuple[tuple[str, ...], ...] = ()
    # column -> (table, column)
    references: dict[str, tuple[str, str]] = field(default_factory=dict)
    # values taken where a load leaves the column out or null
    defaults: dict[str, object] = field(default_factory=dict)
    stamped: str | None = None  # load time column
    partition: str | None = None  # layout column, derived from `partition_source`
    sort_by: str | None = None
    append_only: bool = False

    @property
    def path(self) -> str:
        return f"{self.layer}/{self.name}"

    @property
    def versioned(self) -> bool:
        """Whether loads replace partitions of it, as against appending rows or writing snapshots."""
        return self.partition is not None and not self.append_only

    def type_of(self, column: str) -> str:
        return self.columns[column].rstrip("!")

    @property
    def required(self) -> list[str]:
        return [c for c, t in self.columns.items() if t.endswith("!")]

    def empty(self, spark: SparkSession) -> DataFrame:
        return spark.range(0).select(
            *[F.lit(None).cast(self.type_of(c)).alias(c) for c in self.columns]
        )

    def conform(self, df: DataFrame) -> DataFrame:
        """Project to the stored columns and types, with defaults and the load time filled in."""
        return df.select(*[self._stored(df, c).alias(c) for c in self.columns])

    def _stored(self, df: DataFrame, column: str) -> Column:
        dtype = self.type_of(column)
        value = F.col(column) if column in df.columns else F.lit(None)
        if column == self.stamped:
            return F.current_timestamp()
        if column not in df.columns or df.schema[column].dataType.simpleString() != dtype:
            value = value.cast(dtype)
        if column in self.defaults:
            default = self.defaults[column]
            literal = F.array() if default == [] else F.lit(default)
            value = F.coalesce(value, literal.cast(dtype))
        return value


_MONEY = "decimal(12,2)"
_SOURCE_BODY = {
    "workflow_id": "string!",
    "workflow_type": "string!",
    "team_name": "string!",
    "assignee_id": "string",
    "priority": "string!",
    "status": "string!",
    "queue_name": "string!",
    "created_at": "timestamp!",
    "started_at": "timestamp",
    "completed_at": "timestamp",
    "due_at": "timestamp",
}
_FLAG_DEFAULTS = {"backlog_flag": False, "exception_flag": False}
_COUNT_DEFAULTS = {"records_touched": 0, "error_count": 0}

RAW = Table(
    "raw",
    "workflow_events_raw",
    {
        "raw_event_id": "bigint!",
        "source_file_name": "string!",
        "source_row_number": "bigint!",
        **_SOURCE_BODY,
        "backlog_flag": "boolean!",
        "exception_flag": "boolean!",
        "exception_type": "string",
        "source_system": "string!",
        "records_touched": "int!",
        "error_count": "int!",
        "payload": "string!",
        "ingested_at": "timestamp!",
    },
    surrogate="raw_event_id",
    unique=(("raw_event_id",), ("source_file_name", "source_row_number")),
    defaults={**_FLAG_DEFAULTS, **_COUNT_DEFAULTS},
    stamped="ingested_at",
    partition="key_bucket",
    sort_by="source_row_number",
    append_only=True,
)

QUARANTINE = Table(
    "staging",
    "workflow_events_quarantine",
    {
        "quarantine_id": "bigint!",
        "source_file_name": "string!",
        "source_row_number": "bigint",
        "workflow_id": "string",
        "validation_errors": "array<string>!",
        "raw_payload": "string!",
        "quarantined_at": "timestamp!",
    },
    surrogate="quarantine_id",
    unique=(("quarantine_id",), ("source_file_name", "source_row_number")),
    defaults={"validation_errors": []},
    stamped="quarantined_at",
    partition="key_bucket",
    sort_by="workflow_id",
)

STAGING = Table(
    "staging",
    "workflow_events_clean",
    {
        "staging_event_id": "bigint!",
        "raw_event_id": "bigint!",
        **_SOURCE_BODY,
        "processing_minutes": _MONEY,
        "age_hours": _MONEY,
        "sla_breached": "boolean!",
        "backlog_flag": "boolean!",
        "exception_flag": "boolean!",
        "exception_type": "string",
        "records_touched": "int!",
        "error_count": "int!",
        "validation_status": "string!",
        "validation_errors": "array<string>!",
        "loaded_at": "timestamp!",
    },
    surrogate="staging_event_id",
    unique=(("staging_event_id",), ("raw_event_id",)),
    references={"raw_event_id": ("workflow_events_raw", "raw_event_id")},
    defaults={
        "sla_breached": False,
        **_FLAG_DEFAULTS,
        **_COUNT_DEFAULTS,
        "validation_errors": [],
    },
    stamped="loaded_at",
    partition="id_range",
    sort_by="workflow_id",
)

DIM_TEAM = Table(
    "warehouse",
    "dim_team",
    {
        "team_key": "int!",
        "team_name": "string!",
        "department_name": "string!",
        "manager_name": "string!",
        "active_flag": "boolean!",
    },
    surrogate="team_key",
    unique=(("team_key",), ("team_name",)),
    defaults={"active_flag": True},
)

DIM_WORKFLOW_TYPE = Table(
    "warehouse",
    "dim_workflow_type",
    {
        "workflow_type_key": "int!",
        "workflow_type": "string!",
        "workflow_domain": "string!",
        "default_sla_hours": "int!",
    },
    surrogate="workflow_type_key",
    unique=(("workflow_type_key",), ("workflow_type",)),
)

DIM_PRIORITY = Table(
    "warehouse",
    "dim_priority",
    {"priority_key": "int!", "priority_name": "string!", "priority_rank": "int!"},
    surrogate="priority_key",
    unique=(("priority_key",), ("priority_name",), ("priority_rank",)),
)

DIM_STATUS = Table(
    "warehouse",
    "dim_status",
    {"status_key": "int!", "status_name": "string!", "terminal_flag": "boolean!"},
    surrogate="status_key",
    unique=(("status_key",), ("status_name",)),
    defaults={"terminal_flag": False},
)

DIM_DATE = Table(
    "warehouse",
    "dim_date",
    {
        "date_key": "int!",
        "calendar_date": "date!",
        "day_of_week": "smallint!",
        "day_name": "string!",
        "week_of_year": "smallint!",
        "month_number": "smallint!",
        "month_name": "string!",
        "quarter_number": "smallint!",
        "year_number": "smallint!",
    },
    unique=(("date_key",), ("calendar_date",)),
)

_DATE, _TEAM = ("dim_date", "date_key"), ("dim_team", "team_key")
_TYPE, _PRIORITY = ("dim_workflow_type", "workflow_type_key"), ("dim_priority", "priority_key")

FACT_WORKFLOW_RUN = Table(
    "warehouse",
    "fact_workflow_run",
    {
        "workflow_run_key": "bigint!",
        "workflow_id": "string!",
        "date_key": "int!",
        "team_key": "int!",
        "workflow_type_key": "int!",
        "priority_key": "int!",
        "status_key": "int!",
        "queue_name": "string!",
        "source_system": "string!",
        "created_at": "timestamp!",
        "started_at": "timestamp",
        "completed_at": "timestamp",
        "due_at": "timestamp",
        "processing_minutes": _MONEY,
        "age_hours": _MONEY,
        "records_touched": "int!",
        "error_count": "int!",
        "backlog_flag": "boolean!",
        "exception_flag": "boolean!",
        "sla_breached": "boolean!",
        "loaded_at": "timestamp!",
    },
    surrogate="workflow_run_key",
    unique=(("workflow_run_key",),),
    references={
        "date_key": _DATE,
        "team_key": _TEAM,
        "workflow_type_key": _TYPE,
        "priority_key": _PRIORITY,
        "status_key": ("dim_status", "status_key"),
    },
    defaults={**_COUNT_DEFAULTS, **_FLAG_DEFAULTS, "sla_breached": False},
    stamped="loaded_at",
    partition="date_key",
    sort_by="workflow_id",
)

FACT_EXCEPTION = Table(
    "warehouse",
    "fact_exception",
    {
        "exception_key": "bigint!",
        "workflow_id": "string!",
        "date_key": "int!",
        "team_key": "int!",
        "workflow_type_key": "int!",
        "priority_key": "int!",
        "exception_type": "string!",
        "status_name": "string!",
        "error_count": "int!",
        "detected_at": "timestamp!",
        "resolved_at": "timestamp",
        "open_flag": "boolean!",
    },
    surrogate="exception_key",
    unique=(("exception_key",),),
    references={
        "date_key": _DATE,
        "team_key": _TEAM,
        "workflow_type_key": _TYPE,
        "priority_key": _PRIORITY,
    },
    defaults={"error_count": 0, "open_flag": True},
    partition="date_key",
    sort_by="workflow_id",
)

FACT_BACKLOG_DAILY = Table(
    "warehouse",
    "fact_backlog_daily",
    {
        "backlog_snapshot_key": "bigint!",
        "date_key": "int!",
        "team_key": "int!",
        "workflow_type_key": "int!",
        "priority_key": "int!",
        "open_workflow_count": "int!",
        "overdue_workflow_count": "int!",
        "avg_age_hours": f"{_MONEY}!",
        "created_at": "timestamp!",
    },
    surrogate="backlog_snapshot_key",
    unique=(
        ("backlog_snapshot_key",),
        ("date_key", "team_key", "workflow_type_key", "priority_key"),
    ),
    references={
        "date_key": _DATE,
        "team_key": _TEAM,
        "workflow_type_key": _TYPE,
        "priority_key": _PRIORITY,
    },
    stamped="created_at",
    partition="month_key",
    sort_by="date_key",
)

KPI_DAILY_SUMMARY = Table(
    "marts",
    "kpi_daily_summary",
    {
        "kpi_summary_key": "bigint!",
        "date_key": "int!",
        "team_key": "int",
        "workflow_type_key": "int",
        "total_workflows": "int!",
        "completed_workflows": "int!",
        "backlog_workflows": "int!",
        "exception_workflows": "int!",
        "sla_breach_count": "int!",
        "avg_processing_minutes": f"{_MONEY}!",
        "avg_age_hours": f"{_MONEY}!",
        "throughput_per_assignee": _MONEY,
        "data_quality_score": "decimal(5,2)!",
        "created_at": "timestamp!",
    },
    surrogate="kpi_summary_key",
    unique=(("kpi_summary_key",), ("date_key", "team_key", "workflow_type_key")),
    references={"date_key": _DATE, "team_key": _TEAM, "workflow_type_key": _TYPE},
    stamped="created_at",
    partition="month_key",
    sort_by="date_key",
)

DIMENSIONS = (DIM_TEAM, DIM_WORKFLOW_TYPE, DIM_PRIORITY, DIM_STATUS, DIM_DATE)
SLICED = (FACT_WORKFLOW_RUN, FACT_EXCEPTION, FACT_BACKLOG_DAILY, KPI_DAILY_SUMMARY)
ALL_TABLES = {t.name: t for t in (RAW, QUARANTINE, STAGING, *DIMENSIONS, *SLICED)}
