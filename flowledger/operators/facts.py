"""Daily aggregates and the four fact and mart frames of a batch."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, functions as F

from flowledger.constants import CLOSED_EXCEPTION_STATUSES, TERMINAL_STATUSES
from flowledger.functions.numeric import SCORE, exact_sum, mean_half_up, ratio_half_up
from flowledger.functions.timing import MICROS_PER_HOUR, calendar_date, date_key, stored_hours
from flowledger.operators.keyed import EVENT_NUMBER

KPI_GRAIN = ("calendar_date", "team_name", "workflow_type")
BACKLOG_GRAIN = (*KPI_GRAIN, "priority")


def _carried(df: DataFrame) -> list[str]:
    return [EVENT_NUMBER] if EVENT_NUMBER in df.columns else []


def _lowest_number(df: DataFrame) -> list[Column]:
    return [F.min(c).alias(c) for c in _carried(df)]


def quality_score() -> Column:
    """100, less 10 per error, 15 for no assignee and 5 for a missed due time; within 0..100."""
    errors = F.col("error_count").cast("bigint") * 10
    unassigned = F.when(F.col("assignee_id").isNull(), 15).otherwise(0)
    breach = F.when(F.col("sla_breached"), 5).otherwise(0)
    return F.least(F.greatest(100 - errors - unassigned - breach, F.lit(0)), F.lit(100))


def backlog_rows(staging: DataFrame) -> DataFrame:
    return staging.where(F.col("backlog_flag") | ~F.col("status").isin(*TERMINAL_STATUSES))


def build_backlog_daily(staging: DataFrame) -> DataFrame:
    sums = (
        backlog_rows(staging)
        .withColumn("calendar_date", calendar_date(F.col("created_at")))
        .groupBy(*BACKLOG_GRAIN)
        .agg(
            F.count("workflow_id").alias("open_workflow_count"),
            F.count_if("sla_breached").alias("overdue_workflow_count"),
            exact_sum(F.col("age_us")).alias("_age"),
            F.count("*").alias("_rows"),
            *_lowest_number(staging),
        )
    )
    return sums.select(
        *BACKLOG_GRAIN,
        "open_workflow_count",
        "overdue_workflow_count",
        mean_half_up(F.col("_age"), F.col("_rows"), MICROS_PER_HOUR).alias("avg_age_hours"),
        *_carried(staging),
    )


def build_kpi_daily(staging: DataFrame) -> DataFrame:
    sums = (
        staging.withColumn("calendar_date", calendar_date(F.col("created_at")))
        .groupBy(*KPI_GRAIN)
        .agg(
            F.count("workflow_id").alias("total_workflows"),
            F.count_if(F.col("status") == "completed").alias("completed_workflows"),
            F.count_if("backlog_flag").alias("backlog_workflows"),
            F.count_if("exception_flag").alias("exception_workflows"),
            F.count_if("sla_breached").alias("sla_breach_count"),
            exact_sum(F.col("processing_minutes") * 100).alias("_minutes"),
            exact_sum(F.col("age_us")).alias("_age"),
            exact_sum(quality_score()).alias("_quality"),
            F.count_distinct("assignee_id").alias("_assignees"),
            F.count("*").alias("_rows"),
            *_lowest_number(staging),
        )
    )
    rows, total = F.col("_rows"), F.col("total_workflows")
    # nobody assigned: the whole slice counts as one pair of hands
    hands = F.when(F.col("_assignees") == 0, F.lit(1)).otherwise(F.col("_assignees"))
    return sums.select(
        *KPI_GRAIN,
        "total_workflows",
        "completed_workflows",
        "backlog_workflows",
        "exception_workflows",
        "sla_breach_count",
        mean_half_up(F.col("_minutes"), rows, 100).alias("avg_processing_minutes"),
        mean_half_up(F.col("_age"), rows, MICROS_PER_HOUR).alias("avg_age_hours"),
        ratio_half_up(total, hands).alias("throughput_per_assignee"),
        mean_half_up(F.col("_quality"), rows, dtype=SCORE).alias("data_quality_score"),
        *_carried(staging),
    )


def open_exception_flag(status: Column) -> Column:
    return ~status.isin(*CLOSED_EXCEPTION_STATUSES)


def attach_keys(df: DataFrame, dims: Mapping[str, DataFrame], *names: str) -> DataFrame:
    """Look up surrogate keys by natural key; the date key follows from the date itself.

    No broadcast hint: the dimensions are read from files, so the optimizer sees their size and
    broadcasts them while they are small; a dimension that outgrows the limit is joined by shuffle.
    """
    lookups = {
        "team": ("dim_team", "team_name", "team_name", "team_key"),
        "type": ("dim_workflow_type", "workflow_type", "workflow_type", "workflow_type_key"),
        "priority": ("dim_priority", "priority_name", "priority", "priority_key"),
        "status": ("dim_status", "status_name", "status", "status_key"),
    }
    for name in names:
        dim, natural, column, key = lookups[name]
        members = dims[dim].select(F.col(natural).alias(column), key)
        df = df.join(members, column, "left")
    return df.withColumn("date_key", date_key(F.col("calendar_date")))


def fact_workflow_run(staging: DataFrame, dims: Mapping[str, DataFrame]) -> DataFrame:
    dated = staging.withColumn("calendar_date", calendar_date(F.col("created_at")))
    keyed = attach_keys(dated, dims, "team", "type", "priority", "status")
    return keyed.select(
        "workflow_id",
        "date_key",
        "team_key",
        "workflow_type_key",
        "priority_key",
        "status_key",
        "queue_name",
        "source_system",
        "created_at",
        "started_at",
        "completed_at",
        "due_at",
        "processing_minutes",
        stored_hours(F.col("age_us")).alias("age_hours"),
        "records_touched",
        "error_count",
        "backlog_flag",
        "exception_flag",
        "sla_breached",
        *_carried(staging),
    )


def fact_exception(staging: DataFrame, dims: Mapping[str, DataFrame]) -> DataFrame:
    flagged = staging.where("exception_flag").withColumn(
        "calendar_date", calendar_date(F.col("created_at"))
    )
    return attach_keys(flagged, dims, "team", "type", "priority").select(
        "workflow_id",
        "date_key",
        "team_key",
        "workflow_type_key",
        "priority_key",
        "exception_type",
        F.col("status").alias("status_name"),
        "error_count",
        F.col("created_at").alias("detected_at"),
        F.lit(None).cast("timestamp").alias("resolved_at"),
        open_exception_flag(F.col("status")).alias("open_flag"),
        *_carried(staging),
    )


def fact_backlog_daily(backlog: DataFrame, dims: Mapping[str, DataFrame]) -> DataFrame:
    return attach_keys(backlog, dims, "team", "type", "priority").select(
        "date_key",
        "team_key",
        "workflow_type_key",
        "priority_key",
        "open_workflow_count",
        "overdue_workflow_count",
        "avg_age_hours",
        *_carried(backlog),
    )


def kpi_daily_summary(kpi: DataFrame, dims: Mapping[str, DataFrame]) -> DataFrame:
    return attach_keys(kpi, dims, "team", "type").select(
        "date_key",
        "team_key",
        "workflow_type_key",
        "total_workflows",
        "completed_workflows",
        "backlog_workflows",
        "exception_workflows",
        "sla_breach_count",
        "avg_processing_minutes",
        "avg_age_hours",
        "throughput_per_assignee",
        "data_quality_score",
        *_carried(kpi),
    )


def build_facts(staging: DataFrame, dims: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
    return {
        "fact_workflow_run": fact_workflow_run(staging, dims),
        "fact_exception": fact_exception(staging, dims),
        "fact_backlog_daily": fact_backlog_daily(build_backlog_daily(staging), dims),
        "kpi_daily_summary": kpi_daily_summary(build_kpi_daily(staging), dims),
    }
