"""From valid source rows to one enriched row per workflow."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, functions as F

from flowledger.constants import (
    HIGH_PROCESSING,
    HIGH_PROCESSING_HOURS,
    INVALID_LIFECYCLE,
    MISSING_ASSIGNEE,
    OVERDUE,
    TERMINAL_STATUSES,
    VALID,
)
from flowledger.functions.coerce import or_false
from flowledger.functions.text import blank_to_null, clean, clean_lower
from flowledger.functions.timing import (
    MICROS_PER_HOUR,
    elapsed_micros,
    micros_to_hours,
    micros_to_minutes,
)
from flowledger.operators.keyed import EVENT_NUMBER, input_order, pick_numbered, pick_one


def moment(as_of: datetime | str | Column | None) -> Column:
    """The one 'now' of a run; text and datetimes without a zone are UTC."""
    if as_of is None:
        return F.current_timestamp()
    if isinstance(as_of, Column):
        return as_of
    text = as_of if isinstance(as_of, str) else as_of.isoformat()
    return F.lit(text).cast("timestamp")


def normalise_fields(df: DataFrame) -> DataFrame:
    return df.withColumns(
        {
            "status": clean_lower(F.col("status")),
            "priority": clean_lower(F.col("priority")),
            "workflow_id": clean(F.col("workflow_id")),
        }
    )


def add_temporal_metrics(df: DataFrame, as_of: datetime | str | Column | None = None) -> DataFrame:
    """updated_at, turnaround, age and processing time.

    The spans are also kept as whole microseconds (`turnaround_us`, `age_us`): later sums are exact.
    """
    created, completed = F.col("created_at"), F.col("completed_at")
    return (
        df.withColumn("updated_at", F.coalesce(completed, F.col("started_at"), created))
        .withColumns(
            {
                "turnaround_us": elapsed_micros(created, F.col("updated_at")),
                "age_us": elapsed_micros(created, F.coalesce(completed, moment(as_of))),
            }
        )
        .withColumns(
            {
                "turnaround_hours": micros_to_hours(F.col("turnaround_us")),
                "age_hours": micros_to_hours(F.col("age_us")),
                "processing_minutes": micros_to_minutes(F.col("turnaround_us")),
            }
        )
    )


def latest_per_workflow(
    df: DataFrame, key: str = "workflow_id", updated: str = "updated_at"
) -> DataFrame:
    """The most recently updated row of each workflow; equal times keep the row that came first."""
    if updated not in df.columns:
        raise ValueError(f"{updated} column is required for deduplication")
    pick = pick_numbered if EVENT_NUMBER in df.columns else pick_one
    return pick(df, [key], [F.col(updated).desc_nulls_last(), *input_order(df)])


def flag_sla_breach(df: DataFrame, as_of: datetime | str | Column | None = None) -> DataFrame:
    finished = F.coalesce(F.col("completed_at"), moment(as_of))
    return df.withColumn("sla_breached", or_false(finished > F.col("due_at")))


def exception_rules(as_of: datetime | str | Column | None = None) -> dict[str, Column]:
    """Exception type -> condition, strongest first."""
    status, created = F.col("status"), F.col("created_at")
    return {
        OVERDUE: ~status.isin(*TERMINAL_STATUSES) & or_false(F.col("due_at") < moment(as_of)),
        MISSING_ASSIGNEE: clean(F.col("assignee_id")) == "",
        INVALID_LIFECYCLE: ((status == "completed") & F.col("completed_at").isNull())
        | or_false(F.col("started_at") < created),
        HIGH_PROCESSING: F.col("turnaround_us") > HIGH_PROCESSING_HOURS * MICROS_PER_HOUR,
    }


def flag_exceptions(df: DataFrame, as_of: datetime | str | Column | None = None) -> DataFrame:
    """Set exception_flag where the source or any rule says so, and name the strongest rule."""
    rules = exception_rules(as_of)
    by_rule = F.coalesce(*[F.when(hit, F.lit(name)) for name, hit in rules.items()])
    flagged = F.coalesce(F.col("exception_flag"), F.lit(False))
    for hit in rules.values():
        flagged = flagged | hit
    return df.withColumns(
        {
            "exception_type": F.coalesce(by_rule, blank_to_null(F.col("exception_type"))),
            "exception_flag": flagged,
        }
    )


def prepare_staging(valid: DataFrame, as_of: datetime | str | Column | None = None) -> DataFrame:
    """One row per workflow with metrics and flags, all against the same `as_of`."""
    timed = add_temporal_metrics(normalise_fields(valid), as_of)
    # the metrics once more, from the kept rows: then none but `updated_at` is shuffled with every row
    latest = add_temporal_metrics(latest_per_workflow(timed), as_of)
    staged = flag_exceptions(flag_sla_breach(latest, as_of), as_of)
    defaults = {
        "validation_status": F.lit(VALID),
        "validation_errors": F.array().cast("array<string>"),
    }
    return staged.withColumns({c: v for c, v in defaults.items() if c not in staged.columns})
