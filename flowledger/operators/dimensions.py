"""Dimension members seen in a batch, and their type-1 upsert with stable surrogate keys."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession, functions as F

from flowledger.constants import (
    DEFAULT_SLA_HOURS,
    PRIORITY_RANKS,
    TEAMS,
    TERMINAL_STATUSES,
    UNKNOWN,
    WORKFLOW_TYPES,
)
from flowledger.functions.timing import calendar_date, date_key
from flowledger.operators.numbering import number_rows, stage
from flowledger.tables import Table


def literal_table(spark: SparkSession, columns: str, rows: Iterable[tuple]) -> DataFrame:
    """A constant table the optimizer knows the size of (so it broadcasts it by itself)."""
    quoted = ", ".join(
        "(" + ", ".join(f"'{v}'" if isinstance(v, str) else str(v) for v in row) + ")"
        for row in rows
    )
    return spark.sql(f"SELECT * FROM VALUES {quoted} AS t({columns})")


def team_members(staging: DataFrame) -> DataFrame:
    known = literal_table(
        staging.sparkSession,
        "team_name, department_name, manager_name",
        [(team, *attributes) for team, attributes in TEAMS.items()],
    )
    return (
        staging.select("team_name")
        .distinct()
        .join(known, "team_name", "left")
        .select(
            "team_name",
            F.coalesce("department_name", F.lit(UNKNOWN)).alias("department_name"),
            F.coalesce("manager_name", F.lit(UNKNOWN)).alias("manager_name"),
            F.lit(True).alias("active_flag"),
        )
    )


def workflow_type_members(staging: DataFrame) -> DataFrame:
    known = literal_table(
        staging.sparkSession,
        "workflow_type, workflow_domain, default_sla_hours",
        [(name, *attributes) for name, attributes in WORKFLOW_TYPES.items()],
    )
    return (
        staging.select("workflow_type")
        .distinct()
        .join(known, "workflow_type", "left")
        .select(
            "workflow_type",
            F.coalesce("workflow_domain", F.lit(UNKNOWN)).alias("workflow_domain"),
            F.coalesce("default_sla_hours", F.lit(DEFAULT_SLA_HOURS)).alias("default_sla_hours"),
        )
    )


def priority_members(spark: SparkSession) -> DataFrame:
    return literal_table(spark, "priority_name, priority_rank", PRIORITY_RANKS.items())


def status_members(staging: DataFrame) -> DataFrame:
    return (
        staging.where(F.col("status").isNotNull())
        .select(F.col("status").alias("status_name"))
        .distinct()
        .withColumn("terminal_flag", F.col("status_name").isin(*TERMINAL_STATUSES))
    )


def date_members(dated: DataFrame) -> DataFrame:
    """The days in column `calendar_date`."""
    day = F.col("calendar_date")
    return (
        dated.select(day)
        .where(day.isNotNull())
        .distinct()
        .select(
            date_key(day).alias("date_key"),
            day,
            (F.weekday(day) + 1).cast("smallint").alias("day_of_week"),
            F.date_format(day, "EEEE").alias("day_name"),
            F.weekofyear(day).cast("smallint").alias("week_of_year"),
            F.month(day).cast("smallint").alias("month_number"),
            F.date_format(day, "MMMM").alias("month_name"),
            F.quarter(day).cast("smallint").alias("quarter_number"),
            F.year(day).cast("smallint").alias("year_number"),
        )
    )


MEMBER_KINDS = ("team_name", "workflow_type", "status", "calendar_date")


def seen_members(staging: DataFrame) -> DataFrame:
    """What a batch holds, from one scan: a row per team, type, status and day, with `kind` naming the column
    that is filled, and one of kind `all`; each with its number of rows and of flagged rows."""
    rows = staging.withColumn("calendar_date", calendar_date(F.col("created_at")))
    kind = F.lit("all")
    for name in MEMBER_KINDS:
        kind = F.when(F.grouping(name) == 0, F.lit(name)).otherwise(kind)
    grouped = rows.select(*MEMBER_KINDS, "exception_flag").groupingSets(
        [*[[F.col(name)] for name in MEMBER_KINDS], []], *MEMBER_KINDS
    )
    return grouped.agg(
        kind.alias("kind"), F.count("*").alias("n_rows"), F.count_if("exception_flag").alias("n_flagged")
    )


def dimensions_of(seen: DataFrame) -> dict[str, DataFrame]:
    """Dimension members from the (written) rows of `seen_members`."""

    def of(kind: str) -> DataFrame:
        return seen.where(F.col("kind") == kind)

    return {
        "dim_team": team_members(of("team_name")),
        "dim_workflow_type": workflow_type_members(of("workflow_type")),
        "dim_priority": priority_members(seen.sparkSession),
        "dim_status": status_members(of("status")),
        "dim_date": date_members(of("calendar_date")),
    }


def build_dimensions(staging: DataFrame) -> dict[str, DataFrame]:
    """All members a batch holds; the batch is read once, now."""
    return dimensions_of(stage(seen_members(staging)))


# Natural key and the order in which new members get their numbers.
NATURAL_KEYS = {
    "dim_team": ("team_name", "team_name"),
    "dim_workflow_type": ("workflow_type", "workflow_type"),
    "dim_priority": ("priority_name", "priority_rank"),
    "dim_status": ("status_name", "status_name"),
    "dim_date": ("date_key", "date_key"),
}


def upsert_dimension(existing: DataFrame, incoming: DataFrame, table: Table) -> DataFrame:
    """Update the attributes of known members, append new ones, and never touch a surrogate key."""
    natural, order = NATURAL_KEYS[table.name]
    attributes = [c for c in table.columns if c not in (natural, table.surrogate)]
    existing = existing.select(*table.columns)
    fresh = incoming.select(
        natural, F.struct(*[F.col(c).cast(table.type_of(c)).alias(c) for c in attributes]).alias("_new")
    )
    updated = existing.join(fresh, natural, "left").select(
        *[c for c in table.columns if c not in attributes],
        *[
            F.when(F.col("_new").isNotNull(), F.col(f"_new.{c}")).otherwise(F.col(c)).alias(c)
            for c in attributes
        ],
    )
    added = incoming.join(existing.select(natural), natural, "left_anti")
    if added.isEmpty():
        return updated.select(*table.columns)
    if table.surrogate:
        last = existing.agg(F.coalesce(F.max(table.surrogate), F.lit(0))).first()[0]
        added = number_rows(added.orderBy(order), table.surrogate, last)
    return updated.unionByName(table.conform(added)).select(*table.columns)
