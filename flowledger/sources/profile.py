"""What a delivery holds, before validation."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from flowledger.functions.coerce import to_flag
from flowledger.functions.text import clean


def source_profile(df: DataFrame) -> DataFrame:
    """Record, exception and backlog counts: in all, per team and per workflow type.

    One pass with grouping sets; the teams and types come back as rows, so no list of them is
    gathered in one place.
    """
    typed = df.select(
        clean(F.col("team_name")).alias("team_name"),
        clean(F.col("workflow_type")).alias("workflow_type"),
        to_flag(clean(F.col("exception_flag"))).alias("exception_flag"),
        to_flag(clean(F.col("backlog_flag"))).alias("backlog_flag"),
    )
    team, kind = F.col("team_name"), F.col("workflow_type")
    member = (
        F.when(F.grouping("team_name") == 0, F.lit("team"))
        .when(F.grouping("workflow_type") == 0, F.lit("workflow_type"))
        .otherwise(F.lit("all"))
    )
    return (
        typed.groupingSets([[], [team], [kind]], team, kind)
        .agg(
            member.alias("member_kind"),
            F.count("*").alias("record_count"),
            F.count_if("exception_flag").alias("exception_rows"),
            F.count_if("backlog_flag").alias("backlog_rows"),
        )
        .select(
            "member_kind",
            F.coalesce(team, kind, F.lit("")).alias("member_name"),
            "record_count",
            "exception_rows",
            "backlog_rows",
        )
    )
