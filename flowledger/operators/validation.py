"""Typing and validation of source rows, and the split into valid and quarantined rows."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from flowledger.constants import (
    PRIORITY_RANKS,
    QUARANTINED,
    SOURCE_COLUMNS,
    STATUSES,
    TIMESTAMP_COLUMNS,
    VALID,
)
from flowledger.functions.coerce import in_range, or_false, parse_instant, to_flag, to_int
from flowledger.functions.text import clean
from flowledger.operators.keyed import BOOKKEEPING
from flowledger.operators.numbering import stage

@dataclass(frozen=True)
class Validated:
    """`rows` holds every source row, typed and labelled; the rest is derived from it."""

    rows: DataFrame

    def staged(self) -> Validated:
        """The same rows, written once.

        Use it before going on with one half or both: the filter on the status would otherwise be
        pushed below the parsing and repeat it, and each half would read the source again.
        """
        return Validated(stage(self.rows, None, "validation_status"))

    @property
    def valid(self) -> DataFrame:
        return self.rows.where(F.col("validation_status") == VALID)

    @property
    def invalid(self) -> DataFrame:
        return self.rows.where(F.col("validation_status") == QUARANTINED)

    @property
    def summary(self) -> DataFrame:
        return summarise_validation(self.rows)


def missing_columns(df: DataFrame) -> list[str]:
    return sorted(set(SOURCE_COLUMNS) - set(df.columns))


def require_columns(df: DataFrame) -> None:
    missing = missing_columns(df)
    if missing:
        raise ValueError(f"Missing required columns: {', '.join(missing)}")


_UNPARSED = "_unparsed"


def normalise_source(df: DataFrame) -> DataFrame:
    """Type the 20 source columns; other columns pass through.

    `_unparsed` lists an error code for each timestamp column that held text but no timestamp. The
    work is laid out in three projections that each use the cells of the one before more than once:
    Spark then keeps them apart, and no cell is cleaned or parsed twice.
    """
    extras = [c for c in df.columns if c not in SOURCE_COLUMNS]
    texts = [c for c in SOURCE_COLUMNS if c != "payload"]
    cleaned = df.select(
        *[clean(F.col(c)).alias(c) for c in texts],
        F.col("payload").cast("string").alias("payload"),
        *extras,
    )
    parsed = cleaned.withColumns(
        {
            "source_row_number": to_int(F.col("source_row_number"), -1, "bigint"),
            "assignee_id": F.nullif(F.col("assignee_id"), F.lit("")),
            "priority": F.lower("priority"),
            "status": F.lower("status"),
            "backlog_flag": to_flag(F.col("backlog_flag")),
            "exception_flag": to_flag(F.col("exception_flag")),
            "exception_type": F.nullif(F.col("exception_type"), F.lit("")),
            "records_touched": to_int(F.col("records_touched"), 0),
            "error_count": to_int(F.col("error_count"), 0),
            **{f"_at_{c}": parse_instant(F.col(c)) for c in TIMESTAMP_COLUMNS},
        }
    )
    usable = {c: in_range(F.col(f"_at_{c}")) for c in TIMESTAMP_COLUMNS}
    bad_cells = [
        F.when((F.col(c) != "") & ~usable[c], F.lit(f"invalid_{c}")) for c in TIMESTAMP_COLUMNS
    ]
    instants = {c: F.when(usable[c], F.col(f"_at_{c}")) for c in TIMESTAMP_COLUMNS}
    return parsed.select(
        *[instants.get(c, F.col(c)).alias(c) for c in SOURCE_COLUMNS],
        *extras,
        F.array_compact(F.array(*bad_cells)).alias(_UNPARSED),
    )


def validation_errors() -> Column:
    """Ordered error codes of a normalised row; an empty array when there is nothing wrong."""
    rules = {
        "empty_workflow_id": F.col("workflow_id") == "",
        "invalid_status": ~F.col("status").isin(*STATUSES),
        "invalid_priority": ~F.col("priority").isin(*PRIORITY_RANKS),
        "completed_before_created": F.col("completed_at") < F.col("created_at"),
        "due_before_created": F.col("due_at") < F.col("created_at"),
    }
    broken = F.array(*[F.when(or_false(rule), F.lit(code)) for code, rule in rules.items()])
    return F.concat(F.col(_UNPARSED), F.array_compact(broken))


def validate(df: DataFrame) -> Validated:
    require_columns(df)
    errors = F.col("validation_errors")
    rows = (
        normalise_source(df)
        .withColumn("validation_errors", validation_errors())
        .withColumn(
            "validation_status",
            F.when(F.size(errors) == 0, F.lit(VALID)).otherwise(F.lit(QUARANTINED)),
        )
        .drop(_UNPARSED)
    )
    return Validated(rows)


def summarise_validation(rows: DataFrame) -> DataFrame:
    """One row: input, valid, invalid and quarantined counts, in one pass."""
    rejected = F.count_if(F.col("validation_status") == QUARANTINED)
    return rows.agg(
        F.count("*").alias("input_rows"),
        F.count_if(F.col("validation_status") == VALID).alias("valid_rows"),
        rejected.alias("invalid_rows"),
        rejected.alias("quarantined_rows"),
    )


def quarantine_records(invalid: DataFrame) -> DataFrame:
    """Rejected rows as the quarantine table keeps them.

    The payload is the row after normalisation, so a timestamp that failed to parse is null in it.
    """
    packed = [c for c in invalid.columns if c not in ("validation_errors", *BOOKKEEPING)]
    return invalid.select(
        "source_file_name",
        "source_row_number",
        "workflow_id",
        "validation_errors",
        F.to_json(F.struct(*packed), {"ignoreNullFields": "false"}).alias("raw_payload"),
        *[c for c in BOOKKEEPING if c in invalid.columns],
    )
