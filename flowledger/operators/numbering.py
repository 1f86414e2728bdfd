"""Consecutive numbers without a single-task window.

A global `row_number()` would pull every row into one task. Instead the rows are written once, together
with the id of their partition and their place in it, and a prefix sum over the row counts of the
partitions (one row per task, whatever the data size) turns that pair into a consecutive number.
Writing first also pins the order: a task that is retried later reads the same files. The prefix sums
are written too, so the optimizer knows their size when it decides whether to broadcast them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from flowledger.session import scratch_path

PLACE = "_place"  # monotonically_increasing_id: partition number << 33 | place in the partition
_PLACE_BITS = 33
# Files are split between row groups only: large ones would give a task more rows than its split.
ROW_GROUP = {"parquet.block.size": 16 << 20}


def stage(df: DataFrame, path: str | None = None, *partition_by: str) -> DataFrame:
    """Write a result to the shared folder and go on from the files: cuts lineage, survives executors."""
    path = path or scratch_path(df.sparkSession, "stage")
    df.write.mode("overwrite").options(**ROW_GROUP).partitionBy(*partition_by).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def number_rows(df: DataFrame, name: str, start: int = 0, write=stage) -> DataFrame:
    """Add `name` = start+1, start+2, ... in the present row order of `df` (sort it first if it matters).

    `write` writes a result and reads it again, here and below: a caller may give its own to delete it later.
    """
    return with_row_number(write(with_place(df)), name, start, write)


def with_place(df: DataFrame) -> DataFrame:
    return df.withColumn(PLACE, F.monotonically_increasing_id())


def with_row_number(placed: DataFrame, name: str, start: int = 0, write=stage) -> DataFrame:
    """The second half of `number_rows`, for rows that are already written with their place."""
    part = F.shiftright(F.col(PLACE), _PLACE_BITS)
    sizes = placed.groupBy(part.alias("_part")).agg(F.count("*").alias("_rows"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = write(
        sizes.select("_part", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_offset"))
    )
    place = F.col(PLACE).bitwiseAND(F.lit((1 << _PLACE_BITS) - 1))
    return (
        placed.withColumn("_part", part)
        .join(offsets, "_part")
        .withColumn(name, F.lit(start) + F.col("_offset") + place + 1)
        .drop("_part", "_offset", PLACE)
    )


def number_within_files(df: DataFrame, file: str, block: str, name: str, write=stage) -> DataFrame:
    """1..n per file for rows read in splits: place within the split plus the rows of earlier splits."""
    placed = write(with_place(df))
    blocks = placed.groupBy(file, block).agg(
        F.count("*").alias("_rows"), F.min(PLACE).alias("_first")
    )
    before = Window.partitionBy(file).orderBy(block).rowsBetween(Window.unboundedPreceding, -1)
    offsets = write(
        blocks.select(
            file, block, "_first", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_offset")
        )
    )
    return (
        placed.join(offsets, [file, block])
        .withColumn(name, F.col("_offset") + F.col(PLACE) - F.col("_first") + 1)
        .drop("_offset", "_first", PLACE)
    )
