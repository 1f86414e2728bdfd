"""Workflow event files: CSV with a header row, every column read as text."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession, functions as F

from flowledger.functions.text import drop_missing_tokens
from flowledger.operators.keyed import INPUT_POSITION
from flowledger.operators.numbering import number_within_files, stage
from flowledger.sources import csv_records
from flowledger.sources.files import exists, input_root


def ensure_input_exists(spark: SparkSession, path: str) -> str:
    if not exists(spark, path):
        raise FileNotFoundError(f"Input file was not found: {path}")
    return path


_CSV = {"escape": '"'}


def read_workflow_csv(spark: SparkSession, path: str) -> DataFrame:
    """Read files by header name; cells that spell 'no value' become null.

    Files are split, so many tasks share a large one, also where quoted cells hold line breaks: then records are
    put together from lines (see `csv_records`). `_input_position` records where a row stood, for the rules that
    keep the first or last of several rows.
    """
    ensure_input_exists(spark, path)
    scan = (
        spark.read.options(**_CSV)
        .option("header", True)
        .option("enforceSchema", False)  # a file with other columns is an error, not shifted data
        .csv(path)
    )
    lines = csv_records.read_lines(spark, path)
    if csv_records.has_line_breaks(lines):
        rows = csv_records.parsed(csv_records.records(stage(lines)), scan.columns, _CSV)
        file, block, place, number = (F.col(f"at.{c}") for c in csv_records.RECORD[:4])
    else:
        rows, number = scan, None
        file, block = F.col("_metadata.file_path"), F.col("_metadata.file_block_start")
        place = F.monotonically_increasing_id()
    cells = [drop_missing_tokens(F.col(f"`{c}`")).alias(c) for c in scan.columns]
    position = F.struct(file.alias("file"), block.alias("block"), place.alias("place"))
    # below the input root, so that files of one name in different folders stay apart; Spark writes
    # file:/ and file:/// for the same place
    root = re.sub(r"^([a-z0-9]+:)/+", r"\1/", input_root(spark, path))
    file = F.regexp_replace(file, "^([a-z0-9]+:)/+", "$1/")
    name = F.when(file.startswith(root), F.substring(file, len(root) + 1, 1 << 20))
    found = rows.select(
        *cells,
        position.alias(INPUT_POSITION),
        F.url_decode(F.replace(F.coalesce(name, file), F.lit("+"), F.lit("%2B"))).alias("_file_name"),
        *([] if number is None else [number.alias("_number")]),
    )
    return _fill_lineage(found)


def _fill_lineage(rows: DataFrame) -> DataFrame:
    """Source file name and row number 1..n where the file does not bring them."""
    if "source_row_number" not in rows.columns and "_number" in rows.columns:
        rows = rows.withColumn("source_row_number", F.col("_number").cast("string"))
    elif "source_row_number" not in rows.columns:
        split = rows.withColumns(
            {"_file": F.col(f"{INPUT_POSITION}.file"), "_block": F.col(f"{INPUT_POSITION}.block")}
        )
        numbered = number_within_files(split, "_file", "_block", "source_row_number")
        rows = numbered.drop("_file", "_block").withColumn(
            "source_row_number", F.col("source_row_number").cast("string")
        )
    if "source_file_name" not in rows.columns:
        rows = rows.withColumn("source_file_name", F.col("_file_name"))
    return rows.drop("_file_name", "_number")
