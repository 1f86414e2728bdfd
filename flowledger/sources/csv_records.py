"""Records of CSV files with line breaks in quoted cells, without giving up splits.

Files are read line by line, in splits. Whether a line begins a record depends on all quotes before it in its
file: an odd number of them says that it lies inside a quoted cell. So quotes are summed up per split, the
parity before each split is a prefix sum over the splits of its file (one row per split), and the parity before
each line is a running sum inside its split. A record that goes over the end of a split is found the same way:
each split learns the last record that began before it. Lines are dealt by split once; the lines of a record are put
together there, and only the last record of a split and what continues it go to other splits.

Quotes inside a cell that is not quoted count only where they touch a comma or an end of the line. A file that
ends inside a quoted cell, or has another header than the first file, is refused.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from flowledger.operators.numbering import stage

RECORD = ("file", "block", "place", "number", "record")

# a quote at an end of the line, or beside a comma or another quote
_QUOTE = r'(?<![^,"])"|"(?![^,"\r])'


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """(file, block, place, line, quotes): `place` orders the lines of a split, `quotes` is 1 for an odd number."""
    line = F.col("value")
    odd = F.when(F.contains(line, F.lit('"')), F.regexp_count(line, F.lit(_QUOTE)) % 2).otherwise(0)
    return spark.read.option("lineSep", "\n").text(path).select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("place"),
        line.alias("line"),
        odd.cast("int").alias("quotes"),
    )


def has_line_breaks(lines: DataFrame) -> bool:
    """Whether any line ends inside a quoted cell; stops at the first one."""
    return not lines.where(F.col("quotes") == 1).isEmpty()


def records(lines: DataFrame) -> DataFrame:
    """The records of all files, as `RECORD`: where each begins, its number in the file (0 is the header), its text.

    `lines` must be written, so that every reading sees the same places. Blank lines between records are left
    out, and have no number.
    """
    split = ["file", "block"]
    earlier = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    upto = Window.partitionBy(*split).orderBy("place").rowsBetween(Window.unboundedPreceding, 0)

    sums = lines.groupBy(*split).agg((F.sum("quotes") % 2).alias("quotes"))
    _refuse_open_cells(sums)
    entering = stage(
        sums.select(*split, F.coalesce(F.sum("quotes").over(earlier) % 2, F.lit(0)).alias("entering"))
    )
    after = (F.col("entering") + F.sum("quotes").over(upto)) % 2
    begins = after == F.col("quotes")  # the parity before the line is even
    blank = (F.col("quotes") == 0) & (F.btrim("line", F.lit(" \t\r")) == "")
    lined = (
        lines.join(entering, split)
        .withColumn("begins", begins)
        .where(~(F.col("begins") & blank))
        .withColumns(
            {
                "nth": F.count_if("begins").over(upto),
                "first": F.last(F.when(F.col("begins"), F.col("place")), ignorenulls=True).over(upto),
            }
        )
    )
    # a row per record and split; the lines of a split are together already, so this deals nothing out again. What
    # stands before the first record of a split has no `first`: it continues a record of an earlier one.
    pieces = stage(
        lined.groupBy(*split, "first")
        .agg(F.max("nth").alias("nth"), F.sort_array(F.collect_list(F.struct("place", "line"))).alias("parts"))
        .select(*split, "first", "nth", F.array_join("parts.line", "\n").alias("text"))
    )
    # what lies before each split: how many records, and the last of them
    known = pieces.groupBy(*split).agg(F.max("nth").alias("n"), F.max("first").alias("last"))
    start = F.when(F.col("last").isNotNull(), F.struct("block", F.col("last").alias("place")))
    known = stage(
        known.select(
            *split,
            "last",
            F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"),
            F.last(start, ignorenulls=True).over(earlier).alias("open"),
        )
    )
    starts = F.col("first").isNotNull()
    found = pieces.join(known, split).select(
        "file",
        F.when(starts, F.struct("block", F.col("first").alias("place"))).otherwise(F.col("open")).alias("first"),
        F.when(starts, F.col("before") + F.col("nth") - 1).alias("number"),
        "block",
        "text",
        (F.col("first") < F.col("last")).alias("whole"),  # null: nothing begins here
    )
    alone = found.where("whole").select("file", "first", "number", F.col("text").alias("record"))
    together = (
        found.where("whole IS NOT TRUE")
        .groupBy("file", "first")
        .agg(F.max("number").alias("number"), F.sort_array(F.collect_list(F.struct("block", "text"))).alias("parts"))
        .select("file", "first", "number", F.array_join("parts.text", "\n").alias("record"))
    )
    text = F.regexp_replace("record", r"\r\z", "")
    return alone.unionByName(together).select("file", "first.*", "number", text.alias("record"))


def _refuse_open_cells(sums: DataFrame) -> None:
    broken = sums.groupBy("file").agg((F.sum("quotes") % 2).alias("odd")).where("odd = 1").first()
    if broken:
        raise ValueError(f"{broken['file']} ends inside a quoted cell")


def parsed(found: DataFrame, columns: list[str], options: dict[str, str]) -> DataFrame:
    """The cells of records by column, with the other columns of `RECORD`; headers are checked and left out."""
    names = [*columns, _more(columns)]
    schema = ", ".join(f"`{c.replace('`', '``')}` string" for c in names)
    cells = found.withColumn("cells", F.from_csv("record", schema, {**options, "multiLine": "true"}))
    kept = cells.where(F.when(F.col("number") == 0, _header(columns, names[-1])).otherwise(True))
    return kept.select(*[F.col(f"cells.`{c}`") for c in columns], F.struct(*RECORD[:4]).alias("at"))


def _more(columns: list[str]) -> str:
    """A name for a cell too many."""
    name = "_more"
    while name in columns:
        name += "_"
    return name


def _header(columns: list[str], more: str) -> Column:
    """False for the header that gave the columns their names; any other is an error."""
    same = F.col(f"cells.`{more}`").isNull()
    for c in columns:
        cell = F.col(f"cells.`{c}`")
        same = same & (cell.isNull() | (F.lower(cell) == c.lower()))
    message = F.concat(F.lit("CSV header does not conform to the other files: "), F.col("file"))
    return F.when(same, F.lit(False)).otherwise(F.raise_error(message).cast("boolean"))
