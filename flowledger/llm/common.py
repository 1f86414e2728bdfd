"""Small helpers shared by the corpus operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from flowledger.operators.numbering import stage
from flowledger.session import scratch_path
from flowledger.sources.files import remove

# Fixed values of the contracts: what separates words, as a pattern and as characters.
SPACE_PATTERN = r"[\x20\x09-\x0D]+"
SPACE_CHARS = " \t\n\x0b\f\r"
WORD_PATTERN = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_of(column: str) -> Column:
    """The text, empty for null."""
    return F.coalesce(F.col(column), F.lit(""))


def word_list(text: Column) -> Column:
    """All words of a text in order; an empty array if there are none."""
    trimmed = F.btrim(text, F.lit(SPACE_CHARS))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(
        F.split(trimmed, SPACE_PATTERN)
    )


def hash60(column: Column) -> Column:
    """60 bits of the MD5 of a value's text: the same number in every engine and every run."""
    return F.conv(F.substring(F.md5(F.coalesce(column.cast("string"), F.lit(""))), 1, 15), 16, 10).cast(
        "bigint"
    )


def free_name(df: DataFrame, name: str) -> str:
    """`name`, with underscores in front until no column of `df` is called so (in any case)."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = "_" + name
    return name


def wrapped(df: DataFrame, *needed: str) -> DataFrame:
    """Every column inside `row`, and copies of those an operator needs: no name can clash."""
    return df.select(F.struct("*").alias("row"), *needed)


def unwrapped(df: DataFrame, *added: str) -> DataFrame:
    """The columns of `row`, and the added ones in place of columns of the same name."""
    names = {a.lower() for a in added}
    own = [f.name for f in df.schema["row"].dataType.fields if f.name.lower() not in names]
    return df.select(*[F.col("row")[c].alias(c) for c in own], *added)


class Steps:
    """Written intermediate results, deleted together once nothing reads them any more."""

    def __init__(self, spark: SparkSession):
        self.spark, self.paths = spark, []

    def stage(self, df: DataFrame) -> DataFrame:
        self.paths.append(scratch_path(self.spark, "step"))
        return stage(df, self.paths[-1])

    def drop(self, keep: int = 0) -> None:
        """Delete all but the last `keep` results."""
        cut = len(self.paths) - keep
        for path in self.paths[:cut]:
            remove(self.spark, path)
        self.paths = self.paths[cut:]


def crc32_sql(digits: str) -> str:
    """DuckDB expression for the unsigned CRC-32 of bytes given as hexadecimal text."""
    octets = f"list_transform(range(length({digits}) // 2), lambda i: ('0x' || substr({digits}, 2 * i + 1, 2))::UBIGINT)"
    step = "list_reduce([xor(c, b), 0, 0, 0, 0, 0, 0, 0, 0]::UBIGINT[], lambda x, y: xor(x >> 1, 3988292384::UBIGINT * (x & 1)))"
    return (
        f"xor(4294967295::UBIGINT, list_reduce(list_prepend(4294967295::UBIGINT, {octets}), "
        f"lambda c, b: {step}))::BIGINT"
    )
