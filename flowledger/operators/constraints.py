"""Constraint checks as aggregations and anti-joins.

Each check returns the number of rows that break it; `require` turns that into an error.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Mapping, Sequence
from contextlib import contextmanager
from functools import reduce

from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, functions as F

from flowledger.tables import Table


class ConstraintViolation(ValueError):
    pass


def null_counts(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    """(column_name, violations), one pass over the data for all columns."""
    columns = list(columns)
    counted = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    return counted.unpivot([], columns, "column_name", "violations")


def duplicate_keys(df: DataFrame, key: Sequence[str]) -> DataFrame:
    """Keys held by more than one row; a key with a null part never collides."""
    present = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in key])
    return df.where(present).groupBy(*key).agg(F.count("*").alias("n")).where("n > 1")


def dangling_keys(
    df: DataFrame, column: str, parent: DataFrame, parent_column: str
) -> DataFrame:
    """Distinct non-null references without a parent row."""
    parents = parent.select(F.col(parent_column).alias(column))
    references = df.where(F.col(column).isNotNull()).groupBy(column).agg(F.count("*").alias("n"))
    return references.join(parents, column, "left_anti")


def invalid_json(df: DataFrame, column: str) -> DataFrame:
    return df.where(F.col(column).isNotNull() & F.try_parse_json(F.col(column)).isNull())


def require_not_null(df: DataFrame, columns: Iterable[str], table: str) -> None:
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns]).first().asDict()
    broken = {c: n for c, n in counts.items() if n}
    if broken:
        detail = ", ".join(f"{c} ({n} rows)" for c, n in sorted(broken.items()))
        raise ConstraintViolation(f"{table}: null in required columns: {detail}")


_NULL_MARK = "null in a required column of"


def guarded(rows: DataFrame, columns: Iterable[str], table: str) -> DataFrame:
    """`rows` whose evaluation fails at the first null in one of the columns: a check without a pass of its
    own, for rows that are on their way into a table."""
    kinds = dict(rows.dtypes)

    def guard(c: str) -> Column:
        return F.coalesce(F.col(c), F.raise_error(F.lit(f"{_NULL_MARK} {table}")).cast(kinds[c])).alias(c)

    required = set(columns)
    return rows.select(*[guard(c) if c in required else F.col(c) for c in rows.columns])


@contextmanager
def refusing_nulls(rows: DataFrame, columns: Iterable[str], table: str) -> Iterator[None]:
    """Turns the failure of a guarded write into a violation that names columns and counts."""
    try:
        yield
    except PySparkException as error:
        if _NULL_MARK in str(error):
            require_not_null(rows, columns, table)
        raise


def require_empty(violations: DataFrame, message: str) -> None:
    if not violations.isEmpty():
        raise ConstraintViolation(message)


def audit(tables: Mapping[str, DataFrame], specs: Mapping[str, Table]) -> DataFrame:
    """(table_name, constraint_type, constraint_name, violations) for every declared constraint."""
    parts: list[DataFrame] = []

    def add(df: DataFrame, table: str, kind: str, name) -> None:
        parts.append(
            df.select(
                F.lit(table).alias("table_name"),
                F.lit(kind).alias("constraint_type"),
                name.alias("constraint_name"),
                F.col("violations").cast("bigint").alias("violations"),
            )
        )

    for name, df in tables.items():
        spec = specs[name]
        add(null_counts(df, spec.required), name, "not_null", F.col("column_name"))
        for key in spec.unique:
            counted = duplicate_keys(df, key).agg(F.count("*").alias("violations"))
            add(counted, name, "unique", F.lit(",".join(key)))
        for column, (parent, parent_column) in spec.references.items():
            dangling = dangling_keys(df, column, tables[parent], parent_column)
            counted = dangling.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("violations"))
            add(counted, name, "foreign_key", F.lit(column))
    return reduce(DataFrame.unionByName, parts)
