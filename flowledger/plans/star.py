"""A star schema over one batch without a warehouse: the same tables, as DataFrames."""

from __future__ import annotations

from functools import partial

from pyspark.sql import DataFrame

from flowledger.operators.dimensions import build_dimensions, upsert_dimension
from flowledger.operators.facts import build_facts
from flowledger.operators.numbering import stage
from flowledger.plans.loads import together
from flowledger.tables import DIMENSIONS, SLICED, Table


def star_of(staging: DataFrame) -> dict[str, DataFrame]:
    """Dimensions (written once, so their size is known to the joins) and facts (lazy).

    `staging` should be a written stage: every table reads it.
    """
    spark = staging.sparkSession
    members = build_dimensions(staging)

    def build(table: Table) -> DataFrame:
        return stage(upsert_dimension(table.empty(spark), members[table.name], table))

    built = together(*[partial(build, t) for t in DIMENSIONS])
    dims = {t.name: df for t, df in zip(DIMENSIONS, built, strict=True)}
    facts = build_facts(staging, dims)
    return {**dims, **{t.name: t.conform(facts[t.name]) for t in SLICED}}
