"""Row selection and replacement by key, the building blocks of the idempotent loads."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from flowledger.operators.numbering import stage

# Where a row stood in its source file: (file path, split start, place). Set by the CSV source only.
INPUT_POSITION = "_input_position"
# Number a load gives to each source row. It becomes the surrogate key wherever the row is stored.
# Every row belongs to one group of an aggregate, so the lowest number in a group is as unique as the
# group and serves there too. Like those of a database sequence, the numbers have gaps.
EVENT_NUMBER = "_event_no"
BOOKKEEPING = (INPUT_POSITION, EVENT_NUMBER)


def input_order(df: DataFrame, newest_first: bool = False) -> list[Column]:
    """Sort keys that stand for 'the order the rows came in'."""
    if INPUT_POSITION in df.columns:
        keys = [F.col(INPUT_POSITION)]
    else:
        lineage = [c for c in ("source_file_name", "source_row_number") if c in df.columns]
        keys = [*map(F.col, lineage), F.xxhash64(*map(F.col, df.columns))]
    return [k.desc() if newest_first else k.asc() for k in keys]


def pick_one(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """The first row of each key in the given order.

    `row_number() = 1` lets Spark put a group limit in front of the shuffle, so a key that holds a
    large share of the rows sends one row per map task, not all of them, to its reducer.
    """
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_rank", rank).where("_rank = 1").drop("_rank")


def first_per_key(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return pick_one(df, keys, input_order(df))


def last_per_key(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return pick_one(df, keys, input_order(df, newest_first=True))


# Number of the first row of a key, in the rows that share it.
FIRST_NUMBER = "_first_no"
_MANY = 20  # where more than one row in so many shares its key, whole rows are dealt by key


def _shared_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """(written) hashes of the keys that more than one row has, and their rows; equal hashes only add keys."""
    mark = F.xxhash64(*map(F.col, keys))
    return stage(df.groupBy(mark.alias("_mark")).agg(F.count("*").alias("_n")).where("_n > 1"))


def _firsts(df: DataFrame, keys: Sequence[str], order: Sequence[Column], shared: DataFrame) -> DataFrame:
    among = df.withColumn("_mark", F.xxhash64(*map(F.col, keys))).join(shared.select("_mark"), "_mark", "left_semi")
    kept = pick_one(among, keys, order)
    return stage(kept.select(*[F.col(k).alias(f"_of_{k}") for k in keys], F.col(EVENT_NUMBER).alias(FIRST_NUMBER)))


def firsts_of_repeated(df: DataFrame, keys: Sequence[str]) -> DataFrame | None:
    """What `first_per_key` keeps of the keys that repeat: a (written) row per key, None where none repeats.

    Rows must carry numbers and be written. Only key hashes of the others are shuffled, not whole rows, and
    where few keys repeat, what is found is small enough to be broadcast to the rows.
    """
    shared = _shared_keys(df, keys)
    return None if shared.isEmpty() else _firsts(df, keys, input_order(df), shared)


def with_firsts(df: DataFrame, firsts: DataFrame) -> DataFrame:
    """Adds the number of the first row of the key; null where the key does not repeat."""
    keys = [c for c in firsts.columns if c != FIRST_NUMBER]
    same = reduce(Column.__and__, [df[k.removeprefix("_of_")].eqNullSafe(firsts[k]) for k in keys])
    return df.join(firsts, same, "left").drop(*keys)


def only_firsts(df: DataFrame, firsts: DataFrame | None) -> DataFrame:
    """The same rows as `first_per_key`."""
    if firsts is None:
        return df
    first = F.coalesce(FIRST_NUMBER, EVENT_NUMBER) == F.col(EVENT_NUMBER)
    return with_firsts(df, firsts).where(first).drop(FIRST_NUMBER)


def pick_numbered(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """`pick_one` for written rows with numbers: whole rows are shuffled only if many share their key."""
    shared = _shared_keys(df, keys)
    n_shared = shared.agg(F.coalesce(F.sum("_n"), F.lit(0))).first()[0]
    if not n_shared:
        return df
    if n_shared * _MANY > df.count():
        return pick_one(df, keys, order)
    return only_firsts(df, _firsts(df, keys, order, shared))


def only_new(
    batch: DataFrame,
    existing: DataFrame,
    keys: Sequence[str],
    firsts_of: Callable[[DataFrame], DataFrame | None] | None = None,
) -> DataFrame:
    """Append-once: rows whose key is not stored yet; the first of several in the batch wins.

    `batch` carries numbers: which rows are new is found from keys and numbers alone. `firsts_of` may give
    firsts that are known already, also those of more keys.
    """
    numbers = batch.select(*keys, EVENT_NUMBER).join(existing.select(*keys), list(keys), "left_anti")
    fresh = batch.join(stage(numbers.select(EVENT_NUMBER)), EVENT_NUMBER, "left_semi").select(*batch.columns)
    return only_firsts(fresh, firsts_of(fresh) if firsts_of else firsts_of_repeated(fresh, keys))


def replace_by_key(existing: DataFrame, batch: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Stored rows whose key the batch does not carry, plus the batch.

    Which keys are replaced is found from keys alone, and written: where there are none, or few, whole stored
    rows are not shuffled.
    """
    replaced = stage(batch.select(*keys).distinct().join(existing.select(*keys), list(keys), "left_semi"))
    if replaced.isEmpty():
        return existing.unionByName(batch)
    return existing.join(replaced, list(keys), "left_anti").unionByName(batch)
