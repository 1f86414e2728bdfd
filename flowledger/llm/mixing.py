"""Mixing sources to target weights by systematic sampling.

A document's size is its number of words. Sources in code point order (null last) weigh 1, 2, 3, 1, ...
and share the words of the whole corpus by weight; a target stops at `MAX_REPEAT` times the words of its
source, and what is cut off is shared by the others, again by weight, until no target is above.

Each document of a source has the same expected number of copies, target / words of the source. The
expected copies are summed up along the documents of a source, one random offset is added, and a document
is emitted once for each whole number its stretch of the sum crosses. The order along which they are
summed is by size (in classes), so that the words taken come close to the target, not only the documents.

The sum needs no task that sees a whole source: documents are dealt into cells of (source, size class,
hash bucket), the cells of a class and the classes of a source are summed in turn, and only the rows of
one cell are numbered together. The number of buckets grows with the root of the number of rows.

Everything is DataFrame and SQL functions. Reruns agree: ids are hashed with MD5, and the offset comes
from a seed.

Edge cases: a null text is empty and has size 0; null sources form one source, behind all others; sources
without words have target 0; repeated rows and null ids are numbered like others; an empty table gives an
empty result. Columns called like a result column are replaced, `emit` keeps all columns as they are.
"""

from __future__ import annotations

import math
import random

from pyspark.sql import DataFrame, Window, functions as F

from flowledger.llm.common import hash60, text_of, unwrapped, word_list, wrapped
from flowledger.operators.numbering import number_rows, stage

WEIGHTS = (1, 2, 3)  # fixed values of the contract, repeating
MAX_REPEAT = 3
SEED = 20240607

RESULT = ["size", "source_size", "target", "copies", "taken"]


def offset_of(seed: int) -> float:
    """The random offset in [0, 1), a multiple of 2^-16 so that whole numbers added to it stay exact."""
    return random.Random(seed).randrange(1 << 16) / (1 << 16)


def with_size(docs: DataFrame) -> DataFrame:
    return docs.withColumn("size", F.size(word_list(text_of("text"))).cast("bigint"))


def buckets_for(rows: int) -> int:
    return max(1, math.ceil(math.sqrt(rows) / 8))


def _source_key():
    """Sorts like the source, null last, and can be joined on."""
    return F.when(F.col("source").isNull(), F.lit("1")).otherwise(F.concat(F.lit("0"), F.col("source")))


def source_targets(sums: DataFrame) -> DataFrame:
    """(_source, source_size, target), written: one row per source, from (_source, source_size)."""
    sums = stage(sums)
    # sorted parts are written, then counted: no window over all sources
    numbered = number_rows(sums.orderBy("_source"), "_n")
    weights = F.array(*[F.lit(w) for w in WEIGHTS])
    weighted = stage(
        numbered.withColumn("weight", F.get(weights, F.pmod(F.col("_n") - 1, F.lit(len(WEIGHTS))).cast("int")))
    )
    cap = MAX_REPEAT * F.col("source_size")
    total = weighted.agg(F.sum("source_size")).first()[0] or 0
    level, closed_before = None, -1
    while True:  # each round closes the sources whose share is above their cap; the level only rises
        closed = F.lit(False) if level is None else F.col("weight") * F.lit(level) > cap
        row = weighted.agg(
            F.count_if(closed).alias("closed"),
            F.sum(F.when(closed, cap).otherwise(0)).alias("used"),
            F.sum(F.when(closed, 0).otherwise(F.col("weight"))).alias("open"),
        ).first()
        if row["closed"] == closed_before or not row["open"]:
            break
        closed_before = row["closed"]
        level = float(total - row["used"]) / float(row["open"])
    share = F.col("weight") * F.lit(level or 0.0)
    target = F.least(share, cap.cast("double"))
    return stage(weighted.select("_source", "source_size", target.alias("target")))


def mix(sized: DataFrame, seed: int = SEED) -> DataFrame:
    """`sized` (with `source`, `doc_id` and `size`) with the columns of `RESULT`."""
    n_buckets = buckets_for(sized.count())
    cell = ["_source", "_class", "_bucket"]
    placed = sized.withColumns(
        {
            "_source": _source_key(),
            "_class": F.floor(F.sqrt(F.col("size").cast("double"))),
            "_bucket": F.pmod(hash60(F.col("doc_id")), F.lit(n_buckets)),
        }
    )
    cells = stage(placed.groupBy(*cell).agg(F.count("*").alias("_rows"), F.sum("size").alias("_words")))
    targets = source_targets(cells.groupBy("_source").agg(F.sum("_words").alias("source_size")))
    in_class = Window.partitionBy("_source", "_class").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    in_source = Window.partitionBy("_source").orderBy("_class").rowsBetween(Window.unboundedPreceding, -1)
    classes = cells.groupBy("_source", "_class").agg(F.sum("_rows").alias("_rows"))

    def prior(window):
        return F.coalesce(F.sum("_rows").over(window), F.lit(0))

    class_start = classes.select("_source", "_class", prior(in_source).alias("_class_start"))
    starts = (
        cells.withColumn("_start", prior(in_class))
        .join(class_start, ["_source", "_class"])
        .join(targets, "_source")
        .select(*cell, (F.col("_start") + F.col("_class_start")).alias("_start"), "source_size", "target")
    )
    numbered = placed.join(starts, cell).withColumn(
        "_k",
        F.col("_start")
        + F.row_number().over(Window.partitionBy(*cell).orderBy("size", F.col("doc_id").asc_nulls_last())),
    )
    rate = F.coalesce(F.try_divide(F.col("target"), F.col("source_size").cast("double")), F.lit(0.0))
    offset = F.lit(offset_of(seed))
    crossed = F.floor(offset + F.col("_k") * rate) - F.floor(offset + (F.col("_k") - 1) * rate)
    copies = F.least(crossed, F.lit(MAX_REPEAT).cast("bigint"))  # against rounding only
    return (
        numbered.withColumn("copies", copies)
        .withColumn("taken", F.col("copies") * F.col("size"))
        .drop(*cell, "_start", "_k")
    )


def mix_sizes(docs: DataFrame, seed: int = SEED) -> DataFrame:
    """How often every document id is taken, without moving any text."""
    sized = stage(with_size(docs.select("doc_id", "source", "text")).drop("text"))
    return mix(sized, seed).select("doc_id", *RESULT)


def emit(docs: DataFrame, seed: int = SEED) -> DataFrame:
    """The mix itself: every document as often as it is taken, with its own columns only."""
    # sizes are counted in both passes over the texts: cheaper than writing the texts once more
    sized = with_size(wrapped(docs, "doc_id", "source", "text")).drop("text")
    mixed = mix(sized, seed).where("copies > 0")
    each = mixed.select("row", F.explode(F.sequence(F.lit(1).cast("bigint"), "copies")))
    return unwrapped(each)


ORACLE_SQL = f"""
WITH sized AS (
  SELECT doc_id, source,
    CAST(len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS BIGINT) AS size
  FROM documents
), sums AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
    1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % {len(WEIGHTS)} AS weight
  FROM sized GROUP BY source
), ranked AS (
  SELECT *, coalesce(sum({MAX_REPEAT} * source_size) OVER before, 0) AS used,
    (SELECT sum(weight) FROM sums) - coalesce(sum(weight) OVER before, 0) AS open
  FROM sums
  WINDOW before AS (ORDER BY CAST(source_size AS DOUBLE) / weight, source NULLS LAST
                    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), level AS (
  -- closing sources from the smallest room on raises the level until all others have room, then lowers it
  SELECT max(CAST((SELECT sum(size) FROM sized) - used AS DOUBLE) / CAST(open AS DOUBLE)) AS level
  FROM ranked
), targets AS (
  SELECT source, source_size,
    least(weight * (SELECT level FROM level), CAST({MAX_REPEAT} * source_size AS DOUBLE)) AS target
  FROM sums
), placed AS (
  SELECT *, CAST(floor(sqrt(CAST(size AS DOUBLE))) AS BIGINT) AS class,
    CAST('0x' || substr(md5(CAST(doc_id AS VARCHAR)), 1, 15) AS BIGINT)
      % CAST(greatest(1, ceil(sqrt((SELECT count(*) FROM documents)) / 8)) AS BIGINT) AS bucket
  FROM sized
), numbered AS (
  SELECT p.doc_id, p.size, t.source_size, t.target,
    row_number() OVER (PARTITION BY p.source ORDER BY class, bucket, p.size, p.doc_id) AS k,
    CASE WHEN t.source_size > 0 THEN t.target / CAST(t.source_size AS DOUBLE) ELSE 0 END AS rate
  FROM placed p JOIN targets t ON p.source IS NOT DISTINCT FROM t.source
)
SELECT doc_id, size, source_size, target,
  CAST(least(floor({offset_of(SEED)!r} + k * rate) - floor({offset_of(SEED)!r} + (k - 1) * rate),
             {MAX_REPEAT}) AS BIGINT) * size AS taken
FROM numbered
"""
