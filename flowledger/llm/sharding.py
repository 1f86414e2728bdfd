"""Sharding by extendible hashing.

Every document has a string of hash bits. The directory is a binary tree over prefixes of it: the root
holds all documents, and only a bucket above the byte limit is split, on one more bit, until every shard
fits. A shard is called by its prefix.

Bytes are summed once per cell (a prefix a few bits longer than the shards are expected to need) and
rolled up to all shorter prefixes, so all splits of a round are decided in one aggregation instead of a
pass for each bit; only cells that are still too large go on to a round with longer prefixes. Since the
bytes of a prefix never exceed those of a shorter one, the depth of a shard is the number of split
buckets above it.

The bits are 60 of the MD5 of the id, then 60 of the row's place, which are only reached by rows that
share an id and would not fit into one shard. A document larger than the limit is a shard of its own.

Everything is DataFrame and SQL functions; texts are read for their length only.

Edge cases: a null text has 0 bytes; null ids hash like an empty id; repeated rows are rows of their own;
an empty table gives no shards; other columns pass, those called like a result column are replaced.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, functions as F

from flowledger.llm.common import hash60, text_of, unwrapped, wrapped
from flowledger.operators.numbering import stage

SHARD_BYTES = 8 << 20  # most UTF-8 bytes of text in a shard
SPARE_BITS = 3  # bits of a cell beyond those an even spread would need
ROUND_BITS = 12  # further bits of each later round
ALL_BITS = 120

RESULT = ["n_bytes", "shard", "shard_bytes"]


def _bits(number):
    return F.lpad(F.bin(number), 60, "0")


def with_bits(docs: DataFrame) -> DataFrame:
    """Add the bytes of the text and the hash bits."""
    place = hash60(F.monotonically_increasing_id())
    return docs.withColumns(
        {
            "n_bytes": F.octet_length(text_of("text")).cast("bigint"),
            "_bits": F.concat(_bits(hash60(F.col("doc_id"))), _bits(place)),
        }
    )


def assign(rows: DataFrame, limit: int = SHARD_BYTES) -> DataFrame:
    """Written rows with `n_bytes` and `_bits`, each with its shard and the bytes in it."""
    total = rows.agg(F.sum("n_bytes")).first()[0] or 0
    first, depth = 0, min(ALL_BITS, math.ceil(math.log2(max(total / limit, 1))) + SPARE_BITS)
    split, parts = None, []
    while True:
        in_cell = rows.withColumn("_cell", F.substring("_bits", 1, depth))
        cells = stage(in_cell.groupBy("_cell").agg(F.sum("n_bytes").alias("bytes"), F.count("*").alias("n")))
        above = F.transform(
            F.sequence(F.lit(first), F.lit(depth)), lambda d: F.substring(F.col("_cell"), F.lit(1), d)
        )
        nodes = cells.select(F.explode(above).alias("prefix"), "bytes", "n")
        nodes = nodes.groupBy("prefix").agg(F.sum("bytes").alias("bytes"), F.sum("n").alias("n"))
        over = stage(nodes.where((F.col("bytes") > limit) & (F.col("n") > 1)).select("prefix"))
        split = over if split is None else split.unionByName(over)
        deep = over.where(F.length("prefix") == depth).withColumnRenamed("prefix", "_cell")
        done = depth >= ALL_BITS or deep.isEmpty()
        if done:
            parts.append((in_cell, cells))
            break
        parts.append((in_cell.join(deep, "_cell", "left_anti"), cells.join(deep, "_cell", "left_anti")))
        rows = stage(in_cell.join(deep, "_cell", "left_semi").drop("_cell"))
        first, depth = depth + 1, min(ALL_BITS, depth + ROUND_BITS)

    def shards(cells):
        above = F.transform(
            F.sequence(F.lit(0), F.length("_cell")), lambda d: F.substring(F.col("_cell"), F.lit(1), d)
        )
        paths = cells.select("_cell", F.explode(above).alias("prefix")).join(split, "prefix")
        depths = paths.groupBy("_cell").agg(F.count("*").cast("int").alias("_depth"))
        at = F.least(F.coalesce("_depth", F.lit(0)), F.length("_cell"))
        return cells.join(depths, "_cell", "left").select(
            "_cell", "bytes", F.substring(F.col("_cell"), F.lit(1), at).alias("shard")
        )

    placed = [(rows, shards(cells)) for rows, cells in parts]
    sums = [s.select("shard", "bytes") for _, s in placed]
    found = [r.join(s.drop("bytes"), "_cell").drop("_cell") for r, s in placed]
    all_sums, all_found = sums[0], found[0]
    for s, f in zip(sums[1:], found[1:], strict=True):
        all_sums, all_found = all_sums.unionByName(s), all_found.unionByName(f)
    directory = all_sums.groupBy("shard").agg(F.sum("bytes").alias("shard_bytes"))
    return all_found.join(directory, "shard").drop("_bits")


def shard(docs: DataFrame, limit: int = SHARD_BYTES) -> DataFrame:
    """`docs` with the columns of `RESULT`; the rows are written once on the way."""
    rows = with_bits(wrapped(docs, "doc_id", "text")).drop("text", "doc_id")
    return unwrapped(assign(stage(rows), limit), *RESULT)


def shard_sizes(docs: DataFrame, limit: int = SHARD_BYTES) -> DataFrame:
    """Shard of every document id, without moving any text."""
    rows = with_bits(docs.select("doc_id", "text")).drop("text")
    return assign(stage(rows), limit).select("doc_id", *RESULT)


def write_shards(docs: DataFrame, path: str, limit: int = SHARD_BYTES) -> None:
    """Write the documents as Parquet, one folder `shard=<prefix>` for each shard."""
    sharded = shard(docs, limit)
    sharded.repartition("shard").write.partitionBy("shard").parquet(path)


def oracle_sql(limit: int = SHARD_BYTES) -> str:
    return f"""
WITH rows AS (
  SELECT doc_id, CAST(strlen(coalesce(text, '')) AS BIGINT) AS n_bytes,
    lpad(bin(CAST('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '')), 1, 15) AS BIGINT)), 60, '0')
      AS bits
  FROM documents
), nodes AS (
  SELECT left(bits, d) AS prefix, sum(n_bytes) AS bytes, count(*) AS n
  FROM rows, generate_series(0, 60) AS t(d) GROUP BY ALL
), placed AS (
  SELECT r.doc_id, r.n_bytes, r.bits,
    (SELECT count(*) FROM nodes x
     WHERE x.bytes > {limit} AND x.n > 1 AND starts_with(r.bits, x.prefix)) AS depth
  FROM rows r
)
SELECT p.doc_id, p.n_bytes, left(p.bits, p.depth) AS shard, CAST(x.bytes AS BIGINT) AS shard_bytes
FROM placed p JOIN nodes x ON x.prefix = left(p.bits, p.depth)
"""
