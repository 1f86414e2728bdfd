"""Exact top-k search by inner product: columnar branch and bound.

Vectors are packed into blocks that store one dimension after the other. A block of queries meets every
block of candidates in a tile of its own, so a task holds two blocks, whatever the table's size. In a
tile, each query adds up its products dimension group by dimension group, the groups of its largest mass
first. After each group the score of a candidate lies within the partial sum plus or minus the product of
the two remaining masses (the norms of what has not been added yet, by Cauchy and Schwarz); candidates
whose upper bound is below the k-th best lower bound are compacted away. A tile returns at most k rows a
query, of which the best k over all tiles are kept.

Components count as floor(SCALE * x), sums are integers and exact.

Edge cases: vectors that are null or hold a null or non-finite component take no part; shorter vectors
are filled up with zeros; ties go to the smaller id, null ids last; a repeated row is a candidate of its
own and a query of its own (only the query's own row is left out); fewer candidates give fewer rows;
components and scores beyond 64 bits are set to the nearest 64-bit number, before scores are compared;
other columns are not used.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from flowledger.operators.numbering import number_rows, stage

SCALE = 256
TOP = 5
QUERY_EVERY = 50
BLOCK_ROWS = 4096
QUERY_BLOCK_ROWS = 512
GROUP = 8  # dimensions added between two prunings
_EXACT = 1 << 52  # whole numbers up to here are exact in floating point
_LONG = np.iinfo(np.int64)

_BLOCK = "block bigint, n bigint, dims bigint, width bigint, ids binary, no_id binary, cells binary"
_QUERIES = "own bigint, place bigint, id bigint, cells array<bigint>"
_FOUND = "own bigint, place bigint, query_id bigint, vec_id bigint, score bigint"


# --- blocks -------------------------------------------------------------------------------------------


def _largest(cells: np.ndarray) -> int:
    """The largest magnitude; the smallest whole number of 64 bits has none, its complement is one less."""
    return max(int(cells.max(initial=0)), ~int(cells.min(initial=0)) + 1)


def _packed(rows: list[np.ndarray], ids: list, block: int) -> dict:
    """Vectors of a block, one dimension after the other, in the narrowest whole numbers that hold them."""
    dims = max((len(r) for r in rows), default=0)
    cells = np.zeros((dims, len(rows)), np.int64)
    for i, row in enumerate(rows):
        cells[: len(row), i] = row
    width = next(w for w in (2, 4, 8) if w == 8 or _largest(cells) < 1 << (8 * w - 2))
    return {
        "block": block,
        "n": len(rows),
        "dims": dims,
        "width": width,
        "ids": np.array([0 if i is None else i for i in ids], np.int64).tobytes(),
        "no_id": np.array([i is None for i in ids], bool).tobytes(),
        "cells": cells.astype(f"<i{width}").tobytes(),
    }


def _unpacked(row: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Ids, which of them are null, and cells (dimensions x rows)."""
    cells = np.frombuffer(row["cells"], f"<i{row['width']}").reshape(row["dims"], row["n"])
    return np.frombuffer(row["ids"], np.int64), np.frombuffer(row["no_id"], bool), cells


def _blocks(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    from pyspark import TaskContext

    block = TaskContext.get().partitionId() << 33
    for batch in batches:
        cells, ids = batch.column("cells"), batch.column("id").to_pylist()
        for at in range(0, batch.num_rows, size):
            rows = [np.asarray(c.values, np.int64) for c in cells.slice(at, size)]
            yield pa.RecordBatch.from_pylist([_packed(rows, ids[at : at + size], block)])
            block += 1


def whole_vectors(vectors: DataFrame, ids: str, column: str) -> DataFrame:
    """(id, cells) of the vectors that take part."""
    finite = F.forall(
        column, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != F.lit(float("inf")))
    )
    whole = F.transform(column, lambda x: F.floor(F.lit(SCALE) * x.cast("double")))
    kept = vectors.where(F.col(column).isNotNull()).where(finite)
    return kept.select(F.col(ids).cast("bigint").alias("id"), whole.cast("array<bigint>").alias("cells"))


def _as_blocks(vectors: DataFrame, size: int) -> DataFrame:
    return vectors.mapInArrow(lambda b: _blocks(b, size), _BLOCK)


def _query_rows(batches: Iterator[pa.RecordBatch], every: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in batch.to_pylist():
            ids, no_id, cells = _unpacked(row)
            found = [
                {"own": row["block"], "place": int(i), "id": int(ids[i]), "cells": cells[:, i].tolist()}
                for i in np.flatnonzero(~no_id & (ids % every == 0))
            ]
            if found:
                yield pa.RecordBatch.from_pylist(found)


# --- search in one tile -------------------------------------------------------------------------------


def best_of(query: np.ndarray, cells: np.ndarray, tie: np.ndarray, skip: int, k: int) -> tuple:
    """Places and scores of the k best columns of `cells` (ties to smaller `tie`), without column `skip`."""
    dims, n = max(len(query), len(cells)), cells.shape[1]
    alive = np.flatnonzero(np.arange(n) != skip)
    q = np.zeros(dims, np.int64)
    q[: len(query)] = query
    bound = _largest(q) * _largest(cells) * dims
    if bound >= _EXACT:  # rare: plain whole numbers of any size
        sums = (sum(int(a) * int(b) for a, b in zip(q, cells[:, i])) for i in alive)
        whole = [min(max(s, _LONG.min), _LONG.max) for s in sums]
        order = sorted(range(len(alive)), key=lambda i: (-whole[i], tie[alive[i]]))[:k]
        return alive[order], np.array([whole[i] for i in order], np.int64)
    groups = [slice(at, min(at + GROUP, len(cells))) for at in range(0, len(cells), GROUP)]
    masses = np.array([np.square(q[g].astype(float)).sum() for g in groups])
    order = np.argsort(-masses, kind="stable")
    q_left = masses.sum()
    left = np.square(cells.astype(float)).sum(axis=0)[alive]
    score = np.zeros(len(alive))
    for g in order:
        part = cells[groups[g]][:, alive].astype(float)
        score += q[groups[g]].astype(float) @ part
        q_left = max(q_left - masses[g], 0.0)
        left -= np.square(part).sum(axis=0)
        if len(alive) <= k:
            continue
        slack = np.sqrt(q_left * np.maximum(left, 0.0)) * (1 + 1e-9)
        least = np.partition(score - slack, len(alive) - k)[len(alive) - k]
        keep = score + slack >= least - 0.5  # scores are whole: half a unit covers rounding
        if not keep.all():
            alive, score, left = alive[keep], score[keep], left[keep]
    best = np.lexsort((tie[alive], -score))[:k]
    return alive[best], score[best].astype(np.int64)


def _search(batches: Iterator[pa.RecordBatch], k: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for tile in batch.to_pylist():
            ids, no_id, cells = _unpacked(tile)
            tie = np.where(no_id, _LONG.max, ids)
            out = []
            for query in tile["queries"]:
                skip = query["place"] if query["own"] == tile["block"] else -1
                at, scores = best_of(np.array(query["cells"], np.int64), cells, tie, skip, k)
                out += [
                    {
                        "own": query["own"],
                        "place": query["place"],
                        "query_id": query["id"],
                        "vec_id": None if no_id[i] else int(ids[i]),
                        "score": int(s),
                    }
                    for i, s in zip(at, scores, strict=True)
                ]
            if out:
                yield pa.RecordBatch.from_pylist(
                    out, pa.schema([(c, pa.int64()) for c in out[0]])
                )


def top_k(
    vectors: DataFrame,
    k: int = TOP,
    every: int = QUERY_EVERY,
    ids: str = "vec_id",
    column: str = "embedding",
    block_rows: int = BLOCK_ROWS,
    query_rows: int = QUERY_BLOCK_ROWS,
) -> DataFrame:
    """(query_id, rank, vec_id, score) for every vector whose id is divisible by `every`."""
    blocks = stage(_as_blocks(whole_vectors(vectors, ids, column), block_rows))
    rows = number_rows(blocks.mapInArrow(lambda b: _query_rows(b, every), _QUERIES), "number")
    queries = stage(
        rows.groupBy(F.floor((F.col("number") - 1) / query_rows).alias("query_block")).agg(
            F.collect_list(F.struct("own", "place", "id", "cells")).alias("queries")  # <= query_rows
        )
    )
    # every query block meets every block in a tile; both sides are dealt out by the tile's key
    n = queries.count()
    numbers = F.sequence(F.lit(0).cast("bigint"), F.lit(n - 1).cast("bigint")) if n else F.array().cast("array<bigint>")
    keys = blocks.select("block", F.explode(numbers).alias("query_block"))
    dealt = queries.join(keys, "query_block")
    tiles = blocks.withColumn("query_block", F.explode(numbers))
    met = tiles.join(dealt, ["block", "query_block"])
    found = met.mapInArrow(lambda b: _search(b, k), _FOUND)
    order = Window.partitionBy("own", "place").orderBy(F.desc("score"), F.col("vec_id").asc_nulls_last())
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")


ORACLE_SQL = f"""
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor({SCALE} * CAST(x AS DOUBLE))) AS e
  FROM embeddings
  WHERE embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.e, c.e) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % {QUERY_EVERY} = 0
), ranked AS (
  SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER)
    AS rank, vec_id, score
  FROM scored
)
SELECT * FROM ranked WHERE rank <= {TOP}
"""
