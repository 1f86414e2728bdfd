"""Merkle manifest of a dataset: a hash tree per source, stored block by block in van Emde Boas layout.

A document's leaf is the SHA-256 of its fields. Per source, leaves ascend by document id; while there are
several nodes, every `FAN` consecutive ones (the last run may be shorter) are hashed into one. The roots of
the sources, ordered by source, are hashed likewise into the root of the dataset.

Storage and work follow the van Emde Boas order. A tree is cut at half its height into a top and, below
each of the top's leaves, bottom trees; the top comes first, then the bottom trees from left to right, each
laid out in the same way, down to single nodes. Two things come from that:

* Across the cluster the outermost cut makes aligned blocks of `BLOCK` = `FAN` ** `HEIGHT` leaves. A block
  is one row of a Parquet table, built and read by itself, so a source that holds most documents is spread
  over as many tasks as it has blocks. The roots of the blocks are the leaves of the next table, and so on
  until each source has one block; the trees over source roots are built the same way.
* Inside a block all nodes are one array in that order. Where a node lies is computed from (leaves, height,
  level, index) alone, without pointers or knowledge of any cache or page size; only the last tree of a
  level can be incomplete, so sizes of the trees before it are known. Construction writes each level to
  its addresses, and a proof reads the siblings of a path from theirs.

A proof is the path from leaf to root: per level the place in its run, and the digests of the others.

Edge cases: a null field is hashed as `-`, so it differs from an empty one; null sources are a source of
their own, before all others; null ids come first in their source; rows of equal id are ordered by their
leaf (equal leaves are interchangeable); texts of any length are hashed whole; repeated rows are leaves of
their own; an empty table has no root and no proofs; other columns, whatever their names, are not hashed.
Rows with a null id are never tampered with by `tampered`.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from flowledger.llm.common import Steps, crc32_sql
from flowledger.operators.numbering import PLACE, number_rows, number_within_files, with_place

FAN = 16  # nodes that are hashed into one
HEIGHT = 3  # levels of hashing in a block
BLOCK = FAN**HEIGHT  # leaves of a block
FIELDS = ["doc_id", "source", "lang", "n_chars", "text"]  # fixed order of the contract
TAMPERED_IDS = 5  # rows whose id's checksum this divides are tampered with

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_SOURCES = ""  # key of the trees over sources
ROWS = 8  # blocks a worker unpacks at a time
_STEP = pa.struct([("place", pa.int32()), ("others", pa.binary())])
_ANSWER = pa.struct([("proof", pa.binary()), ("folded", pa.binary())])
STEP = "struct<place:int,others:binary>"


# --- addresses -----------------------------------------------------------------------------------------


def ceil_div(a, b):
    return -(-a // b)


def height_of(leaves: int) -> int:
    """Levels of hashing above `leaves` nodes until one remains."""
    height = 0
    while leaves > 1:
        leaves, height = ceil_div(leaves, FAN), height + 1
    return height


def n_nodes(leaves, height):
    """Nodes of a tree over `leaves` leaves (numbers or arrays) with `height` levels of hashing."""
    return sum(ceil_div(leaves, FAN**level) for level in range(height + 1))


def addresses(leaves: int, height: int, level: int, index: np.ndarray) -> np.ndarray:
    """Where the nodes of a level (0: leaves) lie in the layout of a tree."""
    at = np.zeros(len(index), np.int64)
    index, leaves = index.astype(np.int64), np.full(len(index), leaves, np.int64)
    while height > 0:
        low = (height + 1) // 2  # levels of the bottom trees; the levels above are the top
        tops = ceil_div(leaves, FAN**low)
        if level >= low:
            leaves, height, level = tops, height - low, level - low
            continue
        width = FAN ** (low - 1)  # leaves of a complete bottom tree
        tree = index // FAN ** (low - 1 - level)
        at += n_nodes(tops, height - low) + tree * n_nodes(width, low - 1)
        index = index - tree * FAN ** (low - 1 - level)
        leaves, height = np.minimum(width, leaves - tree * width), low - 1
    return at


# --- one block -----------------------------------------------------------------------------------------


def digest_of(children: bytes) -> bytes:
    """Digest of a run of nodes, whose digests are 32 bytes each; they are hashed as hexadecimal text."""
    return hashlib.sha256(children.hex().encode()).digest()


def build_block(leaves: bytes, height: int) -> bytes:
    """All nodes of a tree over a run of leaf digests, in van Emde Boas order. The root comes first."""
    n = len(leaves) // 32
    nodes = np.empty((n_nodes(n, height), 32), np.uint8)
    below = leaves
    for level in range(height + 1):
        if level:
            below = b"".join(digest_of(below[a : a + 32 * FAN]) for a in range(0, len(below), 32 * FAN))
        count = len(below) // 32
        nodes[addresses(n, height, level, np.arange(count))] = np.frombuffer(below, np.uint8).reshape(count, 32)
    return nodes.tobytes()


def siblings(nodes: np.ndarray, leaves: int, height: int, index: int) -> Iterator[tuple[int, bytes]]:
    """(place in its run, digests of the others) on the way from a leaf to the root of its block.

    Reads only the nodes of the path's runs."""
    count = leaves
    for level in range(height):
        first = index // FAN * FAN
        run = np.arange(first, min(first + FAN, count))
        others = addresses(leaves, height, level, run[run != index])
        yield index - first, nodes[others].tobytes()
        index, count = index // FAN, ceil_div(count, FAN)


def all_siblings(nodes: np.ndarray, leaves: int, height: int) -> list[list[tuple[int, bytes]]]:
    """The same for every leaf of a block: each level is fetched by its addresses once."""
    paths: list[list[tuple[int, bytes]]] = [[] for _ in range(leaves)]
    count, span = leaves, 1
    for level in range(height):
        row = nodes[addresses(leaves, height, level, np.arange(count))].tobytes()
        for i in range(count):
            first = i // FAN * FAN
            run = row[32 * first : 32 * (first + FAN)]
            place = i - first
            step = (place, run[: 32 * place] + run[32 * place + 32 :])
            for leaf in range(i * span, min((i + 1) * span, leaves)):
                paths[leaf].append(step)
        count, span = ceil_div(count, FAN), span * FAN
    return paths


def fold(leaf: bytes, path: list[tuple[int, bytes]]) -> bytes:
    """The root that a leaf and the others on its path give."""
    for place, others in path:
        leaf = digest_of(others[: 32 * place] + leaf + others[32 * place :])
    return leaf


def digest_of_path(path: list[tuple[int, bytes]]) -> bytes:
    """Digest of all others of a path, from the leaf's run to the root's, left to right."""
    return hashlib.sha256(b"".join([others for _, others in path]).hex().encode()).digest()


def _nodes(data: bytes) -> np.ndarray:
    return np.frombuffer(data, np.uint8).reshape(-1, 32)


# --- tables of blocks ----------------------------------------------------------------------------------


def field(value: Column) -> Column:
    """A value as it is hashed: its length in bytes and its text, or `-`."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf(text: Column | None = None) -> Column:
    """Leaf digest (32 bytes) of a document; `text` stands for its text, if given."""
    values = [F.col(c) if text is None or c != "text" else text for c in FIELDS]
    return F.unhex(F.sha2(F.concat(*[field(v) for v in values]).cast("binary"), 256))


def source_key() -> Column:
    """Text that orders sources by their bytes, null first; none is equal to `_SOURCES`."""
    return F.coalesce(F.concat(F.lit("="), "source"), F.lit("-"))


def tampered() -> Column:
    """Whether a row is tampered with in the check of proofs."""
    chosen = F.crc32(F.col("doc_id").cast("string").cast("binary")) % TAMPERED_IDS == 0
    return F.coalesce(chosen, F.lit(False))


def _lazily(kind: str):
    """An Arrow UDF that is made when it is first used: types in text need a session."""

    def decorate(function):
        return lambda *columns: F.arrow_udf(function, kind)(*columns)

    return decorate


def _rows(columns: Iterator[tuple[pa.Array, ...]]) -> Iterator[list[tuple]]:
    """Rows of Arrow columns as Python values, a few at a time."""
    for batch in columns:
        for at in range(0, len(batch[0]), ROWS):
            yield list(zip(*[c.slice(at, ROWS).to_pylist() for c in batch], strict=True))


@_lazily("binary")
def _built(columns: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
    for rows in _rows(columns):
        yield pa.array([build_block(b"".join(leaves), height) for leaves, height in rows], pa.binary())


@_lazily(f"array<array<{STEP}>>")
def _paths(columns: Iterator[tuple[pa.Array, pa.Array, pa.Array, pa.Array]]) -> Iterator[pa.Array]:
    """The paths of a block's leaves up to the root of all, given the block's own path."""
    for rows in _rows(columns):
        for nodes, n, height, above in rows:
            paths = all_siblings(_nodes(nodes), n, height)
            found = [[{"place": p, "others": o} for p, o in path] + above for path in paths]
            yield pa.array([found], pa.list_(pa.list_(_STEP)))


@_lazily("array<struct<proof:binary,folded:binary>>")
def _answers(
    columns: Iterator[tuple[pa.Array, pa.Array, pa.Array, pa.Array, pa.Array]],
) -> Iterator[pa.Array]:
    """Per leaf of a block the digest of its path, and the root its candidate folds to."""
    for rows in _rows(columns):
        for nodes, n, height, above, candidates in rows:
            rest = [(s["place"], s["others"]) for s in above]
            paths = all_siblings(_nodes(nodes), n, height)
            found = [
                {"proof": digest_of_path(path + rest), "folded": fold(candidate, path + rest)}
                for path, candidate in zip(paths, candidates, strict=True)
            ]
            yield pa.array([found], pa.list_(_ANSWER))


@_lazily("binary")
def _folded(columns: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
    for rows in _rows(columns):
        yield pa.array([fold(leaf, [(s["place"], s["others"]) for s in path]) for leaf, path in rows], pa.binary())


def folded(leaf: str, path: str) -> Column:
    """The root that a leaf gives on a path of `proofs`: equal to the manifest's if nothing was changed."""
    return _folded(leaf, path)


def _blocks(numbered: DataFrame, *carried: str) -> DataFrame:
    """Blocks of numbered leaves (key, number, leaf): one row each, with its tree in `nodes`."""
    placed = numbered.select(
        "key",
        F.call_function("div", F.col("number"), F.lit(BLOCK)).alias("block"),
        F.struct((F.col("number") % BLOCK).cast("int").alias("place"), "leaf", *carried).alias("row"),
    )
    rows = placed.groupBy("key", "block").agg(F.sort_array(F.collect_list("row")).alias("rows"))  # <= BLOCK
    # a key's only block is as high as its leaves need; all blocks of a larger key have the same height
    height = F.when(F.col("block") > 0, F.lit(HEIGHT))
    for levels in range(HEIGHT):
        height = height.when(F.size("rows") <= FAN**levels, F.lit(levels))
    sized = rows.select("*", F.size("rows").alias("leaves"), height.otherwise(F.lit(HEIGHT)).alias("height"))
    return sized.withColumn("nodes", _built("rows.leaf", "height"))


def _root() -> Column:
    return F.substring("nodes", 1, 32)


def _roots(blocks: DataFrame) -> DataFrame:
    """Roots of blocks as the leaves of the next table."""
    return blocks.select("key", F.col("block").alias("number"), _root().alias("leaf"))


def _up(steps: Steps, blocks: DataFrame) -> list[DataFrame]:
    """The written table of these blocks and tables over their roots, until each key has one block."""
    layers = [steps.stage(blocks)]
    while not layers[-1].where("block > 0").isEmpty():
        layers.append(steps.stage(_blocks(_roots(layers[-1]))))
    return layers


class Manifest:
    """The trees over a dataset, in tables of blocks: `documents` from the documents up to one block per
    source, `sources` from those blocks' roots up to the block that holds the root of all."""

    def __init__(self, steps: Steps, documents: list[DataFrame], sources: list[DataFrame], keys: DataFrame):
        self.steps, self.documents, self.sources, self.keys = steps, documents, sources, keys

    @property
    def root(self) -> bytes | None:
        """Root of the dataset; None if it is empty."""
        top = self.sources[-1].select(_root()).first()
        return bytes(top[0]) if top else None

    def subroots(self) -> DataFrame:
        """(key, subroot) of every source."""
        return _roots(self.documents[-1]).select("key", F.col("leaf").alias("subroot"))

    def _down(self, blocks: DataFrame) -> DataFrame:
        """Leaves of blocks (number, path to the root); `blocks` have their own path in `path`."""
        paths = F.posexplode(_paths("nodes", "leaves", "height", "path")).alias("at", "path")
        leaves = blocks.select("key", "block", F.col("rows.leaf").alias("own"), "subroot", "root", paths)
        number = (F.col("block") * BLOCK + F.col("at")).alias("number")
        return leaves.select("key", number, F.get("own", F.col("at")).alias("leaf"), "subroot", "root", "path")

    def with_paths(self) -> DataFrame:
        """The documents' blocks with the path of each to the root of all, the source's root and that root."""
        top = self.sources[-1].select(
            "*", F.array().cast(f"array<{STEP}>").alias("path"), F.lit(None).cast("binary").alias("subroot")
        )
        blocks = top.withColumn("root", _root())
        for table in reversed(self.sources[:-1]):
            above = self._down(blocks).withColumnRenamed("number", "block").drop("leaf")
            blocks = table.join(self.steps.stage(above), ["key", "block"])
        above = self._down(blocks).drop("key", "subroot").withColumnRenamed("leaf", "subroot")
        above = above.join(self.keys, "number").select("key", "path", "subroot", "root")
        blocks = self.documents[-1].join(self.steps.stage(above), "key")
        for table in reversed(self.documents[:-1]):
            above = self._down(blocks).withColumnRenamed("number", "block").drop("leaf")
            blocks = table.join(self.steps.stage(above), ["key", "block"])
        return blocks

    def proofs(self) -> DataFrame:
        """Every document's id, carried columns, leaf, path to the root, its source's root and the root."""
        found = self.with_paths().withColumn("paths", _paths("nodes", "leaves", "height", "path"))
        each = found.select("subroot", "root", F.explode(F.arrays_zip("rows", "paths")).alias("x"))
        return each.select("x.rows.*", F.col("x.paths").alias("path"), "subroot", "root").drop("place")

    def answers(self, candidate: str) -> DataFrame:
        """The same with, in place of the path, its digest `proof` and the root `folded` that the carried
        column `candidate` gives in place of the leaf. No path leaves the task that reads it."""
        answers = _answers("nodes", "leaves", "height", "path", f"rows.{candidate}")
        found = self.with_paths().withColumn("found", answers)
        each = found.select("subroot", "root", F.explode(F.arrays_zip("rows", "found")).alias("x"))
        return each.select("x.rows.*", "x.found.*", "subroot", "root").drop("place")


def manifest(docs: DataFrame, **carried: Column) -> Manifest:
    """Build the trees over `docs` (columns of `FIELDS`); `carried` columns stay beside the leaves."""
    spark = docs.sparkSession
    kept, passing = Steps(spark), Steps(spark)
    leaves = docs.select(
        source_key().alias("key"),
        F.col("doc_id").cast("bigint").alias("doc_id"),
        leaf().alias("leaf"),
        *[column.alias(name) for name, column in carried.items()],
    )
    # written with a place first: sampled, sorted and retried tasks all see the same rows
    placed = passing.stage(with_place(leaves))
    order = [F.col("key").asc(), F.col("doc_id").asc_nulls_first(), F.col("leaf").asc(), F.col(PLACE).asc()]
    ordered = placed.repartitionByRange(*order).sortWithinPartitions(*order).drop(PLACE)
    in_part = ordered.withColumn("part", F.spark_partition_id())
    numbered = number_within_files(in_part, "key", "part", "number", passing.stage)
    numbered = numbered.withColumn("number", F.col("number") - 1)
    documents = _up(kept, _blocks(numbered, "doc_id", *carried))
    subroots = _roots(documents[-1]).select("key", "leaf").orderBy("key")
    listed = kept.stage(number_rows(subroots, "number", -1, passing.stage))
    sources = _up(kept, _blocks(listed.withColumn("key", F.lit(_SOURCES))))
    passing.drop()
    return Manifest(kept, documents, sources, listed.select("number", "key"))


def checked_proofs(docs: DataFrame) -> DataFrame:
    """Leaf, roots and proof of every document, and what the proof says of rows some of which were
    tampered with after the manifest was made. Digests as lower-case hexadecimal text."""
    lowered = F.translate("text", _UPPER, _LOWER)
    candidate = F.when(tampered(), leaf(lowered)).otherwise(leaf())
    found = manifest(docs, candidate=candidate).answers("candidate")

    def text(name: str, out: str) -> Column:
        return F.lower(F.hex(name)).alias(out)

    return found.select(
        "doc_id",
        text("leaf", "leaf"),
        text("subroot", "subroot"),
        text("root", "root"),
        text("proof", "proof_sha256"),
        text("folded", "folded_root"),
        (F.col("folded") == F.col("root")).alias("verified"),
    )


def oracle_sql() -> str:
    def fields(text: str) -> str:
        names = [text if c == "text" else f"{c}::VARCHAR" for c in FIELDS]
        return ", ".join(f"coalesce(strlen({n}) || ':' || {n}, '-')" for n in names)

    checksum = crc32_sql("hex(encode(doc_id::VARCHAR))")
    lowered = f"translate(text, '{_UPPER}', '{_LOWER}')"
    return f"""
WITH RECURSIVE hashed AS (
  SELECT doc_id, coalesce('=' || source, '-') AS tree,
    sha256(concat({fields("text")})) AS leaf,
    CASE WHEN doc_id IS NOT NULL AND {checksum} % {TAMPERED_IDS} = 0 THEN sha256(concat({fields(lowered)})) ELSE sha256(concat({fields("text")})) END AS candidate
  FROM documents
), leaves AS (
  SELECT *, row_number() OVER (ORDER BY tree, doc_id NULLS FIRST, leaf) AS doc,
    row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos
  FROM hashed
), nodes AS (
  SELECT tree, 0 AS level, pos, leaf AS h, count(*) OVER (PARTITION BY tree) AS n FROM leaves
  UNION ALL
  SELECT tree, level + 1, pos // {FAN}, sha256(string_agg(h, '' ORDER BY pos)), (max(n) + {FAN} - 1) // {FAN}
  FROM nodes WHERE n > 1 GROUP BY tree, level, pos // {FAN}
), subroots AS (
  SELECT tree, h, row_number() OVER (ORDER BY tree) - 1 AS pos FROM nodes WHERE n = 1
), tops AS (
  SELECT '' AS tree, 0 AS level, pos, h, count(*) OVER () AS n FROM subroots
  UNION ALL
  SELECT tree, level + 1, pos // {FAN}, sha256(string_agg(h, '' ORDER BY pos)), (max(n) + {FAN} - 1) // {FAN}
  FROM tops WHERE n > 1 GROUP BY tree, level, pos // {FAN}
), parts AS (
  SELECT tree, level, pos // {FAN} AS run, list(h ORDER BY pos) AS run_nodes
  FROM (SELECT * FROM nodes UNION ALL SELECT * FROM tops) WHERE n > 1 GROUP BY ALL
), places AS (
  SELECT doc, tree, pos, 0 AS above FROM leaves
  UNION ALL
  SELECT doc, '', s.pos, 1 FROM leaves JOIN subroots s USING (tree)
), steps AS (
  SELECT doc, row_number() OVER (PARTITION BY doc ORDER BY above, level) AS step,
    array_to_string(run_nodes[1:place], '') AS before, array_to_string(run_nodes[place + 2:], '') AS after
  FROM (
    SELECT doc, above, level, run_nodes, (pos // power({FAN}, level)::BIGINT) % {FAN} AS place
    FROM places JOIN parts USING (tree)
    WHERE run = pos // power({FAN}, level + 1)::BIGINT
  )
), folded AS (
  SELECT doc, 0 AS step, candidate AS h FROM leaves
  UNION ALL
  SELECT doc, s.step, sha256(before || h || after) FROM folded f JOIN steps s USING (doc) WHERE s.step = f.step + 1
), proofs AS (
  SELECT doc, sha256(string_agg(before || after, '' ORDER BY step)) AS proof, max(step) AS last FROM steps GROUP BY doc
)
SELECT doc_id, leaf, s.h AS subroot, r.h AS root, coalesce(p.proof, sha256('')) AS proof_sha256,
  f.h AS folded_root, f.h = r.h AS verified
FROM leaves l JOIN subroots s USING (tree) JOIN tops r ON r.n = 1
LEFT JOIN proofs p USING (doc)
JOIN folded f ON f.doc = l.doc AND f.step = coalesce(p.last, 0)
"""
