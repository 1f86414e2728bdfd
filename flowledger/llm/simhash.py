"""SimHash near-duplicates, compared over vertically stored bit planes.

A document's fingerprint is the bitwise majority of the XXH64 values of its word shingles. Fingerprints
that differ in at most `radius` bits are linked; a component is what links connect.

* Candidates: the 64 bits are cut into `radius + 2` blocks. Two fingerprints within the radius agree on
  at least two blocks, so rows are dealt out once per pair of blocks, keyed by the bits of that pair
  (about 26 bits for radius 3). Nothing else can be linked, so the search is exact.
* Comparison: within a task the fingerprints are stored as 64 bit planes, one bit per row. Row i is
  compared with row i + d for all i at once: the planes are combined with themselves moved by d, a
  carry-save counter of a few bit vectors adds the differing bits plane by plane, and words of 64 rows
  are dropped as soon as every row in them has exceeded the radius.
* Only distinct fingerprints are compared, and a task returns a spanning forest (one row for each linked
  fingerprint), never all pairs of a group. A key with more than `TILE_ROWS` fingerprints is cut into
  tiles that are compared pair of tiles by pair of tiles in tasks of their own.
* Components: alternating large-star and small-star steps over the written links until nothing changes.

Edge cases: a null text counts as empty, and a text without words has fingerprint zero, linked like any
other; fewer words than a shingle are hashed as one sequence; repeated rows share fingerprint and
component; ids may repeat or be null (a component of null ids only has a null id); other columns pass.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from flowledger.llm.common import Steps, free_name
from flowledger.operators.numbering import stage

SHINGLE = 3  # words
RADIUS = 3  # bits
SEED = 42
TILE_ROWS = 4096  # most fingerprints of one key that are compared in one piece
CHUNK_ROWS = 1 << 16  # rows a task turns into bit planes at a time
PLANES_PER_TEST = 8  # planes added before words that are out of reach are dropped

_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
_BYTE_BITS = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little")
_BYTE_PLACE = np.arange(8, dtype=np.intp) * 256


# --- fingerprints -------------------------------------------------------------------------------------


def fingerprint(text: bytes, width: int = SHINGLE) -> int:
    """The fingerprint of one UTF-8 text as an unsigned number."""
    import xxhash

    words = text.translate(_LOWER).split()  # bytes.split() cuts at exactly \x20 and \x09-\x0D
    if not words:
        return 0
    hashed = partial(xxhash.xxh64_intdigest, seed=SEED)
    if len(words) <= width:
        return hashed(b" ".join(words))
    shingles = map(b" ".join, zip(*(words[i:] for i in range(width)), strict=False))
    total, counts = 0, np.zeros(64, np.int64)
    values = np.fromiter(map(hashed, shingles), np.uint64, len(words) - width + 1)
    for at in range(0, len(values), CHUNK_ROWS):
        part = values[at : at + CHUNK_ROWS]
        places = part.view(np.uint8).reshape(-1, 8) + _BYTE_PLACE
        seen = np.bincount(places.ravel(), minlength=2048).reshape(8, 256)
        counts += (seen @ _BYTE_BITS).ravel()
        total += len(part)
    bits = (2 * counts > total).astype(np.uint8)
    return int(np.packbits(bits, bitorder="little").view(np.uint64)[0])


def with_fingerprints(docs: DataFrame, out: str, width: int = SHINGLE) -> DataFrame:
    """`docs` with the fingerprint of `text` as a signed 64-bit number in column `out`."""

    @F.arrow_udf("bigint")
    def prints(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            found = np.fromiter(
                (fingerprint(x.as_py(), width) if x.is_valid else 0 for x in texts.cast(pa.binary())),
                np.uint64,
                len(texts),
            )
            yield pa.array(found.view(np.int64))

    return docs.withColumn(out, prints("text"))


# --- comparison ---------------------------------------------------------------------------------------


def _masks(radius: int) -> list[int]:
    """Bit masks of all pairs of blocks, as signed numbers."""
    edges = np.linspace(0, 64, radius + 3).astype(int)
    blocks = [((1 << int(b)) - 1) ^ ((1 << int(a)) - 1) for a, b in zip(edges, edges[1:], strict=False)]
    pairs = [x | y for x, y in combinations(blocks, 2)]
    return [m - (1 << 64) if m >> 63 else m for m in pairs]


def _words(bits: np.ndarray) -> np.ndarray:
    """Booleans as 64-bit words, lowest bit first, with one empty word behind."""
    out = np.zeros((len(bits) + 63) // 64 + 1, np.uint64)
    packed = np.packbits(bits, bitorder="little")
    out.view(np.uint8)[: len(packed)] = packed
    return out


def close_pairs(values: np.ndarray, ends: np.ndarray, radius: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Index pairs (i, j), i < j < ends[i], of values that differ in at most `radius` bits.

    One step for each distance j - i; all rows of a step are compared together over bit planes.
    """
    n = len(values)
    width = max(radius.bit_length(), 1)
    places = np.arange(64, dtype=np.uint64)
    planes = np.stack([_words(((values >> p) & np.uint64(1)).astype(bool)) for p in places])
    planes = np.concatenate([planes, np.zeros((64, 1), np.uint64)], axis=1)
    rows = np.arange(n)
    step = 0
    while True:
        step += 1
        rows = rows[rows + step < ends[rows]]
        if not len(rows):
            return
        active = np.zeros(n, bool)
        active[rows] = True
        alive = _words(active)
        blocks = np.flatnonzero(alive)
        alive = alive[blocks]
        jump, shift = divmod(step, 64)
        counter = [np.zeros(len(blocks), np.uint64) for _ in range(width)]
        for first in range(0, 64, PLANES_PER_TEST):
            over = np.zeros(len(blocks), np.uint64)
            for plane in planes[first : first + PLANES_PER_TEST]:
                other = plane[np.minimum(blocks + jump, len(plane) - 1)] >> np.uint64(shift)
                if shift:
                    following = plane[np.minimum(blocks + jump + 1, len(plane) - 1)]
                    other |= following << np.uint64(64 - shift)
                carry = plane[blocks] ^ other
                for k in range(width):  # add one bit to every lane's counter
                    counter[k], carry = counter[k] ^ carry, counter[k] & carry
                over |= carry
            alive &= ~over
            keep = np.flatnonzero(alive)
            if len(keep) < len(blocks):  # abandon words whose rows have all exceeded the radius
                blocks, alive = blocks[keep], alive[keep]
                counter = [c[keep] for c in counter]
            if not len(blocks):
                break
        if len(blocks):
            lanes = np.unpackbits(alive.view(np.uint8), bitorder="little").reshape(-1, 64)
            word, lane = np.nonzero(lanes)
            left = blocks[word] * 64 + lane
            near = np.bitwise_count(values[left] ^ values[left + step]) <= radius
            left = left[near]
            if len(left):
                yield left, left + step


def spanning_roots(n: int, pairs: Iterator[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    """The smallest index each index is connected with."""
    root = np.arange(n)
    for left, right in pairs:
        while True:
            a, b = root[left], root[right]
            differ = a != b
            if not differ.any():
                break
            left, right, a, b = left[differ], right[differ], a[differ], b[differ]
            np.minimum.at(root, np.maximum(a, b), np.minimum(a, b))
            while (root[root] != root).any():
                root = root[root]
    return root


def _compare(batches: Iterator[pa.RecordBatch], radius: int) -> Iterator[pa.RecordBatch]:
    """Rows (key..., value) sorted by key; returns (value, smaller value) links of a spanning forest."""

    def links(keys: np.ndarray, values: np.ndarray):
        starts = np.flatnonzero(np.r_[True, (keys[1:] != keys[:-1]).any(axis=1)])
        sizes = np.diff(np.r_[starts, len(values)])
        ends = np.repeat(starts + sizes, sizes)
        root = spanning_roots(len(values), close_pairs(values.view(np.uint64), ends, radius))
        linked = np.flatnonzero(root != np.arange(len(values)))
        return pa.RecordBatch.from_arrays(
            [pa.array(values[linked]), pa.array(values[root[linked]])], ["a", "b"]
        )

    held_keys, held = np.empty((0, 4), np.int64), np.empty(0, np.int64)
    for batch in batches:
        columns = [np.asarray(c) for c in batch.columns]
        if not batch.num_rows:
            continue
        held_keys = np.concatenate([held_keys, np.stack(columns[:4], axis=1)])
        held = np.concatenate([held, columns[4]])
        if len(held) >= CHUNK_ROWS:  # the last key may go on in the next batch
            same = (held_keys == held_keys[-1]).all(axis=1)
            cut = len(held) - int(same.sum())
            if cut:
                yield links(held_keys[:cut], held[:cut])
                held_keys, held = held_keys[cut:], held[cut:]
    if len(held):
        yield links(held_keys, held)


def close_links(prints: DataFrame, radius: int = RADIUS, tile_rows: int = TILE_ROWS) -> DataFrame:
    """Links (a, b) that connect all distinct fingerprints within `radius` bits of each other."""
    masks = F.array(*[F.lit(m) for m in _masks(radius)])
    dealt = prints.select("fingerprint", F.posexplode(masks).alias("which", "mask")).select(
        F.col("which").cast("bigint").alias("which"),
        F.col("fingerprint").bitwiseAND(F.col("mask")).alias("bits"),
        F.col("fingerprint").alias("value"),
    )
    shared = dealt.groupBy("which", "bits").agg(F.count("*").alias("n")).where("n > 1")
    tiles = shared.withColumn("tiles", F.ceil(F.col("n") / tile_rows).cast("bigint")).drop("n")
    place = F.pmod(F.xxhash64("value"), F.col("tiles"))
    met = F.transform(
        F.sequence(F.lit(0).cast("bigint"), F.col("tiles") - 1),
        lambda t: F.struct(F.least(t, place).alias("a"), F.greatest(t, place).alias("b")),
    )
    rows = (
        dealt.join(tiles, ["which", "bits"])
        .select("which", "bits", F.explode(met).alias("tile"), "value")
        .select("which", "bits", F.col("tile.a").alias("ta"), F.col("tile.b").alias("tb"), "value")
    )
    key = ["which", "bits", "ta", "tb"]
    grouped = rows.repartition(*key).sortWithinPartitions(*key, "value")
    found = grouped.mapInArrow(lambda batches: _compare(batches, radius), "a bigint, b bigint")
    return found.distinct()


# --- components ---------------------------------------------------------------------------------------


def star_components(links: DataFrame) -> DataFrame:
    """(a, b): every linked value with the smallest value of its component, by star contraction."""
    steps = Steps(links.sparkSession)

    def checksum(df):
        row = df.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b"))).first()
        return tuple(row)

    edges = steps.stage(links.where("a <> b"))
    before = None
    while True:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
        # large star: larger neighbours move to the smallest value around
        large = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = steps.stage(large.where("a <> b").distinct())
        # small star: smaller neighbours and the value itself move to the smallest one
        down = large.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        least = down.groupBy("a").agg(F.min("b").alias("m"))
        small = down.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        edges = steps.stage(
            small.unionByName(least.select("a", F.col("m").alias("b"))).where("a <> b").distinct()
        )
        steps.drop(keep=1)
        now = checksum(edges)
        if now == before:
            return edges
        before = now


def components(prints: DataFrame, radius: int = RADIUS, tile_rows: int = TILE_ROWS) -> DataFrame:
    """(fingerprint, component_id) of all distinct fingerprints in written rows (doc_id, fingerprint)."""
    steps = Steps(prints.sparkSession)
    distinct = steps.stage(prints.groupBy("fingerprint").agg(F.min("doc_id").alias("least_id")))
    roots = star_components(close_links(distinct, radius, tile_rows))
    rooted = distinct.join(roots.withColumnsRenamed({"a": "fingerprint", "b": "_root"}), "fingerprint", "left")
    rooted = rooted.withColumn("_root", F.coalesce("_root", "fingerprint"))
    smallest = rooted.groupBy("_root").agg(F.min("least_id").alias("component_id"))
    found = stage(rooted.join(smallest, "_root").select("fingerprint", "component_id", "_root"))
    steps.drop()
    return found


def near_duplicates(
    docs: DataFrame, width: int = SHINGLE, radius: int = RADIUS, tile_rows: int = TILE_ROWS
) -> DataFrame:
    """All columns of `docs` but the text, with `fingerprint` (16 hex digits) and `component_id`."""
    docs = docs.drop("fingerprint", "component_id")
    prints = stage(with_fingerprints(docs, "fingerprint", width).drop("text"))
    found = components(prints.select("doc_id", "fingerprint"), radius, tile_rows).drop("_root")
    joined = prints.join(found, "fingerprint")
    hex_digits = F.lower(F.lpad(F.hex("fingerprint"), 16, "0"))
    return joined.withColumn("fingerprint", hex_digits).select(
        *docs.drop("text").columns, "fingerprint", "component_id"
    )


def near_dedup(
    docs: DataFrame, width: int = SHINGLE, radius: int = RADIUS, tile_rows: int = TILE_ROWS
) -> DataFrame:
    """The row with the smallest id of each component (null ids last), with the columns of `docs`.

    Of several rows with that id one of the smallest row hash stays. Texts are read twice, not written: rows
    are found again by id and hash of all their columns, and of equal rows one is picked.
    """
    mark, row, rank = (free_name(docs, name) for name in ("_print", "_row", "_rank"))
    kept_id, kept_row, copies = (free_name(docs, name) for name in ("_kept_id", "_kept_row", "_copies"))
    marked = docs.withColumn(row, F.xxhash64(*docs.columns))
    own = stage(
        with_fingerprints(marked, mark, width).select(
            F.col("doc_id").alias("doc_id"), F.col(mark).alias("fingerprint"), F.col(row).alias("row")
        )
    )
    found = components(own.select("doc_id", "fingerprint"), radius, tile_rows)
    order = F.struct(F.col("doc_id").isNull(), F.col("doc_id"), F.col("row"))
    first = own.join(found, "fingerprint").groupBy("_root").agg(F.min(order).alias("first"))
    counted = own.groupBy("doc_id", "row").agg(F.count("*").alias("copies"))
    kept = stage(
        first.select("first.doc_id", "first.row")
        .alias("f")
        .join(counted.alias("c"), F.expr("f.row = c.row AND f.doc_id <=> c.doc_id"))
        .select(F.col("f.doc_id").alias(kept_id), F.col("f.row").alias(kept_row), F.col("copies").alias(copies))
    )
    same = (F.col(row) == F.col(kept_row)) & F.col("doc_id").eqNullSafe(F.col(kept_id))
    single = marked.join(kept.where(F.col(copies) == 1), same, "left_semi")
    repeated = marked.join(kept.where(F.col(copies) > 1), same, "left_semi")
    one = F.row_number().over(Window.partitionBy("doc_id", row).orderBy(row))  # limited before the shuffle
    picked = repeated.withColumn(rank, one).where(F.col(rank) == 1).drop(rank)
    return single.unionByName(picked).select(*docs.columns)
