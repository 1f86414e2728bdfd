"""Exact removal of repeated byte strings of a minimum length.

A byte goes if a string of `MIN_BYTES` bytes that covers it also starts earlier: in a document of smaller
id (null ids last, repeated ids by row), or earlier in the same one. Strings are judged on the input.

Finding what can repeat. A window is a string of the minimum length. Its key is the smallest hash of the
`GRAM`-byte strings in it, so equal windows have equal keys. Neighbouring windows of equal key form a run;
a run, not a window, is what is counted and moved. Keys that occur in one run only are dropped. Of runs
with equal bytes all but the first are removed whole, so only the first of each class goes on, and only
if its key has other classes too (or its key occurs in it twice: it may repeat itself).

Finding what does repeat. The remaining runs are dealt out by key. A task lays a block of them side by
side, sorts the suffixes as far as `MIN_BYTES` matter, and takes the Burrows-Wheeler transform. Common
prefixes are derived by increasing value: all intervals of one prefix length are extended backward by
every character that occurs in them, through the last-to-first mapping, and each extension that ends at a
border without a value yet gives it the present length. Values below eight follow from the sort keys; the
expansion stops at `MIN_BYTES`, and borders without a value then join suffixes that agree that far. In
each group of those all but the first in document order are removed.

A key with more than `HOT_CLASSES` different runs is not sorted in one block: its windows are compared by
hash, pre-aggregated in every task, so a passage in a third of all documents is no task's burden.

Edge cases: null and empty texts have nothing to remove; texts shorter than the minimum neither; very long
texts are cut into overlapping pieces, which changes no result; repeated rows are removed but for the
first; other columns pass, also when called like a result column (that one is replaced).
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from flowledger.llm.common import Steps, unwrapped, wrapped
from flowledger.llm.rolling import PIECE, POWERS, buffer_of
from flowledger.operators.numbering import stage

MIN_BYTES = 100
GRAM = 32  # bytes hashed for a key; at most MIN_BYTES
RUN_WINDOWS = 512  # longest run
BLOCK = 1 << 19  # bytes of runs a task sorts at a time, but never less than a whole key
HOT_CLASSES = 4000  # different runs of one key that are sorted in one block
SLICE = 512  # texts a task holds as Python objects at a time
_PLACE_BITS = np.uint64(21)  # bits for a place in a piece; the others of a gram's hash make the key

_M1, _M2, _M3 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F), np.uint64(0x165667B19E3779F9)
_LAST_ID = np.iinfo(np.int64).max  # stands for a null id

RESULT = ["n_bytes", "removed", "kept"]


# --- runs of windows ----------------------------------------------------------------------------------


def _mixed(data: np.ndarray) -> np.ndarray:
    """A hash of the eight bytes at every place."""
    x = np.ndarray((len(data) - 7,), np.dtype("<u8"), buffer=data, strides=(1,)) * _M1
    x ^= x >> np.uint64(29)
    x *= _M2
    x ^= x >> np.uint64(32)
    return x


def _grams(x: np.ndarray, gram: int) -> np.ndarray:
    """A hash of the `gram` bytes at every place, from hashes of eight."""
    n = len(x) - (gram - 8)
    h = x[:n].copy()
    for at in [*range(8, gram - 8, 8), gram - 8] if gram > 8 else []:
        h = h * _M3 + x[at : at + n]
    h ^= h >> np.uint64(31)
    h *= _M1
    h ^= h >> np.uint64(30)
    return h


def _sliding_min(h: np.ndarray, width: int) -> np.ndarray:
    size = 1
    while 2 * size <= width:
        h = np.minimum(h[:-size], h[size:])
        size *= 2
    rest = width - size
    return np.minimum(h[:-rest], h[rest:]) if rest else h


def _window_hashes(x: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A hash of the bytes [start, end) for each pair."""
    up, down = POWERS.upto(len(x) + 1)
    sums = np.zeros(len(x) + 1, np.uint64)
    np.cumsum(x * up[: len(x)], out=sums[1:])
    h = (sums[ends - 7] - sums[starts]) * down[starts]
    return h ^ (h >> np.uint64(32))


def _pieces(offsets: np.ndarray, min_bytes: int) -> Iterator[tuple[int, int, np.ndarray]]:
    """Stretches of a buffer: (begin, end, starts of the texts inside); long texts in parts that overlap."""
    i, n = 0, len(offsets) - 1
    while i < n:
        begin = int(offsets[i])
        j = int(np.searchsorted(offsets, begin + PIECE, "right")) - 1
        if j > i:
            yield begin, int(offsets[j]), offsets[i:j]
            i = j
            continue
        end = int(offsets[i + 1])
        for at in range(begin, max(end - min_bytes + 1, begin + 1), PIECE):
            yield at, min(at + PIECE + min_bytes - 1, end), np.array([at], offsets.dtype)
        i += 1


def runs(data: np.ndarray, offsets: np.ndarray, min_bytes: int = MIN_BYTES, whole: bool = True):
    """Runs of the texts data[offsets[i]:offsets[i+1]]: arrays (key, text number, start, windows, hash, twice).

    `twice` says that the key occurs at two places of the run. Without `whole` only (key, twice).
    """
    gram = min(GRAM, min_bytes)
    width = min_bytes - gram + 1
    for begin, end, starts in _pieces(offsets, min_bytes):
        size = end - begin
        if size < min_bytes:
            continue
        part = np.ascontiguousarray(data[begin:end])
        x = _mixed(part)
        grams = _grams(x, gram) >> _PLACE_BITS
        # the place behind the hash makes the smallest one also the leftmost
        least = _sliding_min((grams << _PLACE_BITS) | np.arange(len(grams), dtype=np.uint64), width)
        keys = least >> _PLACE_BITS
        bounds = np.r_[starts - begin, size]
        # windows that end in the text they begin in; texts that are empty have no place of their own
        room = np.minimum(bounds[1:] - (min_bytes - 1), len(keys))
        valid = np.zeros(len(keys) + 1, np.int32)
        has = room > bounds[:-1]
        np.add.at(valid, bounds[:-1][has], 1)
        np.add.at(valid, room[has], -1)
        inside = np.cumsum(valid[:-1]) > 0
        first = np.ones(len(keys), bool)
        np.not_equal(keys[1:], keys[:-1], out=first[1:])
        first[bounds[:-1][has]] = True
        first &= inside
        at = np.flatnonzero(first)
        if not len(at):
            continue
        text = np.searchsorted(bounds[:-1], at, "right") - 1
        until = np.minimum(np.r_[at[1:], len(keys)], room[text])
        twice = _twice(grams, keys, least, at, until, width)
        if (until - at).max() > RUN_WINDOWS:
            parts = -(-(until - at) // RUN_WINDOWS)
            nth = np.arange(parts.sum()) - np.repeat(np.cumsum(parts) - parts, parts)
            at, until, text, twice = (np.repeat(v, parts) for v in (at, until, text, twice))
            at = at + nth * RUN_WINDOWS
            until = np.minimum(until, at + RUN_WINDOWS)
        if not whole:
            yield keys[at].view(np.int64), twice
            continue
        number = np.searchsorted(offsets, starts[text], "right") - 1
        hashes = _window_hashes(x, at, until + min_bytes - 1)
        start = at + begin - offsets[number]
        yield keys[at].view(np.int64), number, start, until - at, hashes.view(np.int64), twice


def _twice(grams, keys, least, at, until, width) -> np.ndarray:
    """Whether the key of each run [at, until) occurs at more than one place of it."""
    place = (least[at] & ((np.uint64(1) << _PLACE_BITS) - np.uint64(1))).astype(np.int64)
    twice = place < until - 1  # then the windows behind the first place hold another one
    rest = np.flatnonzero(~twice & (until - at > 1))  # else look behind the first place
    sizes = until[rest] - 1 + width - 1 - place[rest]
    rest, sizes = rest[sizes > 0], sizes[sizes > 0]
    if len(rest):
        ends = np.cumsum(sizes)
        look = np.arange(ends[-1]) + np.repeat(place[rest] + 1 - (ends - sizes), sizes)
        hits = grams[look] == np.repeat(keys[at[rest]], sizes)
        twice[rest] = np.logical_or.reduceat(hits, ends - sizes)
    return twice


def _key_counts(batches: Iterator[pa.RecordBatch], min_bytes: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        if not batch.num_rows:
            continue
        found = list(runs(*buffer_of(batch.column("text")), min_bytes, whole=False))
        if found:
            keys, twice = (np.concatenate(c) for c in zip(*found, strict=True))
            # a run that may repeat itself counts as two
            keys, counts = np.unique(np.concatenate([keys, keys[twice]]), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(counts)], ["key", "n"])


def _all_runs(batches: Iterator[pa.RecordBatch], min_bytes: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        if not batch.num_rows:
            continue
        doc, place = (np.asarray(batch.column(c)) for c in ("doc", "place"))
        for key, number, start, windows, hashes, twice in runs(*buffer_of(batch.column("text")), min_bytes):
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(v)
                    for v in (key, hashes, doc[number], place[number], start, windows.astype(np.int32), twice)
                ],
                ["key", "hash", "doc", "place", "start", "windows", "twice"],
            )


# --- repeats among the runs of a block ----------------------------------------------------------------


def sorted_suffixes(text: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """Rotations of `text` sorted by their first `depth` bytes or more, and the first eight of each."""
    n = len(text)
    turned = np.resize(text, n + 8)
    keys = np.ndarray((n,), np.dtype(">u8"), buffer=turned, strides=(1,)).astype(np.uint64)
    order = np.argsort(keys)
    known, value = 8, keys
    while True:
        ranked = value[order]
        rank = np.empty(n, np.uint64)
        rank[order] = np.cumsum(np.r_[False, ranked[1:] != ranked[:-1]]).astype(np.uint64)
        if known >= depth or rank[order[-1]] == n - 1:
            return order, keys
        value = rank * np.uint64(n) + np.roll(rank, -known % n)
        order = np.argsort(value)
        known *= 2


def bounded_common_prefixes(text: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted rotations, and the common prefix of each with the one before it; -1 for `depth` or more.

    Breadth-first interval expansion on the Burrows-Wheeler transform, one prefix length at a time.
    """
    n = len(text)
    order, keys = sorted_suffixes(text, depth)
    ranked = keys[order]
    differ = ranked[1:] ^ ranked[:-1]
    common = np.full(n + 1, -1, np.int16)
    common[0] = common[n] = 0
    equal = differ == 0
    top = sum((differ >> np.uint64(8 * k) == 0).astype(np.int16) for k in range(1, 8))  # equal bytes
    common[1:n] = np.where(equal, -1, top)

    before = text[order - 1]
    back = np.argsort(before, kind="stable")
    last_to_first = np.empty(n, np.int64)
    last_to_first[back] = np.arange(n)
    first_byte = text[order]

    borders = np.r_[0, np.flatnonzero(~equal) + 1, n]
    start, end = borders[:-1], borders[1:]
    queued = common[end] == 7
    start, end = start[queued], end[queued]
    for length in range(8, depth):
        if not len(start):
            break
        sizes = end - start
        owner = np.repeat(np.arange(len(start)), sizes)
        inside = np.arange(len(owner)) - np.repeat(np.cumsum(sizes) - sizes, sizes) + start[owner]
        reached = last_to_first[inside]
        turn = np.argsort(reached)
        reached, owner = reached[turn], owner[turn]
        same = (owner[1:] == owner[:-1]) & (first_byte[reached[1:]] == first_byte[reached[:-1]])
        start = reached[np.flatnonzero(np.r_[True, ~same])]
        end = reached[np.flatnonzero(np.r_[~same, True])] + 1
        new = common[end] < 0
        start, end = start[new], end[new]
        common[end] = length
    return order, common[:n]


def repeated_windows(segments: list[bytes], min_bytes: int) -> tuple[np.ndarray, np.ndarray]:
    """(segment, offset) of every window that also starts earlier in the list; offsets ascend."""
    sizes = np.array([len(s) for s in segments])
    text = np.frombuffer(b"\xff".join([*segments, b"\xff" * 8]), np.uint8)
    order, common = bounded_common_prefixes(text, min_bytes)
    heads = np.flatnonzero(common >= 0)
    least = np.minimum.reduceat(order, heads)
    later = np.zeros(len(text), bool)
    later[order] = order != np.repeat(least, np.diff(np.r_[heads, len(order)]))
    begins = np.cumsum(np.r_[0, sizes[:-1] + 1])
    at = np.flatnonzero(later)
    segment = np.searchsorted(begins, at, "right") - 1
    offset = at - begins[segment]
    whole = offset + min_bytes <= sizes[segment]
    return segment[whole], offset[whole]


def _spans(place: np.ndarray, start: np.ndarray) -> pa.RecordBatch:
    """Stretches of neighbouring windows of one text; the windows come in order."""
    new = np.r_[True, (place[1:] != place[:-1]) | (start[1:] != start[:-1] + 1)] if len(place) else []
    head = np.flatnonzero(new)
    count = np.diff(np.r_[head, len(place)]).astype(np.int32)
    return pa.RecordBatch.from_arrays(
        [pa.array(place[head]), pa.array(start[head]), pa.array(count)], ["place", "start", "windows"]
    )


def _block_spans(batches: Iterator[pa.RecordBatch], min_bytes: int) -> Iterator[pa.RecordBatch]:
    """Rows (key, doc, place, start, bytes), sorted by key, in blocks of whole keys."""
    held: list[tuple] = []
    size, last = 0, None

    def solved():
        rows = sorted(held, key=lambda r: r[1:4])
        segment, offset = repeated_windows([r[4] for r in rows], min_bytes)
        place = np.array([r[2] for r in rows], np.int64)[segment]
        return _spans(place, np.array([r[3] for r in rows], np.int64)[segment] + offset)

    for batch in batches:
        for row in zip(*(batch.column(c).to_pylist() for c in ("key", "doc", "place", "start", "bytes"))):
            if size >= BLOCK and row[0] != last:
                yield solved()
                held, size = [], 0
            held.append(row)
            size += len(row[4])
            last = row[0]
    if held:
        yield solved()


def _segments(batches: Iterator[pa.RecordBatch], min_bytes: int) -> Iterator[pa.RecordBatch]:
    """Bytes of the wanted runs of each text."""
    names = ["key", "classes", "start", "windows"]
    for batch in (b.slice(at, SLICE) for b in batches for at in range(0, b.num_rows, SLICE)):
        wanted = batch.column("wanted")
        key, classes, start, windows = (np.asarray(wanted.values.field(c)) for c in names)
        offsets = np.asarray(wanted.offsets)
        text = np.repeat(np.arange(batch.num_rows), np.diff(offsets))
        runs_of = slice(offsets[0], offsets[-1])
        key, classes, start, windows = (c[runs_of] for c in (key, classes, start, windows))
        doc, place = (np.asarray(batch.column(c))[text] for c in ("doc", "place"))
        texts = [t.encode() for t in batch.column("text").to_pylist()]
        ends = start + windows + (min_bytes - 1)
        pieces = [texts[i][a:b] for i, a, b in zip(text.tolist(), start.tolist(), ends.tolist(), strict=True)]
        yield pa.RecordBatch.from_arrays(
            [*(pa.array(c) for c in (key, classes, doc, place, start)), pa.array(pieces, pa.binary())],
            ["key", "classes", "doc", "place", "start", "bytes"],
        )


def _hashed_windows(batches: Iterator[pa.RecordBatch], min_bytes: int) -> Iterator[pa.RecordBatch]:
    """Every window of the runs of hot keys by its hash."""
    for batch in (b.slice(at, SLICE) for b in batches for at in range(0, b.num_rows, SLICE)):
        for row in batch.to_pylist():
            x = _mixed(np.frombuffer(row["bytes"], np.uint8))
            at = np.arange(len(row["bytes"]) - min_bytes + 1)
            hashes = _window_hashes(x, at, at + min_bytes).view(np.int64)
            same = [pa.array(np.full(len(at), row[c])) for c in ("key", "doc", "place")]
            yield pa.RecordBatch.from_arrays(
                [same[0], pa.array(hashes), same[1], same[2], pa.array(at + row["start"])],
                ["key", "hash", "doc", "place", "start"],
            )


# --- the operator -------------------------------------------------------------------------------------


@contextmanager
def _dropping_shuffles(spark: SparkSession):
    """Shuffle files of a finished step go at once: its result is in the shared folder."""
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name, "false")
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        spark.conf.set(name, before)


def removed_spans(
    docs: DataFrame, min_bytes: int = MIN_BYTES, hot_classes: int = HOT_CLASSES
) -> DataFrame:
    """(place, spans) of the written rows (place, doc, text); a span is a start and a number of windows."""
    if min_bytes < 8:
        raise ValueError("the minimum length is eight bytes or more")
    steps = Steps(docs.sparkSession)
    texts = docs.select("place", "doc", "text").where(F.octet_length("text") >= min_bytes)
    counts = texts.select("text").mapInArrow(lambda b: _key_counts(b, min_bytes), "key bigint, n bigint")
    shared = steps.stage(counts.groupBy("key").agg(F.sum("n").alias("n")).where("n > 1").select("key"))
    every = texts.mapInArrow(
        lambda b: _all_runs(b, min_bytes),
        "key bigint, hash bigint, doc bigint, place bigint, start bigint, windows int, twice boolean",
    )
    found = steps.stage(every.join(shared, "key", "left_semi"))

    same = ["key", "hash", "windows", "twice"]
    first = F.min(F.struct("doc", "place", "start"))
    classes = steps.stage(found.groupBy(*same).agg(first.alias("first"), F.count("*").alias("n")))
    copies = found.join(classes.where("n > 1").select(*same, "first"), same).where(
        "place <> first.place or start <> first.start"
    )
    spans = copies.select("place", "start", "windows")

    per_key = classes.groupBy("key").agg(F.count("*").alias("classes"))
    run = F.struct("key", F.col("first.start").alias("start"), "windows", "classes")
    wanted = (
        classes.join(per_key, "key")
        .where("classes > 1 or twice")
        .groupBy(F.col("first.place").alias("place"))
        .agg(F.collect_list(run).alias("wanted"))  # at most the runs of one document
    )
    segments = steps.stage(
        texts.join(wanted, "place").mapInArrow(
            lambda b: _segments(b, min_bytes),
            "key bigint, classes bigint, doc bigint, place bigint, start bigint, bytes binary",
        )
    )
    usual = segments.where(F.col("classes") <= hot_classes).drop("classes")
    sorted_runs = usual.repartition("key").sortWithinPartitions("key")
    by_blocks = sorted_runs.mapInArrow(
        lambda b: _block_spans(b, min_bytes), "place bigint, start bigint, windows int"
    )
    windows = segments.where(F.col("classes") > hot_classes).mapInArrow(
        lambda b: _hashed_windows(b, min_bytes),
        "key bigint, hash bigint, doc bigint, place bigint, start bigint",
    )
    earliest = windows.groupBy("key", "hash").agg(first.alias("first"))
    by_hash = (
        windows.join(earliest, ["key", "hash"])
        .where("place <> first.place or start <> first.start")
        .select("place", "start", F.lit(1).alias("windows"))
    )
    spans = spans.unionByName(by_blocks).unionByName(by_hash)
    each = F.sort_array(F.collect_list(F.struct("start", "windows")))
    by_text = stage(spans.groupBy("place").agg(each.alias("spans")))
    steps.drop()
    return by_text


_SPAN = pa.struct([("start", pa.int64()), ("stop", pa.int64())])
_CUT = pa.struct([("n_bytes", pa.int64()), ("removed", pa.list_(_SPAN)), ("kept", pa.binary())])


def _cut(min_bytes: int):
    @F.arrow_udf("struct<n_bytes: bigint, removed: array<struct<start: bigint, stop: bigint>>, kept: binary>")
    def cut(texts: pa.Array, spans: pa.Array) -> pa.Array:
        out = []
        for text, found in zip(texts, spans, strict=True):
            data = text.as_py().encode() if text.is_valid else b""
            removed: list[dict[str, int]] = []
            for s in found.as_py() or []:
                start, stop = s["start"], s["start"] + s["windows"] + min_bytes - 1
                if removed and start <= removed[-1]["stop"]:
                    removed[-1]["stop"] = max(stop, removed[-1]["stop"])
                else:
                    removed.append({"start": start, "stop": stop})
            edges = [0, *(e for r in removed for e in (r["start"], r["stop"])), len(data)]
            kept = b"".join(data[a:b] for a, b in zip(edges[::2], edges[1::2], strict=True))
            out.append({"n_bytes": len(data), "removed": removed, "kept": kept})
        return pa.array(out, _CUT)

    return cut


def suffix_dedup(
    docs: DataFrame, min_bytes: int = MIN_BYTES, hot_classes: int = HOT_CLASSES
) -> DataFrame:
    """All columns of `docs`, with `n_bytes`, `removed` (byte ranges) and `kept` (the other bytes)."""
    with _dropping_shuffles(docs.sparkSession):
        doc = F.coalesce(F.col("doc_id").cast("bigint"), F.lit(_LAST_ID)).alias("doc")
        placed = wrapped(docs, F.monotonically_increasing_id().alias("place"), doc)
        rows = stage(placed)  # fixes the places
        texts = rows.select("place", "doc", F.col("row.text").alias("text"))
        spans = removed_spans(texts, min_bytes, hot_classes)
    cut = rows.join(spans, "place", "left").withColumn("cut", _cut(min_bytes)("row.text", "spans"))
    return unwrapped(cut.select("row", "cut.*"), *RESULT)


def without_repeats(docs: DataFrame, min_bytes: int = MIN_BYTES) -> DataFrame:
    """`docs` with what is kept of the texts, and `n_chars`, if there, counted anew.

    Bytes of a character that was cut in two go with it; a null text stays null.
    """

    @F.arrow_udf("string")
    def whole_characters(kept: pa.Array) -> pa.Array:
        return pa.array([x.as_py().decode(errors="ignore") for x in kept], pa.string())

    found = suffix_dedup(wrapped(docs, "doc_id", "text"), min_bytes)
    text = F.when(F.col("text").isNotNull(), whole_characters("kept"))
    changed = {"text": text, "n_chars": F.char_length(text).cast(dict(docs.dtypes).get("n_chars", "int"))}
    return found.select(
        *[changed[c].alias(c) if c in changed else F.col("row")[c].alias(c) for c in docs.columns]
    )
