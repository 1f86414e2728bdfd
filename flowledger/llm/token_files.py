"""Token ids in binary files: independent zstandard frames, a trailing seek table, a checksum per frame.

Rows are sorted by document id across the cluster; each task encodes its range of them and writes it to
files of its own, so texts are shuffled once and ids never. A file is a sequence of frames in the public seekable zstandard format:

* data frames: the ids of one document as little-endian unsigned 32-bit integers. A document has frames
  of its own, so a reader decompresses only what was asked for; one of more than `FRAME_IDS` ids has
  several, so neither side holds more than a frame at a time.
* a skippable frame with the directory: document ids and id counts, compressed.
* a skippable frame with the seek table: compressed size, size and checksum (the low 32 bits of XXH64 of
  the content) of every frame before it, then the number of frames and a magic number. The last nine bytes
  of a file lead to the table, the table to any frame.

`_files`, a Parquet table, has one row per file: its place in the order, its first and last document,
how many documents and ids it holds, and how many ids come before it. It is written by Spark's own commit
protocol from what the writing tasks return, so a file that a lost or repeated task left behind is in no
row of it, is never read, and is deleted at the end.

Encoding: `words_apart` says that the tokenizer drops white space before it looks for tokens, as the given
one does. Then words between ASCII white space are encoded independently of one another, and a worker
encodes a word once and remembers its ids (a bounded number of words, in two generations). Without it
every text goes to the tokenizers library in one piece. `docs` should be read from files, as a pipeline
stage is: a retried task then meets the same rows in the same order, which spreads equal rows alike.

Edge cases: null and empty texts have the end id alone; null ids come first, repeated ids are ordered by a
hash of their texts (equal rows are interchangeable); strings of special tokens inside a text become those
tokens, as in the library; a very long text is encoded in pieces cut at white space; an empty table gives
no files; other columns, whatever their names, are not stored. A frame that does not match its checksum
raises `DamagedFile`.
"""

from __future__ import annotations

import json
import os
import re
import struct
import uuid
from array import array
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from flowledger.llm.common import Steps
from flowledger.operators.numbering import stage
from flowledger.sources.files import child_names, make_folder, remove

TOKENIZER = public_tokenizers.path("word_bpe_49k.json")
END_ID = 2  # closes every document

FRAME_IDS = 1 << 16  # ids of a data frame at most
FILE_BYTES = 1 << 28  # a file is closed once it is this long, so that reading it back is one task's work
FILE_DOCUMENTS = 1 << 20  # or holds this many documents
READ_BYTES = 1 << 22  # neighbouring frames are fetched together up to this many bytes
LEVEL = 3  # of compression

PIECE_BYTES = 1 << 20  # text a worker cuts into words at a time
KNOWN = 300_000  # words, and pieces of words, whose ids a worker remembers, twice
KNOWN_LENGTH = 64  # longest of them

# Fixed values of the seekable zstandard format.
SKIPPABLE_SEEK_TABLE = 0x184D2A5E
SKIPPABLE_DIRECTORY = 0x184D2A50
SEEKABLE_MAGIC = 0x8F92EAB1
WITH_CHECKSUMS = 0x80
ENTRY = np.dtype([("stored", "<u4"), ("size", "<u4"), ("checksum", "<u4")])
FOOTER = struct.Struct("<IBI")
SKIPPABLE_HEADER = struct.Struct("<II")

_SPACE = re.compile(rb"[\x20\x09-\x0d]")
FILES = "_files"
_FILE_COLUMNS = (
    "part int, number int, file string, n_docs bigint, n_ids bigint, n_frames bigint, n_bytes bigint, "
    "nulls bigint, first_doc bigint, last_doc bigint"
)


class DamagedFile(ValueError):
    pass


# --- encoding ------------------------------------------------------------------------------------------


class _Known(dict):
    """Remembers results for short keys; when full, what was used since the last time stays at hand."""

    def __init__(self, function):
        super().__init__()
        self.function, self.old = function, {}

    def __missing__(self, key):
        if len(key) > KNOWN_LENGTH:
            return self.function(key)
        if len(self) >= KNOWN:
            self.old = dict(self)
            self.clear()
        value = self.old.get(key)
        if value is None:
            value = self.function(key)
        self[key] = value
        return value


def _byte_letters() -> dict[int, int]:
    """The letters by which byte-level models know bytes: visible ones stand for themselves, the others
    follow in order from code point 256 on."""
    visible = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    hidden = (b for b in range(256) if b not in visible)
    return {b: 256 + i for i, b in enumerate(hidden)}


class Encoder:
    """Ids of texts as packed bytes, from the tokenizers library.

    Half of the library's time goes into cutting words into pieces. Where the tokenizer file says that
    pieces are what its pattern finds in the lower-cased word (`_cut_by_pattern`), words of ASCII and the
    letters \u00C0 to \u00FF are cut here with the file's own pattern, and only pieces not seen lately go to
    the library's model. All other words, tokenizers and texts go through the whole library."""

    def __init__(self, path: str = TOKENIZER, words_apart: bool = True):
        import regex
        from tokenizers import Tokenizer

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # the tasks are what runs side by side
        self.library = Tokenizer.from_file(path)
        self.words_apart = words_apart
        with open(path, encoding="utf-8") as file:
            settings = json.load(file)
        self.plain = re.compile("[!-~\u00c0-\u00ff]+")
        special = [re.escape(t["content"]) for t in settings["added_tokens"]]
        self.special = re.compile("|".join(special) or "(?!)")
        # a word of ASCII letters is plain, and without such a token it holds no special one either
        self.letters_plain = not any(t["content"].isascii() and t["content"].isalpha() for t in settings["added_tokens"])
        pattern = _cut_by_pattern(settings)
        self.pattern = regex.compile(pattern) if pattern else None
        self.byte_letters = _byte_letters()
        self.known, self.pieces_known = _Known(self._word), _Known(self._piece)

    def whole(self, text: bytes) -> bytes:
        ids = self.library.encode(text.decode("utf-8", "replace"), add_special_tokens=False).ids
        return np.array(ids, "<u4").tobytes()

    def _piece(self, piece: str) -> bytes:
        if not piece.isascii():  # ASCII letters stand for themselves
            piece = piece.encode().decode("latin-1").translate(self.byte_letters)
        return array("I", [t.id for t in self.library.model.tokenize(piece)]).tobytes()

    def _word(self, word: bytes) -> bytes:
        if self.pattern is None:
            return self.whole(word)
        text = word.decode("utf-8", "replace")
        if not (self.letters_plain and word.isalpha()) and (not self.plain.fullmatch(text) or self.special.search(text)):
            return self.whole(word)
        return b"".join(map(self.pieces_known.__getitem__, self.pattern.findall(text.lower())))

    def encode(self, text: bytes) -> bytes:
        """Packed ids of a text."""
        if not self.words_apart:
            return self.whole(text)
        return b"".join(
            [b"".join(map(self.known.__getitem__, piece.split())) for piece in self.pieces(text)]
        )

    def pieces(self, text: bytes) -> Iterator[bytes]:
        """A text cut behind white space, in pieces of a bounded size where it has any."""
        at = 0
        while len(text) - at > PIECE_BYTES:
            space = _SPACE.search(text, at + PIECE_BYTES)
            if space is None:
                break
            yield text[at : space.end()]
            at = space.end()
        yield text[at:] if at else text


def _cut_by_pattern(settings: dict) -> str | None:
    """The pattern whose matches in a lower-cased word are the pieces its model sees as bytes, if the
    tokenizer is of that kind: white space becomes a space, NFC and lower case, split by pattern, bytes."""
    normal, cut = settings.get("normalizer") or {}, settings.get("pre_tokenizer") or {}
    steps = [n["type"] for n in normal.get("normalizers", [])]
    cuts = cut.get("pretokenizers", [])
    if steps != ["NFC", "Replace", "Lowercase"] or [c["type"] for c in cuts] != ["Split", "ByteLevel"]:
        return None
    space, (split, to_bytes) = normal["normalizers"][1], cuts
    if (space["pattern"], space["content"]) != ({"Regex": r"\s+"}, " "):
        return None
    if (split["behavior"], split["invert"]) != ("Removed", True) or "Regex" not in split["pattern"]:
        return None
    if to_bytes["add_prefix_space"] or to_bytes["use_regex"] or settings["post_processor"]:
        return None
    return split["pattern"]["Regex"]


@lru_cache(maxsize=2)
def encoder(path: str = TOKENIZER, words_apart: bool = True) -> Encoder:
    """The worker's own copy, loaded once."""
    return Encoder(path, words_apart)


# --- one file ------------------------------------------------------------------------------------------


def file_system(path: str):
    """File system and path in it: local, HDFS or an object store, as the path's scheme says."""
    from pyarrow import fs

    if "://" in path:
        return fs.FileSystem.from_uri(path)
    return fs.LocalFileSystem(), path.removeprefix("file:")


def _checksum(data: bytes) -> int:
    import xxhash

    return xxhash.xxh64_intdigest(data) & 0xFFFFFFFF


class FileWriter:
    """Documents in ascending order of their ids into one file."""

    def __init__(self, folder: str, part: int, number: int):
        import zstandard

        self.name = f"ids-{part:06d}-{number:04d}-{uuid.uuid4().hex}.zst"
        system, inside = file_system(f"{folder}/{self.name}")
        self.file = system.open_output_stream(inside, compression=None)  # frames are compressed here
        self.compress = zstandard.ZstdCompressor(level=LEVEL, write_checksum=False).compress
        self.part, self.number = part, number
        self.entries: list[tuple[int, int, int]] = []
        self.docs: list[int | None] = []
        self.sizes: list[int] = []
        self.n_bytes = 0

    def _frame(self, stored: bytes, content: bytes, size: int) -> None:
        self.file.write(stored)
        self.entries.append((len(stored), size, _checksum(content)))
        self.n_bytes += len(stored)

    def add(self, doc_id: int | None, ids: bytes) -> None:
        for at in range(0, len(ids), 4 * FRAME_IDS):
            content = ids[at : at + 4 * FRAME_IDS]
            self._frame(self.compress(content), content, len(content))
        self.docs.append(doc_id)
        self.sizes.append(len(ids) // 4)

    def full(self) -> bool:
        return self.n_bytes >= FILE_BYTES or len(self.docs) >= FILE_DOCUMENTS

    def close(self) -> tuple:
        """Write directory and seek table; returns the file's row of `_files`."""
        nulls = sum(d is None for d in self.docs)
        known = [d for d in self.docs if d is not None]
        n_frames = len(self.entries)
        directory = struct.pack("<QQ", len(self.docs), nulls)
        directory += np.array(known, "<i8").tobytes() + np.array(self.sizes, "<u8").tobytes()
        stored = self.compress(directory)
        self._frame(SKIPPABLE_HEADER.pack(SKIPPABLE_DIRECTORY, len(stored)) + stored, directory, 0)
        table = np.array(self.entries, ENTRY).tobytes()
        table += FOOTER.pack(len(self.entries), WITH_CHECKSUMS, SEEKABLE_MAGIC)
        self.file.write(SKIPPABLE_HEADER.pack(SKIPPABLE_SEEK_TABLE, len(table)) + table)
        self.file.close()
        first, last = (known[0], known[-1]) if known else (None, None)
        return (
            self.part, self.number, self.name, len(self.docs), sum(self.sizes), n_frames, self.n_bytes,
            nulls, first, last,
        )


class FileReader:
    """Documents of one file, of which only the requested ones are read and decompressed."""

    def __init__(self, folder: str, name: str):
        import zstandard

        system, inside = file_system(f"{folder}/{name}")
        self.name = name
        self.file = system.open_input_file(inside)
        self.decompress = zstandard.ZstdDecompressor().decompress
        size = self.file.size()
        count, flags, magic = FOOTER.unpack(self._read(size - FOOTER.size, FOOTER.size))
        if magic != SEEKABLE_MAGIC or flags != WITH_CHECKSUMS:
            raise DamagedFile(f"{name}: no seek table at its end")
        table_at = size - FOOTER.size - count * ENTRY.itemsize
        self.entries = np.frombuffer(self._read(table_at, count * ENTRY.itemsize), ENTRY)
        self.offsets = np.concatenate([[0], np.cumsum(self.entries["stored"].astype(np.int64))])
        self._directory()

    def _read(self, at: int, size: int) -> bytes:
        self.file.seek(at)
        return self.file.read(size)

    def _checked(self, frame: int, content: bytes) -> bytes:
        if _checksum(content) != self.entries["checksum"][frame]:
            raise DamagedFile(f"{self.name}: frame {frame} does not match its checksum")
        return content

    def _directory(self) -> None:
        last = len(self.entries) - 1
        stored = self._read(int(self.offsets[last]), int(self.entries["stored"][last]))
        data = self._checked(last, self.decompress(stored[SKIPPABLE_HEADER.size :]))
        n, self.nulls = struct.unpack_from("<QQ", data)
        self.doc_ids = np.frombuffer(data, "<i8", n - self.nulls, 16)
        self.sizes = np.frombuffer(data, "<u8", n, 16 + 8 * (n - self.nulls)).astype(np.int64)
        self.starts = np.concatenate([[0], np.cumsum(self.sizes)])  # ids before each document
        frames = -(-self.sizes // FRAME_IDS)
        self.frames = np.concatenate([[0], np.cumsum(frames)])

    def __len__(self) -> int:
        return len(self.sizes)

    def places(self, doc_ids: Iterable[int]) -> list[int]:
        """Where the documents of the given ids lie; several for a repeated id, none for a missing one."""
        wanted = np.unique(np.fromiter(doc_ids, np.int64))
        low = np.searchsorted(self.doc_ids, wanted, "left")
        high = np.searchsorted(self.doc_ids, wanted, "right")
        return [int(self.nulls + p) for a, b in zip(low, high, strict=True) for p in range(a, b)]

    def read(self, places: Iterable[int]) -> Iterator[tuple[int | None, int, bytes]]:
        """(document id, ids before it in this file, packed ids) of the documents at ascending places."""
        buffer, begin = b"", 0
        places = list(places)
        for k, place in enumerate(places):
            parts = []
            for frame in range(self.frames[place], self.frames[place + 1]):
                at, end = int(self.offsets[frame]), int(self.offsets[frame + 1])
                if not begin <= at <= end <= begin + len(buffer):
                    begin, buffer = at, self._read(at, self._reach(places, k, frame) - at)
                content = self.decompress(buffer[at - begin : end - begin])
                parts.append(self._checked(frame, content))
            doc = None if place < self.nulls else int(self.doc_ids[place - self.nulls])
            yield doc, int(self.starts[place]), parts[0] if len(parts) == 1 else b"".join(parts)

    def _reach(self, places: list[int], k: int, frame: int) -> int:
        """How far to read from a frame on: over neighbours that are asked for too."""
        at = int(self.offsets[frame])
        end = int(self.offsets[frame + 1])
        last = places[k]
        while k + 1 < len(places) and places[k + 1] == last + 1 and end - at < READ_BYTES:
            k, last = k + 1, last + 1
            end = int(self.offsets[self.frames[last]])
        return max(end, min(int(self.offsets[self.frames[last + 1]]), at + READ_BYTES))

    def close(self) -> None:
        self.file.close()


# --- many files ----------------------------------------------------------------------------------------


def write(
    docs: DataFrame,
    path: str,
    tokenizer: str = TOKENIZER,
    end_id: int | None = END_ID,
    words_apart: bool = True,
) -> TokenFiles:
    """Encode `text` of every row and write the ids, by ascending `doc_id`, to files below `path`."""
    spark = docs.sparkSession
    steps = Steps(spark)
    # equal rows may be a large share of all: the last key spreads them
    keyed = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"), "text", F.xxhash64("text").alias("tie")
    ).withColumn("place", F.monotonically_increasing_id())
    order = [F.col("doc_id").asc_nulls_first(), F.col("tie").asc(), F.col("place").asc()]
    ordered = keyed.repartitionByRange(*order).sortWithinPartitions(*order).select("doc_id", "text")
    make_folder(spark, path)
    end = b"" if end_id is None else struct.pack("<I", end_id)

    def write_files(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = encoder(tokenizer, words_apart)
        part, number, out, rows = TaskContext.get().partitionId(), 0, None, []
        for batch in batches:
            texts = batch.column(1).cast(pa.binary()).fill_null(b"")
            for doc_id, text in zip(batch.column(0), texts, strict=True):
                if out is None:
                    out = FileWriter(path, part, number)
                out.add(doc_id.as_py(), own.encode(text.as_py()) + end)
                if out.full():
                    rows.append(out.close())
                    out, number = None, number + 1
        if out is not None:
            rows.append(out.close())
        yield pa.RecordBatch.from_pylist([dict(zip(FILE_ROW.names, r, strict=True)) for r in rows], FILE_ROW)

    written = steps.stage(ordered.mapInArrow(write_files, _FILE_COLUMNS))
    in_order = Window.orderBy("part", "number")  # one row per file
    before = in_order.rowsBetween(Window.unboundedPreceding, -1)
    listed = written.select(
        "*",
        F.row_number().over(in_order).alias("place"),
        F.coalesce(F.sum("n_ids").over(before), F.lit(0)).alias("start"),
    )
    kept = {r["file"] for r in stage(listed, f"{path}/{FILES}").select("file").collect()}
    for name in child_names(spark, path):
        if name.startswith("ids-") and name not in kept:
            remove(spark, f"{path}/{name}")
    steps.drop()
    return TokenFiles(spark, path)


FILE_ROW = pa.schema(
    [
        (name, {"int": pa.int32(), "bigint": pa.int64(), "string": pa.string()}[kind])
        for name, kind in (column.split() for column in _FILE_COLUMNS.split(", "))
    ]
)
_READ_COLUMNS = "doc_id bigint, start bigint, ids binary"
_READ_ROW = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("ids", pa.binary())])


def _batches(rows: Iterator[tuple]) -> Iterator[pa.RecordBatch]:
    """Rows of `_READ_ROW` in batches of a bounded size."""

    def batch():
        columns = zip(*waiting, strict=True)
        return pa.RecordBatch.from_arrays(
            [pa.array(c, f.type) for c, f in zip(columns, _READ_ROW, strict=True)], schema=_READ_ROW
        )

    waiting, size = [], 0
    for row in rows:
        waiting.append(row)
        size += len(row[2]) + 64
        if size >= READ_BYTES:
            yield batch()
            waiting, size = [], 0
    if waiting:
        yield batch()


class TokenFiles:
    """Written token files: `read()` gives all documents, `read_documents(ids)` only those asked for."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    @property
    def files(self) -> DataFrame:
        return self.spark.read.parquet(f"{self.path}/{FILES}")

    def read(self) -> DataFrame:
        """(doc_id, start, ids) of every document: `start` ids come before it, `ids` are packed."""
        files, path = self.files.select("file", "start"), self.path

        def read_files(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            def rows():
                for batch in batches:
                    for row in batch.to_pylist():
                        reader = FileReader(path, row["file"])
                        for doc, start, ids in reader.read(range(len(reader))):
                            yield doc, row["start"] + start, ids
                        reader.close()

            return _batches(rows())

        # a file is one task's work; a number of partitions of our own is not merged again
        dealt = files.repartitionByRange(max(files.count(), 1), "start")
        return dealt.mapInArrow(read_files, _READ_COLUMNS)

    def read_documents(self, wanted: DataFrame) -> DataFrame:
        """The same rows for the ids in column `doc_id` of `wanted`; ids that are not stored give none."""
        path = self.path
        spans = self.files.where("first_doc IS NOT NULL").orderBy("place")
        # one row per file: which files may hold an id is looked up in their bounds
        listed = spans.select("file", "start", "first_doc", "last_doc").collect()
        first = np.array([r["first_doc"] for r in listed], np.int64)
        last = np.array([r["last_doc"] for r in listed], np.int64)
        names, starts = [r["file"] for r in listed], [r["start"] for r in listed]

        def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                ids = batch.column(0).to_numpy()
                low = np.searchsorted(last, ids, "left")
                found = np.maximum(np.searchsorted(first, ids, "right") - low, 0)
                row = np.repeat(np.arange(len(ids)), found)
                step = np.arange(len(row)) - np.repeat(np.cumsum(found) - found, found)
                yield pa.RecordBatch.from_arrays(
                    [pa.array((low[row] + step).astype(np.int32)), pa.array(ids[row])], ["at", "doc_id"]
                )

        def read_some(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            def one(at, ids):
                reader = FileReader(path, names[at])
                for doc, start, packed in reader.read(reader.places(ids)):
                    yield doc, starts[at] + start, packed
                reader.close()

            def rows():
                current, ids = None, []
                for batch in batches:
                    for at, doc in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                        if at != current:
                            if ids:
                                yield from one(current, ids)
                            current, ids = at, []
                        ids.append(doc)  # at most as many as a file holds documents
                if ids:
                    yield from one(current, ids)

            return _batches(rows())

        ids = wanted.select(F.col("doc_id").cast("bigint").alias("doc_id")).where("doc_id IS NOT NULL").distinct()
        dealt = ids.mapInArrow(find, "at int, doc_id bigint").repartition("at").sortWithinPartitions("at", "doc_id")
        return dealt.mapInArrow(read_some, _READ_COLUMNS)


def unpacked(ids: str = "ids"):
    """Column of packed ids as an array of integers."""

    @F.arrow_udf("array<bigint>")
    def unpack(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for packed in batches:
            lists = [np.frombuffer(p.as_py() or b"", "<u4").astype(np.int64) for p in packed]
            offsets = np.concatenate([[0], np.cumsum([len(x) for x in lists])]).astype(np.int32)
            yield pa.ListArray.from_arrays(offsets, np.concatenate([np.empty(0, np.int64), *lists]))

    return unpack(ids)


def digests(files: TokenFiles) -> DataFrame:
    """What the files hold, document by document."""
    return files.read().select(
        "doc_id",
        "start",
        (F.octet_length("ids") / 4).cast("bigint").alias("n_tokens"),
        F.crc32("ids").alias("ids_crc32"),
    )
