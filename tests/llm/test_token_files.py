from __future__ import annotations

import json
import pathlib
import random
import struct
import zlib

import numpy as np
import pytest
import xxhash
import zstandard
from pyspark.errors import PythonException
from tokenizers import Tokenizer

from flowledger.llm import token_files
from flowledger.llm.common import table
from flowledger.llm.queries import queries
from llm.helpers import documents, odd_rows, random_text

LIBRARY = Tokenizer.from_file(token_files.TOKENIZER)


def plain_ids(text):
    return [*LIBRARY.encode(text or "", add_special_tokens=False).ids, 2]


def packed(ids):
    return np.array(ids, "<u4").tobytes()


def plain_digests(rows):
    """Of (doc_id, text) in order."""
    out, start = [], 0
    for doc, text in rows:
        ids = plain_ids(text)
        out.append((doc, start, len(ids), zlib.crc32(packed(ids))))
        start += len(ids)
    return out


def test_whole_table(spark, sf_dir):
    rows = table(spark, sf_dir, "documents").select("doc_id", "text").orderBy("doc_id").collect()
    got = queries()["op13_token_files"](spark, sf_dir)
    assert got.columns == ["doc_id", "start", "n_tokens", "ids_crc32"]
    assert sorted(map(tuple, got.collect())) == plain_digests(rows)


HARD = [
    "It's <|endoftext|> and<|startoftext|>glued <|ENDOFTEXT|>",
    "nul\x00inside \x00 alone",
    "é café ́lone 각 Ạ̈",
    "nbsp here   \u0085 　wide \x1c\x1d\x1e\x1f seps ​",
    "ΑΣ ΟΔΥΣΣΕΥΣ İstanbul ſ ß ﬁ Ⅳ ½ ٣ 漢字かな 😀👩‍👩‍👧",
    "don't we'll I'm ''s 's 'S 1234 a1b2 $%&*",
    "x" * 3000 + " " + "ab " * 50,
]


@pytest.mark.parametrize("size", ["usual", "small"])
def test_encoder_gives_what_the_library_gives(monkeypatch, size):
    if size == "small":
        for name, value in (("KNOWN", 7), ("PIECE_BYTES", 40), ("KNOWN_LENGTH", 8)):
            monkeypatch.setattr(token_files, name, value)
    rng = random.Random(3)
    letters = "aZ '.,é́ \x00<|>1 \n\t"
    texts = HARD + ["".join(rng.choices(letters, k=rng.randrange(60))) for _ in range(300)]
    texts += ["".join(rng.choices("'sStTlLrRvVeEdDmM<|>endoftxÀÿ×÷ß1²ªµ¼", k=rng.randrange(12))) for _ in range(2000)]
    own = token_files.Encoder()
    for text in texts + texts[::-1]:
        assert own.encode(text.encode()) == packed(plain_ids(text)[:-1]), text
    apart = token_files.Encoder(words_apart=False)
    assert all(apart.encode(t.encode()) == packed(plain_ids(t)[:-1]) for t in HARD)


def test_other_tokenizers_go_through_the_whole_library(tmp_path):
    settings = json.loads(pathlib.Path(token_files.TOKENIZER).read_text())
    settings["normalizer"]["normalizers"].pop()  # keeps upper case
    other = tmp_path / "other.json"
    other.write_text(json.dumps(settings))
    library, own = Tokenizer.from_file(str(other)), token_files.Encoder(str(other))
    for text in HARD:
        assert own.encode(text.encode()) == packed(library.encode(text, add_special_tokens=False).ids)


def test_odd_rows_ties_and_clashing_names(spark, tmp_path):
    rows = odd_rows() + [(200 + i, t, "en", "s", 1) for i, t in enumerate(HARD)]
    rows += [(-3, "minus", "en", "s", 1), (300, "again", "en", "s", 1), (300, "again", "en", "s", 1), (300, "", None, None, None)]
    docs = documents(spark, rows).selectExpr("*", "1 as ids", "2 as start", "3 as tie", "4 as file")
    files = token_files.write(docs, f"{tmp_path}/odd")
    got = files.read().orderBy("start").collect()
    assert sorted((r["doc_id"] is not None, r["doc_id"] or 0, bytes(r["ids"])) for r in got) == sorted(
        (r[0] is not None, r[0] or 0, packed(plain_ids(r[1]))) for r in rows
    )
    ids = [r["doc_id"] for r in got]
    assert ids == sorted(ids, key=lambda i: (i is not None, i or 0))
    assert [r["start"] for r in got] == [sum(len(r["ids"]) // 4 for r in got[:i]) for i in range(len(got))]
    unpacked = files.read().select("ids", token_files.unpacked().alias("list")).collect()
    assert all(packed(r["list"]) == bytes(r["ids"]) for r in unpacked)
    empty = token_files.write(docs.limit(0), f"{tmp_path}/empty")
    assert empty.read().collect() == [] and empty.read_documents(docs).collect() == []


def test_requested_documents(spark, tmp_path):
    rng = random.Random(4)
    rows = [(3 * i, random_text(rng, rng.randrange(50)), "en", "s", 1) for i in range(300)] + [(30, "twice", "", "", 1)]
    files = token_files.write(documents(spark, rows).repartition(5), f"{tmp_path}/files")
    every = {(r["doc_id"], r["start"], bytes(r["ids"])) for r in files.read().collect()}
    wanted = spark.createDataFrame([(i,) for i in [30, 0, 897, 898, -1, 300, 300, None]], "doc_id int")
    got = [(r["doc_id"], r["start"], bytes(r["ids"])) for r in files.read_documents(wanted).collect()]
    assert sorted(got) == sorted(r for r in every if r[0] in (0, 30, 300, 897)) and len(got) == 5


def one_file(folder, docs):
    writer = token_files.FileWriter(str(folder), 0, 0)
    for doc, ids in docs:
        writer.add(doc, packed(ids))
    return writer.close()[2]


def test_only_requested_frames_are_decompressed(tmp_path, monkeypatch):
    monkeypatch.setattr(token_files, "FRAME_IDS", 10)
    docs = [(None, [1])] + [(i, list(range(i, i + 1 + 7 * i))) for i in range(20)]
    name = one_file(tmp_path, docs)
    reader = token_files.FileReader(str(tmp_path), name)
    seen, inner = [], reader.decompress
    reader.decompress = lambda data: seen.append(len(data)) or inner(data)
    places = reader.places([4, 19, 77])
    got = [(d, s, np.frombuffer(b, "<u4").tolist()) for d, s, b in reader.read(places)]
    starts = np.cumsum([0] + [len(ids) for _, ids in docs])
    assert got == [(d, starts[p], docs[p][1]) for d, p in ((4, 5), (19, 20))]
    assert len(seen) == 3 + 14  # frames of 29 and of 134 ids
    whole = list(reader.read(range(len(reader))))
    assert [(d, np.frombuffer(b, "<u4").tolist()) for d, _, b in whole] == docs


def test_files_are_in_the_public_seekable_format(tmp_path):
    """Parsed by hand; any zstandard decoder reads the frames and skips the rest."""
    docs = [(i, list(range(50 * i + 1))) for i in range(4)]
    data = (pathlib.Path(tmp_path) / one_file(tmp_path, docs)).read_bytes()
    count, flags, magic = struct.unpack("<IBI", data[-9:])
    assert (flags, magic) == (0x80, 0x8F92EAB1) and count == 5
    table = data[-9 - 12 * count : -9]
    assert struct.unpack("<II", data[-17 - 12 * count : -9 - 12 * count]) == (0x184D2A5E, 12 * count + 9)
    at = 0
    for i, (stored, size, checksum) in enumerate(struct.iter_unpack("<III", table)):
        if i < len(docs):
            content = zstandard.ZstdDecompressor().decompress(data[at : at + stored])
            assert content == packed(docs[i][1]) and size == len(content)
            assert checksum == xxhash.xxh64_intdigest(content) & 0xFFFFFFFF
        at += stored
    everything = zstandard.ZstdDecompressor().stream_reader(data, read_across_frames=True).read()
    assert everything == b"".join(packed(ids) for _, ids in docs)


def test_damage_is_found(spark, tmp_path):
    files = token_files.write(documents(spark, [(1, "some words here", "en", "s", 1)]), f"{tmp_path}/files")
    path = next(pathlib.Path(f"{tmp_path}/files").glob("ids-*"))
    good = path.read_bytes()
    cctx = zstandard.ZstdCompressor(level=token_files.LEVEL, write_checksum=False)
    frame = cctx.compress(packed(plain_ids("some words here")))
    other = cctx.compress(packed(plain_ids("some words her3"))[: len(packed(plain_ids("some words here")))])
    assert good.startswith(frame)
    if len(other) == len(frame):
        path.write_bytes(other + good[len(frame) :])
        with pytest.raises(PythonException, match="DamagedFile"):
            files.read().collect()
    path.write_bytes(good[:-1])
    with pytest.raises(PythonException, match="DamagedFile"):
        files.read().collect()


def test_left_over_files_are_not_read(spark, tmp_path, monkeypatch):
    folder = tmp_path / "files"
    folder.mkdir()
    one_file(folder, [(5, [1, 2])])  # as a lost attempt would leave it
    files = token_files.write(documents(spark, [(1, "word", "en", "s", 1)]), str(folder))
    assert [r["doc_id"] for r in files.read().collect()] == [1]
    assert len(list(folder.glob("ids-*"))) == 1
    assert json.loads(files.files.toJSON().first())["n_docs"] == 1


def test_words_of_ascii_letters_need_no_look_at_other_letters_or_special_tokens():
    own = token_files.Encoder()
    text = b"Plain letters ONLY, don't 4 caf\xc3\xa9"
    want = own.whole(text)
    assert own.encode(text) == want
    letters = b" ".join(w for w in text.split() if w.isalpha())
    want, fresh = own.whole(letters), token_files.Encoder()
    fresh.plain = fresh.special = None
    assert fresh.encode(letters) == want


def test_special_tokens_of_letters_are_found_inside_words(tmp_path):
    library = Tokenizer.from_file(token_files.TOKENIZER)
    library.add_special_tokens(["zebra"])
    path = str(tmp_path / "tokenizer.json")
    library.save(path)
    own = token_files.Encoder(path)
    assert not own.letters_plain
    for text in (b"a zebra", b"zebracrossing", b"somezebrashere plain"):
        assert own.encode(text) == own.whole(text)
