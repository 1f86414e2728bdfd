from __future__ import annotations

import base64
import hashlib

import public_tokenizers
import pyarrow as pa
import pytest
import tiktoken
from hypothesis import given, settings, strategies as st

from flowledger.llm import byte_bpe as bpe
from flowledger.llm.common import table
from flowledger.llm.queries import queries
from llm.helpers import ODD_TEXTS, documents, odd_rows


@pytest.fixture(scope="module")
def library():
    with open(public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb") as file:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
    return tiktoken.Encoding(
        "own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}
    )


own = bpe.tokenizer()
texts = st.text(st.sampled_from("ab'st re  \n\t1é漢!?😀ll _="), max_size=200) | st.text(max_size=60)


@settings(max_examples=400, deadline=None)
@given(texts, st.integers(1, 40))
def test_any_cut_into_halves_gives_the_matches_of_the_whole(text, leaf):
    assert own.matches(text, leaf=leaf) == own.pattern.findall(text)


@settings(max_examples=300, deadline=None)
@given(texts, st.integers(0, 200))
def test_joining_encoded_halves(text, cut):
    data = text.encode()
    assert own.join(own.merge(data[:cut]), own.merge(data[cut:])) == own.merge(data)


@pytest.mark.parametrize(
    "text", [t or "" for t in ODD_TEXTS] + ["=" * 3000, "a" * 70_000, "ab" * 5000, " " * 9000 + "x", "é漢😀" * 4000]
)
def test_like_the_library(library, text):
    ids = own.encode(text)
    assert ids == library.encode_ordinary(text)
    assert own.decode(ids) == text.encode()
    packed = pa.array(ids, pa.int32())
    assert own.decode_array(packed) == text.encode()
    assert own.decode_array(packed.slice(1)) == own.decode(ids[1:])
    assert own.decimal_text(packed) == " ".join(map(str, ids)).encode()


def test_long_lists_are_decoded_up_a_tree(monkeypatch):
    monkeypatch.setattr(bpe, "LEAF_IDS", 3)
    ids = own.encode("some text of more than a few tokens, long enough for a tree")
    assert own.decode_array(pa.array(ids)) == own.decode(ids)


def test_whole_table_like_the_library(spark, sf_dir, library):
    got = {r["doc_id"]: r for r in queries()["op6_byte_bpe"](spark, sf_dir).collect()}
    rows = table(spark, sf_dir, "documents").collect()
    assert len(got) == len(rows)
    for row in rows:
        ids, text = library.encode_ordinary(row["text"] or ""), (row["text"] or "").encode()
        want = (
            row["doc_id"],
            len(ids),
            hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(),
            hashlib.sha256(text).hexdigest(),
        )
        assert tuple(got[row["doc_id"]]) == want


def test_odd_rows_empty_tables_and_clashing_names(spark):
    docs = documents(spark, odd_rows()).selectExpr("*", "1 as token_ids", "2 as decoded")
    rows = bpe.with_decoded(bpe.with_tokens(docs)).collect()
    assert len(rows) == len(odd_rows())
    for row in rows:
        assert bytes(row["decoded"]) == (row["text"] or "").encode()
    assert bpe.with_decoded(bpe.with_tokens(docs.limit(0))).collect() == []
