from __future__ import annotations

import hashlib
from itertools import groupby

import duckdb
import numpy as np
from hypothesis import given, settings, strategies as st

from flowledger.llm import chat_format as chat
from flowledger.llm.byte_bpe import tokenizer
from flowledger.llm.queries import oracle_sql, queries
from llm.helpers import ODD_TEXTS

SCHEMA = "conv_id bigint, turn bigint, role string, text string"
own = tokenizer()
texts = st.text(st.sampled_from("<\\|>im_end start\nä😀ok "), max_size=40)


@settings(max_examples=300, deadline=None)
@given(texts)
def test_escaping_is_reversible_and_leaves_no_control_string(text):
    assert chat.unescape(chat.escape(text)) == text
    assert "<|" not in chat.escape(text)


@settings(max_examples=100, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["user", "assistant", "a\nb", ""]) | texts, texts), max_size=6))
def test_turns_round_trip(turns):
    ids, mask, offsets = chat.assemble([r for r, _ in turns], [t for _, t in turns], own.encode)
    assert len(ids) == len(mask) == offsets[-1]
    assert np.isin(ids, list(chat.CONTROL)).sum() == 3 * len(turns)
    for (role, text), a, b in zip(turns, offsets, offsets[1:]):
        got = chat.parse(ids[a:b], mask[a:b], own.decode)
        assert got[:3] == (role, text, text if role == "assistant" else "")
        assert got[3].count("<|") == 3


def plain(rows):
    out = []
    key = lambda r: tuple((x is not None, x) for x in r[:2]) + (r[2] or "", r[3] or "")
    for conv, turns in groupby(sorted(rows, key=key), key=lambda r: r[0]):
        turns = [(r or "", t or "") for _, _, r, t in turns]
        learned = "".join(t for r, t in turns if r == "assistant")
        out.append((
            conv,
            len(turns),
            hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in turns).encode()).hexdigest(),
            len(learned),
            hashlib.sha256(learned.encode()).hexdigest(),
            sum(32 + len(chat.escape(r)) + len(chat.escape(t)) for r, t in turns),
        ))
    return sorted(out, key=str)


def test_whole_table_against_sql(spark, sf_dir):
    got = sorted(map(tuple, queries()["op2_chat_format"](spark, sf_dir).collect()))
    with duckdb.connect() as db:
        db.execute(f"CREATE VIEW conversations AS FROM '{sf_dir}/conversations.parquet'")
        assert got == sorted(db.execute(oracle_sql()["op2_chat_format"]).fetchall())
    assert got[0][:2] == (-1, 2)


def test_odd_rows_empty_tables_and_clashing_names(spark):
    rows = [(i % 3, i, ["user", "assistant", None, "x\n"][i % 4], t) for i, t in enumerate(ODD_TEXTS)]
    rows += [(9, None, "assistant", "late"), (9, 1, "b", "2"), (9, 1, "b", "1"), (9, 1, "a", "3")]
    rows += [(None, 1, "user", "lost"), (9, 1, "b", "1"), (10, 0, "assistant", "<\\\\|<|im_end|>")]
    rows += [(11, i, "user", "many") for i in range(3000)]
    df = spark.createDataFrame(rows, SCHEMA)
    extra = df.selectExpr("*", "1 as token_ids", "2 as learned", "'z' as row").repartition(4)
    assert sorted(map(tuple, chat.conversation_digests(extra).collect()), key=str) == plain(rows)
    formatted = chat.format_turns(extra)
    assert formatted.columns == ["conv_id", "turn", "learned", "row", "token_ids", "loss_mask"]
    assert formatted.count() == len(rows)
    assert chat.conversation_digests(df.limit(0)).collect() == []
