from __future__ import annotations

import hashlib
import random

import numpy as np
import pytest

from flowledger.llm import suffix_dedup as sd
from flowledger.llm.common import table
from flowledger.llm.queries import queries
from llm.helpers import documents, odd_rows, random_text


def plain(rows, length=100):
    """(doc_id, bytes, removed, spans, SHA-256 of the rest) of (doc_id, text), window by window."""
    seen, out = set(), []
    for doc, text in sorted(rows, key=lambda r: (r[0] is None, r[0] or 0)):
        data = (text or "").encode()
        gone = np.zeros(len(data) + 1, bool)
        for i in range(len(data) - length + 1):
            window = data[i : i + length]
            if window in seen:
                gone[i : i + length] = True
            else:
                seen.add(window)
        rest = bytes(b for b, g in zip(data, gone) if not g)
        spans = int((gone[1:] & ~gone[:-1]).sum() + (len(data) > 0 and gone[0]))
        out.append((doc, len(data), int(gone.sum()), spans, hashlib.sha256(rest).hexdigest()))
    return sorted(out, key=str)


def digest(df):
    return sorted(
        (
            (r["doc_id"], r["n_bytes"], r["n_bytes"] - len(r["kept"]), len(r["removed"]),
             hashlib.sha256(r["kept"]).hexdigest())
            for r in df.collect()
        ),
        key=str,
    )


@pytest.mark.parametrize("depth", [8, 9, 20, 100])
@pytest.mark.parametrize("alphabet", [1, 2, 20])
def test_common_prefixes_by_interval_expansion(depth, alphabet):
    rng = np.random.default_rng(depth + alphabet)
    block = rng.integers(97, 97 + alphabet, 150).astype(np.uint8)
    text = np.concatenate([block, rng.integers(97, 97 + alphabet, 90).astype(np.uint8), block[20:], [0xFF] * 9])
    text = text.astype(np.uint8)
    order, common = sd.bounded_common_prefixes(text, depth)
    doubled = text.tobytes() * 2
    turned = [doubled[i : i + len(text)] for i in order]
    assert [t[:depth] for t in turned] == sorted(t[:depth] for t in turned)
    for k in range(1, len(text)):
        a, b = turned[k - 1], turned[k]
        shared = next((i for i in range(len(a)) if a[i] != b[i]), len(a))
        assert common[k] == (shared if shared < depth else -1)


def passages(seed):
    rng = random.Random(seed)
    shared = [random_text(rng, 60, 5000) for _ in range(5)]
    rows = []
    for i in range(80):
        text = random_text(rng, rng.randrange(10, 90), 5000)
        for _ in range(rng.randrange(3)):
            words = rng.choice(shared).split()
            a = rng.randrange(20)
            text += " " + " ".join(words[a : a + rng.randrange(10, 60)]) + " " + random_text(rng, 9, 5000)
        rows.append((i * 2, text, "en", "s", 1))
    rows += [(500, rows[3][1], "en", "s", 1), (501, "ab" * 700, "en", "s", 1), (7, "ab" * 400, "en", "s", 1)]
    rows += [(502, "é漢" * 60 + rows[4][1], "en", "s", 1), (503, "x" + "é漢" * 60, "en", "s", 1)]
    rows += [(600 + i, "".join(rng.choices("abcdefgh", k=i)) * 9, "en", "s", 1) for i in range(12, 130, 9)]
    rows += [(504, "z" * 3000, "en", "s", 1), (505, (shared[0] + ". ") * 8, "en", "s", 1)]
    return rows


@pytest.mark.parametrize("hot_classes", [sd.HOT_CLASSES, 2])
def test_passages_copies_and_periods(spark, hot_classes):
    rows = passages(1)
    got = sd.suffix_dedup(documents(spark, rows).repartition(5), hot_classes=hot_classes)
    assert digest(got) == plain([r[:2] for r in rows])


def test_small_pieces_and_blocks_change_nothing(spark, monkeypatch):
    rows = passages(2)
    data = np.frombuffer("".join(r[1] for r in rows).encode(), np.uint8)
    offsets = np.cumsum([0, *(len(r[1].encode()) for r in rows)])
    whole = [np.concatenate(c) for c in zip(*sd.runs(data, offsets))]
    monkeypatch.setattr(sd, "PIECE", 700)
    parts = [np.concatenate(c) for c in zip(*sd.runs(data, offsets))]

    def windows(found):
        key, text, start, count, _, _ = found
        return {(k, t, s + i) for k, t, s, c in zip(key, text, start, count) for i in range(c)}

    assert windows(whole) == windows(parts)
    assert len(windows(whole)) == sum(max(0, len(r[1].encode()) - 99) for r in rows)


def test_whole_table_against_plain_version(spark, sf_dir):
    got = queries()["op5_suffix_array_dedup"](spark, sf_dir).collect()
    rows = [(r["doc_id"], r["text"]) for r in table(spark, sf_dir, "documents").collect()]
    assert sorted(map(tuple, got), key=str) == plain(rows)


def test_odd_rows_empty_tables_and_clashing_names(spark):
    rows = odd_rows() + [(90, "q" * 120 + "\x00" + "r" * 120, None, None, None)] * 2
    docs = documents(spark, rows)
    extra = docs.selectExpr("*", "1 as place", "2 as kept", "3 as `row`", "4 as doc")
    got = sd.suffix_dedup(extra)
    assert digest(got) == plain([r[:2] for r in rows])
    assert got.columns == [c for c in extra.columns if c != "kept"] + sd.RESULT
    assert sd.suffix_dedup(docs.limit(0)).collect() == []
    kept = sd.without_repeats(extra)
    assert kept.columns == extra.columns
    assert kept.dtypes == extra.dtypes
    texts = {r["doc_id"]: r["text"] for r in kept.collect() if r["doc_id"] in (0, 1, 5)}
    assert texts == {0: None, 1: "", 5: rows[5][1]}
