from __future__ import annotations

import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from flowledger.llm import class_lm as lm
from flowledger.llm.common import table
from flowledger.llm.queries import queries
from llm.helpers import ODD_TEXTS, documents, odd_rows


def tokens(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return [*re.findall(r"[^\x20\x09-\x0D]+", low), None]


def held_out(doc):
    return zlib.crc32(("" if doc is None else str(doc)).encode()) % 7 == 2


def check(rows, got):
    """Base scores against a plain version; returns what the rows sum up to."""
    counts = Counter(t for doc, text in rows if not held_out(doc) for t in tokens(text))
    n, v = sum(counts.values()), len(counts)
    want = sorted(
        (
            (doc, held_out(doc), len(ts := tokens(text)), sum(counts[t] > 0 for t in ts), n,
             math.fsum(math.log10((counts[t] + 1) / (n + v + 1)) for t in ts))
            for doc, text in rows
        ),
        key=str,
    )
    got = sorted((tuple(r) for r in got), key=lambda r: str(r[:6]))
    assert len(got) == len(want)
    order = lambda r: (str(r[:5]), r[5])
    for g, w in zip(sorted(got, key=order), sorted(want, key=order)):
        assert g[:5] == w[:5]
        assert g[5] == pytest.approx(w[5], rel=1e-9, abs=1e-9)
        assert g[6] < 0 and math.isfinite(g[6])


def test_words_are_told_apart_and_cut_right(monkeypatch):
    texts = [*ODD_TEXTS, "The THE the", "ab ba abab", "x" * 4000 + " y" * 900]
    for piece in (1 << 20, 64):
        monkeypatch.setattr(lm, "PIECE", piece)
        hashes, bundle, text = lm.tokens_of(pa.array(texts, pa.string()))
        plain = [(i, t) for i, x in enumerate(texts) for t in tokens(x)]
        assert text.tolist() == [i for i, _ in plain]
        by_hash = {}
        for h, b, (_, t) in zip(hashes.tolist(), bundle.tolist(), plain):
            assert by_hash.setdefault(h, (t, b)) == (t, b)
        assert len(by_hash) == len({t for _, t in plain})


def likelihood(bigrams, found, classes):
    member = np.eye(classes, dtype=int)[found]
    pairs = member.T @ bigrams @ member
    return sum(lm._n_log_n(pairs).ravel()) - sum(lm._n_log_n(pairs.sum(0))) - sum(lm._n_log_n(pairs.sum(1)))


def test_exchange_ends_where_no_single_move_helps():
    rng = np.random.default_rng(0)
    bigrams = rng.poisson(rng.gamma(0.3, 4, (30, 30)))
    found = lm.exchange_classes(bigrams, 5, 100)
    best = likelihood(bigrams, found, 5)
    for u in range(29):
        for c in range(4):
            other = found.copy()
            other[u] = c
            assert likelihood(bigrams, other, 5) <= best + 1e-6


def test_exchange_finds_classes_that_are_there():
    bigrams = np.zeros((21, 21), int)
    for a in range(20):
        for b in range(20):
            bigrams[a, b] = 50 if b % 4 == (a + 1) % 4 else 0
    found = lm.exchange_classes(bigrams, 5, 100)
    assert len({tuple(found[k:20:4]) for k in range(4)}) == 4
    assert all(len(set(found[k:20:4])) == 1 for k in range(4))


@pytest.mark.parametrize("frequent", [lm.FREQUENT, 40, 0])
def test_scores(spark, frequent):
    rng = random.Random(8)
    kinds = [[f"{k}{i}" for i in range(120)] for k in "abcd"]
    rows = []
    for i in range(160):  # words of four kinds follow one another in a ring
        at, words = rng.randrange(4), []
        for _ in range(rng.randrange(5, 120)):
            words.append(kinds[at][int(120 * rng.random() ** 3)])
            at = (at + 1) % 4
        rows.append((i, " ".join(words), "en", "s", 1))
    got = lm.score(documents(spark, rows).repartition(3), classes=6, frequent=frequent).collect()
    check([r[:2] for r in rows], got)
    held = [r for r in got if r["held_out"]]
    perplexity = lambda c: 10 ** (-sum(r[c] for r in held) / sum(r["n_tokens"] for r in held))
    if frequent == lm.FREQUENT:
        assert perplexity("score") < 0.5 * perplexity("base_score")


def test_probabilities_sum_to_one_and_give_the_score(spark):
    rng = random.Random(4)
    rows = [(i, " ".join(rng.choices("abcdefgh", k=20)), "en", "s", 1) for i in range(40)]
    docs = documents(spark, rows)
    training = docs.where(~lm.is_held_out()).select("text")
    counts = training.mapInArrow(lm._word_counts, "word bigint, bundle int, n bigint").groupBy("word").agg(
        {"bundle": "min", "n": "sum"}).toDF("word", "bundle", "n")
    model = lm.fit(training, counts, 4)
    assert np.allclose((10**model.moves).sum(axis=1), 1)
    words = {r["word"]: r["n"] for r in counts.collect()}
    inside = Counter()
    group = {}
    for w, n in words.items():
        unit, _ = model.unit(np.array([w]), np.array([lm.END_BUNDLE]))
        group[w] = int(model.classes[unit[0]])
        inside[group[w]] += (n + 1) / 10 ** model.rooms[group[w]]
    for c, p in inside.items():
        assert p + 1 / 10 ** model.rooms[c] == pytest.approx(1)
    for r in lm.score(docs, 4).collect():
        hashes, _, _ = lm.tokens_of(pa.array([rows[r["doc_id"]][1]]))
        before, want = group[lm.END], 0.0
        for w in hashes.tolist():
            want += model.moves[before, group[w]] + math.log10(words[w] + 1) - model.rooms[group[w]]
            before = group[w]
        assert r["score"] == pytest.approx(want)


def test_whole_table_against_plain_version(spark, sf_dir):
    got = queries()["op7_class_lm"](spark, sf_dir).collect()
    rows = [(r["doc_id"], r["text"]) for r in table(spark, sf_dir, "documents").collect()]
    check(rows, got)
    held = [r for r in got if r["held_out"]]
    assert sum(r["score"] for r in held) > sum(r["base_score"] for r in held)


def test_odd_rows_empty_tables_and_clashing_names(spark):
    rows = odd_rows()
    docs = documents(spark, rows).selectExpr("*", "1 as held_out", "2 as n_tokens", "3 as place", "4 as word")
    check([r[:2] for r in rows], lm.score(docs).collect())
    assert lm.score(docs.limit(0)).collect() == []
    only = docs.where(lm.is_held_out())
    check([r[:2] for r in rows if held_out(r[0])], lm.score(only).collect())


def test_gains_are_those_of_the_likelihood():
    rng = np.random.default_rng(3)
    units, classes = 12, 4
    ring = rng.integers(0, units, 300) * rng.integers(0, 2, 300)  # every word has as many before as behind it
    bigrams = np.zeros((units, units), int)
    np.add.at(bigrams, (ring, np.roll(ring, -1)), 1)
    for _ in range(3):
        found = rng.integers(0, classes, units)
        member = np.eye(classes, dtype=int)[found]
        pairs = member.T @ bigrams @ member
        own = np.diagonal(bigrams)
        for u in range(units):
            row = np.array([u])
            gain = lm.word_gains((bigrams @ member)[row], (bigrams.T @ member)[row], own[row], found[row], pairs)[0]
            for c in range(classes):
                other = found.copy()
                other[u] = c
                more = likelihood(bigrams, other, classes) - likelihood(bigrams, found, classes)
                assert gain[c] - gain[found[u]] == pytest.approx(more, abs=1e-6)


@pytest.mark.parametrize("frequent", [lm.FREQUENT, 600, 0])
def test_words_beyond_the_units_are_clustered_one_by_one(spark, frequent):
    """Rare words of one ending that stand among different words get different classes."""
    rng = random.Random(5)
    rows = []
    for i in range(120):
        kind = "xy"[i % 2]
        words = [f"{kind}{k}" for k in range(lm.OWN_UNITS // 2)]
        words += [f"{kind}{rng.randrange(40)}same" for _ in range(20)]
        rows.append((i, " ".join(rng.sample(words, len(words))), "en", "s", 1))
    docs = documents(spark, rows)
    training = docs.where(~lm.is_held_out()).select("text")
    counts = training.mapInArrow(lm._word_counts, "word bigint, bundle int, n bigint").groupBy("word").agg(
        {"bundle": "min", "n": "sum"}).toDF("word", "bundle", "n")
    words = lm.classes_of_words(training, counts, lm.fit(training, counts, 6, max(frequent, 600))).collect()
    group = {r["word"]: r["group"] for r in words}
    assert len(words) == counts.count()

    def of(prefix):
        texts = pa.array([f"{prefix}{i}same" for i in range(40)])
        return {group[h] for h in lm.tokens_of(texts)[0].tolist() if h != lm.END}

    assert not of("x") & of("y")
    check([r[:2] for r in rows], lm.score(docs, 6, frequent).collect())
