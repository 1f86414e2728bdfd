from __future__ import annotations

import math
import random
import re
from collections import Counter

import numpy as np
import pytest
import xxhash

import corpus_pipeline
from flowledger.llm import quality_rules as rules
from flowledger.llm.byte_bpe import tokenizer
from flowledger.llm.common import table
from flowledger.llm.queries import queries
from llm.helpers import documents, odd_rows, random_text, write_tables
from llm.test_mixing_sharding import plain_targets, size_of
from llm.test_simhash import plain_components, plain_fingerprint

LABELS = "doc_id bigint, quality int, toxic int"


def words_of(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def signed(h):
    return h - (1 << 64) if h >> 63 else h


def plain_counts(text):
    words = words_of(text)
    lines = [x for x in (text or "").split("\n") if words_of(x)]
    grams = Counter(tuple(words[i : i + 5]) for i in range(len(words) - 4))
    covered = set()
    for i in range(len(words) - 4):
        if grams[tuple(words[i : i + 5])] > 1:
            covered.update(range(i, i + 5))
    counts = {
        "n_words": len(words),
        "word_chars": sum(map(len, words)),
        "n_symbols": sum(c in "#*$%&|<>" for c in text or ""),
        "n_dup_lines": len(lines) - len(set(lines)),
        "n_repeat_words": len(covered),
    }
    return counts | {"base_failed": len(words) < 10 or 100 * len(covered) > 20 * len(words)}


def plain_buckets(text):
    words = [w.encode() for w in words_of(text)]
    out = [signed(xxhash.xxh64_intdigest(w, 42)) % rules.BUCKETS for w in words]
    for a, b in zip(words, words[1:]):  # the hash of the first is the seed for the second
        out.append(signed(xxhash.xxh64_intdigest(b, xxhash.xxh64_intdigest(a, 42))) % rules.BUCKETS)
    return out


def plain_rules(rows, trusted):
    raw, good = Counter(), Counter()
    for doc, text in rows:
        found = plain_buckets(text)
        raw.update(found)
        if doc in trusted:
            good.update(found)
    m, n_raw, n_good = rules.BUCKETS, sum(raw.values()), sum(good.values())

    def ratio(b):
        return math.log((good[b] + 1) / (n_good + m)) - math.log((raw[b] + 1) / (n_raw + m)) if n_good else 0.0

    out = []
    for doc, text in rows:
        counts, found = plain_counts(text), plain_buckets(text)
        score = math.fsum(map(ratio, found)) / len(found) if found else None
        kept = not counts["base_failed"] and (score is None or score >= rules.THRESHOLD)
        out.append((doc, *counts.values(), score, kept))
    return out


def same(got, want):
    order = lambda r: (str(r[:7]), r[7] is None, round(r[7] or 0, 6))
    got, want = sorted(got, key=order), sorted(want, key=order)
    assert len(got) == len(want)
    for g, w in zip(got, want):
        assert g[:7] == w[:7] and g[8] == w[8]
        assert g[7] == pytest.approx(w[7], abs=1e-9)


def trusted(labels):
    return {r["doc_id"] for r in labels if r["quality"] == 1 and not r["toxic"] and r["doc_id"] is not None}


def test_rules_on_the_whole_table(spark, sf_dir):
    got = queries()["op4_quality_rules"](spark, sf_dir)
    rows = [(r["doc_id"], r["text"]) for r in table(spark, sf_dir, "documents").collect()]
    labels = table(spark, sf_dir, "labels").collect()
    assert len(trusted(labels)) <= rules.TRUSTED_ROWS
    same([tuple(r) for r in got.collect()], plain_rules(rows, trusted(labels)))
    kept = {r["doc_id"]: r["kept"] for r in got.collect()}
    texts = dict(rows)
    clean = [i for i in trusted(labels) if i in kept and not plain_counts(texts[i])["base_failed"]]
    assert all(kept[i] for i in clean)


def test_rules_on_odd_rows_and_empty_tables(spark):
    rng = random.Random(2)
    rows = odd_rows() + [(50 + i, random_text(rng, 30 + i, 12), "en", "s", 1) for i in range(20)]
    rows += [(80, "a b c d e " * 40 + random_text(rng, 500), "en", "s", 1)]
    docs = documents(spark, rows).selectExpr("*", "1 as kept", "2 as n_words", "3 as _words", "4 as _text")
    labels = spark.createDataFrame([(50, 1, 0), (51, 1, None), (51, 1, 0), (52, 0, 0), (53, 1, 1), (None, 1, 0)], LABELS)
    got = rules.quality_rules(docs, labels)
    names = ["doc_id", *rules.COUNTS, "base_failed", "score", "kept"]
    same([tuple(r) for r in got.select(*names).collect()], plain_rules([r[:2] for r in rows], {50, 51}))
    unlabelled = rules.quality_rules(docs, labels.limit(0))
    same([tuple(r) for r in unlabelled.select(*names).collect()], plain_rules([r[:2] for r in rows], set()))
    assert rules.quality_rules(docs.limit(0), labels).collect() == []


def test_the_sample_of_trusted_documents_is_bounded_and_stable(spark):
    labels = spark.createDataFrame([(i, 1, 0) for i in range(100)], LABELS)
    first = [r["doc_id"] for r in rules.trusted_ids(labels, 10).collect()]
    again = [r["doc_id"] for r in rules.trusted_ids(labels.repartition(5), 10).collect()]
    assert len(first) == 10 and first == again


def plain_pipeline(docs, labels):
    """Rows (doc_id, text, copies) of the stages before encoding."""
    verdict = {v[0]: v[-1] for v in plain_rules([(d["doc_id"], d["text"]) for d in docs], trusted(labels))}
    docs = [d for d in docs if verdict[d["doc_id"]]]
    component = {d: c for d, _, c in plain_components([(d["doc_id"], plain_fingerprint(d["text"])) for d in docs])}
    docs = [d for d in docs if component[d["doc_id"]] == d["doc_id"]]
    seen, texts = set(), {}
    for d in sorted(docs, key=lambda d: d["doc_id"]):
        data = d["text"].encode()
        gone = np.zeros(len(data), bool)
        for i in range(len(data) - 99):
            window = data[i : i + 100]
            if window in seen:
                gone[i : i + 100] = True
            seen.add(window)
        texts[d["doc_id"]] = bytes(b for b, g in zip(data, gone) if not g).decode(errors="ignore")
    return [(d["doc_id"], d["source"], texts[d["doc_id"]]) for d in docs]


def test_pipeline_against_plain_versions(spark, sf_dir):
    docs, labels = (table(spark, sf_dir, t).collect() for t in ("documents", "labels"))
    want = plain_pipeline(docs, labels)
    result = corpus_pipeline.run(spark, sf_dir)
    assert result.columns == ["doc_id", "text", "lang", "source", "n_chars", "token_ids"]
    rows = result.collect()
    texts = {i: t for i, _, t in want}
    sources, copies = {i: s for i, s, _ in want}, Counter(r["doc_id"] for r in rows)
    own = tokenizer()
    for r in rows:
        assert r["text"] == texts[r["doc_id"]]
        assert r["n_chars"] == len(r["text"])
        assert r["token_ids"] == own.encode(r["text"])
    sizes, taken = Counter(), Counter()
    for i, s, t in want:
        sizes[s] += size_of(t)
        taken[s] += copies[i] * size_of(t)
    target = plain_targets(sizes)
    assert max(copies.values()) <= 3
    longest = max(map(size_of, texts.values()))
    assert all(abs(taken[s] - target[s]) <= longest for s in sizes)


def test_pipeline_on_odd_rows_and_empty_tables(spark, tmp_path):
    rng = random.Random(1)
    rows = odd_rows() + [(100 + i, random_text(rng, 60, 3000), "en", f"s{i % 4}", 1) for i in range(40)]
    labels = spark.createDataFrame([(100, 1, 0)], LABELS)
    extra = documents(spark, rows).selectExpr("*", "1 as kept", "2 as size", "3 as place")
    folder = write_tables(spark, tmp_path / "odd", documents=extra, labels=labels)
    result = corpus_pipeline.run(spark, folder)
    assert result.columns == [*extra.columns, "token_ids"]
    assert {r["doc_id"] for r in result.collect()} <= {r[0] for r in rows}
    empty = write_tables(spark, tmp_path / "empty", documents=extra.limit(0), labels=labels.limit(0))
    assert corpus_pipeline.run(spark, empty).collect() == []
