from __future__ import annotations

import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from flowledger.llm import spelling
from flowledger.llm.common import Steps, table
from flowledger.llm.queries import queries
from llm.helpers import documents, odd_rows

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
COLUMNS = ["word", "form", "root", "n", "n_near", "form_n"]


def plain_counts(rows):
    counts = Counter()
    for doc, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(LOWER)
            h = zlib.crc32(f"{'' if doc is None else doc}:{run}".encode())
            if h % 97 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] += 1
    return {w: n for w, n in counts.items() if len(w) >= 5 and n >= 3}


def one_edit(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(b) - len(a) > 1 or a == b:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def plain_variants(counts):
    shared = defaultdict(set)  # words that are equal without one letter, or have this one less
    for w in counts:
        shared[w].add(w)
        for i in range(len(w)):
            shared[w[:i] + w[i + 1 :]].add(w)
    near = defaultdict(set)
    for group in shared.values():
        for a in group:
            near[a] |= {b for b in group if one_edit(a, b)}
    form = {}
    for w, n in counts.items():
        best = min(near[w], key=lambda x: (-counts[x], x), default=None)
        if best is not None and counts[best] >= 2 * n:
            form[w] = best

    def root(w):
        while w in form:
            w = form[w]
        return w

    return {(w, form.get(w), root(w), n, len(near[w]), counts.get(form.get(w))) for w, n in counts.items()}


def result(df):
    rows = [tuple(r) for r in df.select(*COLUMNS).collect()]
    assert len(rows) == len(set(rows))
    return set(rows)


def test_whole_table(spark, sf_dir):
    rows = [(r["doc_id"], r["text"]) for r in table(spark, sf_dir, "documents").collect()]
    want = plain_variants(plain_counts(rows))
    assert any(w[1] for w in want)
    assert result(queries()["op11_spelling_variants"](spark, sf_dir)) == want


def many_words(rng):
    """Words that mostly begin alike, with edits at every place, repeated letters and other letters."""
    stems = ["prefixprefix" + "".join(rng.choices("abc", k=k)) for k in range(1, 7) for _ in range(12)]
    stems += ["aaaaa", "aaaaaa", "aaaaaaa", "ababab", "babab", "déjàvu", "dejàvu", "dejavu", "x" * 40, "x" * 41]
    words = set(stems)
    for s in stems:
        for _ in range(4):
            i, c = rng.randrange(len(s)), rng.choice("abcé")
            words |= {s[:i] + c + s[i:], s[:i] + s[i + 1 :], s[:i] + c + s[i + 1 :], s + c}
    return sorted(words)


@pytest.mark.parametrize("block_letters", [100, 1 << 16])
def test_groups_are_cut_without_loss(spark, block_letters):
    rng = random.Random(block_letters)
    words = many_words(rng)
    rows = [(i, " ".join([w] * (3 + rng.randrange(40))), "en", "s", 1) for i, w in enumerate(words)]
    counts = plain_counts([r[:2] for r in rows])
    got = result(spelling.variants(documents(spark, rows), block_letters=block_letters))
    assert got == plain_variants(counts)
    steps = Steps(spark)
    words = spark.createDataFrame(list(counts.items()), "word string, n bigint")
    dealt = spelling.deal(words, steps, block_letters)
    letters = dealt.selectExpr("*", "char_length(word) as size").groupBy("n", "lo", "hi", "letters").sum("size")
    assert all(r["sum(size)"] <= block_letters or r["hi"] - r["lo"] == 1 for r in letters.collect())
    steps.drop()


def test_bitsets_against_pairs():
    rng = random.Random(5)
    for n in (1, 4, 6):
        words = sorted({"".join(rng.choices("ab", k=n + rng.randrange(2))) for _ in range(60)})
        rng.shuffle(words)
        for cuts in ([0, n + 1], [0, n // 2, n, n + 1]):
            pairs = Counter()
            for lo, hi in zip(cuts, cuts[1:]):
                for letters in (10, 1 << 16):
                    count, best = spelling.near_words(words, n, lo, hi, letters)
                    for i, w in enumerate(words):
                        first = [
                            j
                            for j, v in enumerate(words)
                            if one_edit(w, v)
                            and {len(w), len(v)} != {n + 1}
                            and lo <= next((k for k, (x, y) in enumerate(zip(w, v)) if x != y), n) < hi
                        ]
                        assert (count[i], best[i]) == (len(first), first[0] if first else -1)
                        pairs[w] += len(first)
            assert all(pairs[w] % 2 == 0 for w in words)


def test_index_bits():
    letters = np.array([[97, 98], [97, 99], [100, 98]], np.uint32)
    index = spelling.PositionIndex(letters)
    assert index.having(0, np.array([97, 100, 101]))[:, 0].tolist() == [0b011, 0b100, 0]
    assert index.all(1)[0].tolist() == [0b111]


def test_roots_of_long_chains(spark):
    steps = Steps(spark)
    chain = [(f"w{i}", f"w{i + 1}") for i in range(21)] + [("a", "w3"), ("b", "a")]
    got = spelling.roots(spark.createDataFrame(chain, "word string, form string"), steps).collect()
    assert {r["word"] for r in got} == {w for w, _ in chain}
    assert {r["root"] for r in got} == {"w21"}


def test_odd_rows_ties_and_clashing_names(spark):
    rows = odd_rows() + [
        (62, "Sample SAMPLE sample", "en", "s", 1),
        (60, "simple simple simple\n" * 3, None, None, None),
        (60, "simple simple simple\n" * 3, None, None, None),
        (61, "samplé×samplé÷samplé " + "tample " * 18, "en", "s", 1),
    ]
    docs = documents(spark, rows).selectExpr("*", "1 as word", "2 as n", "3 as form", "4 as letters")
    want = plain_variants(plain_counts([r[:2] for r in rows]))
    assert ("sample", "simple", "simple", 3, 2, 18) in want  # a tie with 'tample' goes to the smaller
    assert result(spelling.variants(docs)) == want
    assert spelling.variants(docs.limit(0)).collect() == []
