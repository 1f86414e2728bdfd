from __future__ import annotations

import random

import numpy as np
import pytest
import xxhash


from flowledger.llm import simhash as sim
from flowledger.llm.common import table
from llm.helpers import documents, odd_rows, random_text


def plain_fingerprint(text):
    words = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "").encode().split()
    if not words:
        return 0
    grams = [b" ".join(words[i : i + 3]) for i in range(max(len(words) - 2, 1))]
    hashes = [xxhash.xxh64_intdigest(g, seed=42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(rows, radius=3):
    prints = sorted({p for _, p in rows})
    root = {p: p for p in prints}

    def find(p):
        while root[p] != p:
            p = root[p]
        return p

    for i, p in enumerate(prints):
        for q in prints[:i]:
            if (p ^ q).bit_count() <= radius:
                root[find(p)] = find(q)
    least = {}
    for doc, p in rows:
        if doc is not None:
            least[find(p)] = min(doc, least.get(find(p), doc))
    return [(doc, f"{p:016x}", least.get(find(p))) for doc, p in rows]


def key(row):
    return tuple((x is None, str(x)) for x in row)


def found(df):
    return sorted((tuple(r) for r in df.select("doc_id", "fingerprint", "component_id").collect()), key=key)


@pytest.mark.parametrize("n, radius", [(1, 3), (64, 3), (500, 3), (300, 0), (200, 6)])
def test_close_pairs_are_all_pairs(n, radius):
    rng = np.random.default_rng(n)
    base = rng.integers(0, 2**63, 20, dtype=np.uint64)
    values = np.sort(rng.choice(base, n) ^ (np.uint64(1) << rng.integers(0, 64, n, dtype=np.uint64)))
    sizes = [n // 3, n - n // 3]
    ends = np.repeat(np.cumsum(sizes), sizes)
    got = {(int(a), int(b)) for x, y in sim.close_pairs(values, ends, radius) for a, b in zip(x, y)}
    want = {
        (i, j) for i in range(n) for j in range(i + 1, ends[i])
        if (int(values[i]) ^ int(values[j])).bit_count() <= radius
    }
    assert got == want


@pytest.mark.parametrize("tile_rows", [4096, 7])
def test_components_of_near_copies(spark, tile_rows):
    rng = random.Random(5)
    base = [random_text(rng, 300) for _ in range(6)]
    rows = []
    for i in range(240):
        words = base[i % 6].split()
        for _ in range(rng.randrange(4)):
            words[rng.randrange(len(words))] = "changed"
        rows.append((i * 3, " ".join(words), "en", "s", 1))
    rows += [(1000 + i, random_text(rng, 40), "en", "s", 1) for i in range(60)]
    got = sim.near_duplicates(documents(spark, rows), tile_rows=tile_rows)
    assert found(got) == sorted(plain_components([(r[0], plain_fingerprint(r[1])) for r in rows]), key=key)


def test_whole_table_against_plain_version(spark, sf_dir):
    from flowledger.llm.queries import queries

    got = queries()["op8_simhash_near_dedup"](spark, sf_dir)
    rows = [(r["doc_id"], plain_fingerprint(r["text"])) for r in table(spark, sf_dir, "documents").collect()]
    assert found(got) == sorted(plain_components(rows), key=key)


def test_odd_rows_empty_tables_and_clashing_names(spark):
    rows = odd_rows()
    docs = documents(spark, rows)
    want = sorted(plain_components([(r[0], plain_fingerprint(r[1])) for r in rows]), key=key)
    assert found(sim.near_duplicates(docs)) == want
    assert found(sim.near_duplicates(docs.limit(0))) == []
    extra = docs.selectExpr("*", "1 as fingerprint", "2 as component_id", "3 as _print", "4 as _place")
    assert found(sim.near_duplicates(extra)) == want
    kept = sim.near_dedup(extra)
    assert kept.columns == extra.columns
    ids = [r["doc_id"] for r in kept.collect()]
    assert len(ids) == len({c for _, _, c in want})
    assert sorted(i for i in ids if i is not None) == sorted({c for _, _, c in want if c is not None})
