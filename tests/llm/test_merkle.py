from __future__ import annotations

import hashlib
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from flowledger.llm import merkle
from flowledger.llm.common import table
from flowledger.llm.queries import queries
from llm.helpers import documents, odd_rows

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
COLUMNS = ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]


def digest(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def plain_leaf(row):
    return digest(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in row])


def plain_tree(leaves):
    paths, nodes, own = [[] for _ in leaves], list(leaves), list(range(len(leaves)))
    while len(nodes) > 1:
        for leaf, at in enumerate(own):
            first = at // 16 * 16
            paths[leaf].append((nodes[first:at], nodes[at + 1 : first + 16]))
            own[leaf] = at // 16
        nodes = [digest(*nodes[i : i + 16]) for i in range(0, len(nodes), 16)]
    return nodes[0], paths


def plain_proofs(rows):
    """`rows`: (doc_id, source, lang, n_chars, text)."""
    sources = defaultdict(list)
    for row in rows:
        sources[row[1]].append((row[0] is not None, row[0] or 0, plain_leaf(row), row))
    keys = sorted(sources, key=lambda s: (s is not None, (s or "").encode()))
    trees = {}
    for key in keys:
        sources[key].sort(key=lambda x: x[:3])
        trees[key] = plain_tree([x[2] for x in sources[key]])
    root, above = plain_tree([trees[k][0] for k in keys])
    out = []
    for key, rest in zip(keys, above):
        for (_, _, leaf, row), path in zip(sources[key], trees[key][1]):
            doc, text = row[0], row[4]
            if doc is not None and text is not None and zlib.crc32(str(doc).encode()) % 5 == 0:
                row = (*row[:4], text.translate(LOWER))
            folded = plain_leaf(row)
            for before, after in path + rest:
                folded = digest(*before, folded, *after)
            proof = digest(*[d for before, after in path + rest for d in before + after])
            out.append((doc, leaf, trees[key][0], root, proof, folded, folded == root))
    return Counter(out)


def plain_rows(df):
    return [tuple(r) for r in df.select(*merkle.FIELDS).collect()]


def result(df):
    return Counter(tuple(r) for r in df.select(*COLUMNS).collect())


def test_whole_table(spark, sf_dir):
    want = plain_proofs(plain_rows(table(spark, sf_dir, "documents")))
    assert {w[-1] for w in want} == {True, False}
    assert result(queries()["op12_merkle_manifest"](spark, sf_dir)) == want


@pytest.mark.parametrize("height", [1, 3])
def test_many_blocks_sources_and_odd_rows(spark, monkeypatch, height):
    """Blocks of 16 leaves: several tables above the documents and above the sources."""
    monkeypatch.setattr(merkle, "HEIGHT", height)
    monkeypatch.setattr(merkle, "BLOCK", merkle.FAN**height)
    rng = random.Random(height)
    rows = [(r[0], r[1], r[2], r[3], r[4]) for r in odd_rows()]
    rows += [(i, f"Text {rng.random()}", None, "hot", i) for i in range(700)]
    rows += [(7, "Twice", "en", "hot", 1)] * 40 + [(None, "No id", "en", "hot", 1)] * 3
    rows += [(1000 + i, "Some", "en", f"source {i}", 1) for i in range(300)]
    rows += [(-5, "Minus", "en", "é", 1), (-4, "", "en", "Z", 1), (-3, None, "en", "", None)]
    docs = documents(spark, rows).selectExpr("*", "1 as leaf", "2 as key", "3 as number", "4 as candidate")
    assert result(merkle.checked_proofs(docs)) == plain_proofs(plain_rows(docs))


def test_proofs_lead_to_the_root_and_changes_are_seen(spark):
    rows = [(i, f"text {i}", "en", f"s{i % 3}", i) for i in range(100)]
    built = merkle.manifest(documents(spark, rows))
    proofs = built.proofs()
    same = proofs.where(merkle.folded("leaf", "path") == proofs["root"])
    assert same.count() == 100
    assert {bytes(r["root"]) for r in proofs.collect()} == {built.root}
    swapped = proofs.selectExpr("sha2('other', 256) as text", "path", "root").selectExpr("unhex(text) as leaf", "path", "root")
    assert swapped.where(merkle.folded("leaf", "path") == swapped["root"]).count() == 0
    assert built.subroots().count() == 3


def test_empty_table(spark):
    docs = documents(spark, odd_rows()).limit(0)
    assert merkle.checked_proofs(docs).collect() == []
    assert merkle.manifest(docs).root is None


@pytest.mark.parametrize("leaves", [1, 2, 15, 16, 17, 255, 256, 257, 300, 4095, 4096])
def test_layout_is_a_van_emde_boas_order(leaves):
    for height in {merkle.height_of(leaves), 3}:
        levels = [-(-leaves // 16**k) for k in range(height + 1)]
        at = [merkle.addresses(leaves, height, k, np.arange(n)) for k, n in enumerate(levels)]
        assert sorted(np.concatenate(at).tolist()) == list(range(sum(levels)))
        assert at[height].tolist() == [0]
        if height == 3:  # the top two levels lie before all others; each bottom tree is one stretch
            top = levels[2] + levels[3]
            assert max(at[2].max(), at[3].max()) == top - 1
            for tree in range(levels[1]):
                own = [at[1][tree], *at[0][16 * tree : 16 * tree + 16]]
                assert own == list(range(own[0], own[0] + len(own)))


def test_one_path_equals_all_paths():
    leaves = b"".join(hashlib.sha256(bytes([i % 256, i // 256])).digest() for i in range(300))
    nodes = merkle._nodes(merkle.build_block(leaves, 3))
    every = merkle.all_siblings(nodes, 300, 3)
    for i in (0, 15, 16, 255, 256, 299):
        path = list(merkle.siblings(nodes, 300, 3, i))
        assert path == every[i]
        assert merkle.fold(leaves[32 * i : 32 * i + 32], path) == nodes[0].tobytes()
