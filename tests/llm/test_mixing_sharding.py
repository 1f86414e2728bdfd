from __future__ import annotations

import random
import re
from collections import Counter, defaultdict

import duckdb
import pytest

from flowledger.llm import mixing, sharding
from flowledger.llm.common import table
from flowledger.llm.queries import oracle_sql, queries
from llm.helpers import documents, odd_rows, random_text


def plain_targets(sizes):
    """Excess goes to the others by weight until no target is above three times its source."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: (1, 2, 3)[i % 3] for i, s in enumerate(names)}
    left, open_, target = sum(sizes.values()), set(names), {}
    while open_:
        all_weight = sum(weight[s] for s in open_)
        above = [s for s in open_ if left * weight[s] / all_weight > 3 * sizes[s]]
        if not above:
            return target | {s: left * weight[s] / all_weight for s in open_}
        for s in above:
            target[s] = 3 * sizes[s]
        left -= sum(target[s] for s in above)
        open_ -= set(above)
    return target


def size_of(text):
    return len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))


def check_mix(rows, got):
    sizes = Counter()
    for r in rows:
        sizes[r[3]] += size_of(r[1])
    target = plain_targets(sizes)
    key = lambda x: tuple((v is None, v) for v in x)
    assert sorted(((g["doc_id"], g["size"]) for g in got), key=key) == sorted(
        ((r[0], size_of(r[1])) for r in rows), key=key
    )
    source = {r[0]: r[3] for r in rows}
    taken = defaultdict(int)
    for g in got:
        s = source[g["doc_id"]]
        assert g["source_size"] == sizes[s]
        assert g["target"] == pytest.approx(target[s], abs=1e-6)
        assert g["size"] == 0 or g["taken"] % g["size"] == 0
        assert 0 <= g["taken"] <= 3 * g["size"]
        taken[s] += g["taken"]
    return sizes, target, taken


def test_targets_and_words_taken(spark):
    rng = random.Random(3)
    share = {"a": 400, "b": 40, "c": 30, "é": 3, None: 60}
    rows, i = [], 0
    for source, n in share.items():
        for _ in range(n):
            rows.append((i, random_text(rng, rng.randrange(1, 60)), "en", source, 1))
            i += 1
    docs = documents(spark, rows)
    got = mixing.mix_sizes(docs).collect()
    sizes, target, taken = check_mix(rows, got)
    for s in share:
        assert abs(taken[s] - target[s]) <= 60 + 0.02 * target[s]
    again = mixing.mix_sizes(docs.repartition(7)).collect()
    assert sorted(map(tuple, got)) == sorted(map(tuple, again))
    emitted = Counter(r["doc_id"] for r in mixing.emit(docs).collect())
    assert emitted == Counter({g["doc_id"]: g["copies"] for g in got if g["copies"]})


def test_odd_rows_empty_tables_and_clashing_names(spark):
    rows = odd_rows()
    docs = documents(spark, rows)
    assert len(mixing.mix_sizes(docs).collect()) == len(rows)
    assert mixing.mix_sizes(docs.limit(0)).collect() == []
    assert {r["taken"] for r in mixing.mix_sizes(docs.where("doc_id < 3")).collect()} == {0}
    extra = docs.selectExpr("*", "1 as size", "2 as _source", "'x' as copies", "4 as shard", "5 as _cell")
    assert mixing.emit(extra).columns == extra.columns
    assert mixing.emit(extra).count() > 0
    sharded = sharding.shard(extra, 100)
    assert sharded.columns == [c for c in extra.columns if c != "shard"] + sharding.RESULT
    assert sharded.count() == len(rows)
    assert sharding.shard_sizes(docs.limit(0)).collect() == []


def check_shards(got, limit):
    shards = defaultdict(list)
    for g in got:
        shards[g["shard"]].append(g["n_bytes"])
    for name, sizes in shards.items():
        assert sum(sizes) <= limit or len(sizes) == 1
        assert not any(name != other and name.startswith(other) for other in shards)
    for g in got:
        assert g["shard_bytes"] == sum(shards[g["shard"]])
    parents = defaultdict(int)
    for name, sizes in shards.items():
        for d in range(len(name)):
            parents[name[:d]] += sum(sizes)
    assert all(size > limit for size in parents.values())  # nothing was split without need
    return shards


@pytest.mark.parametrize("limit", [1, 3000, 1 << 30])
def test_shards_fit_and_split_only_when_needed(spark, limit):
    rng = random.Random(9)
    rows = [(i, random_text(rng, rng.randrange(0, 200)), "en", "s", 1) for i in range(150)]
    got = sharding.shard_sizes(documents(spark, rows), limit).collect()
    assert len(got) == len(rows)
    shards = check_shards(got, limit)
    if limit == 1 << 30:
        assert list(shards) == [""]


def test_rows_of_one_id_are_split_too(spark):
    rows = [(7, "x" * 100, "en", "s", 1)] * 40 + [(8, "y" * 900, "en", "s", 1)]
    got = sharding.shard_sizes(documents(spark, rows), 500).collect()
    assert len(got) == 41
    assert len(check_shards(got, 500)) > 8


def on_duckdb(sf_dir, sql):
    with duckdb.connect() as db:
        db.execute(f"CREATE VIEW documents AS FROM '{sf_dir}/documents.parquet'")
        return db.execute(sql).fetchall()


@pytest.mark.parametrize("name", ["op3_mixing", "op10_sharding"])
def test_whole_table_against_sql(spark, sf_dir, name):
    got = sorted(map(tuple, queries()[name](spark, sf_dir).collect()))
    assert got == sorted(on_duckdb(sf_dir, oracle_sql()[name]))


def test_many_shards_against_sql(spark, sf_dir):
    got = sharding.shard_sizes(table(spark, sf_dir, "documents"), 20_000).collect()
    check_shards(got, 20_000)
    assert sorted(map(tuple, got)) == sorted(on_duckdb(sf_dir, sharding.oracle_sql(20_000)))
