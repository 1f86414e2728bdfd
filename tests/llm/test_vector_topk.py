from __future__ import annotations

import math

import duckdb
import numpy as np
import pytest

from flowledger.llm import vector_topk as vt
from flowledger.llm.queries import oracle_sql, queries

SCHEMA = "vec_id bigint, embedding array<float>, label int"


def plain(rows, k=5, every=50):
    whole = [
        (i, [min(max(math.floor(256 * float(np.float32(x))), -(2**63)), 2**63 - 1) for x in v])
        for i, v, *_ in rows
        if v is not None and all(x is not None and math.isfinite(x) for x in v)
    ]
    out = []
    for a, (i, q) in enumerate(whole):
        if i is None or i % every:
            continue
        scores = [
            (-max(min(sum(x * y for x, y in zip(q, v)), 2**63 - 1), -(2**63)), j is None, j or 0)
            for b, (j, v) in enumerate(whole)
            if a != b
        ]
        for rank, (s, none, j) in enumerate(sorted(scores)[:k], 1):
            out.append((i, rank, None if none else j, -s))
    return sorted(out, key=str)


def found(df):
    return sorted(map(tuple, df.collect()), key=str)


@pytest.mark.parametrize("block_rows, query_rows", [(4096, 512), (17, 3)])
def test_against_all_pairs(spark, block_rows, query_rows):
    rng = np.random.default_rng(4)
    centres = rng.normal(size=(6, 20))
    rows = [(i, (centres[i % 6] + 0.3 * rng.normal(size=20)).tolist(), 1) for i in range(300)]
    rows += [(1000 + i, rows[0][1], 1) for i in range(30)]  # ties
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    got = vt.top_k(df, every=10, block_rows=block_rows, query_rows=query_rows)
    assert found(got) == plain(rows, every=10)


def test_whole_table_against_sql(spark, sf_dir):
    got = found(queries()["op9_exact_top_k"](spark, sf_dir))
    with duckdb.connect() as db:
        db.execute(f"CREATE VIEW embeddings AS FROM '{sf_dir}/embeddings.parquet'")
        assert got == sorted(db.execute(oracle_sql()["op9_exact_top_k"]).fetchall(), key=str)


def test_odd_rows_empty_tables_and_clashing_names(spark):
    rows = [
        (0, [1.0, 2.0, -3.0], 1),
        (50, [0.5, float("nan"), 1.0], 1),
        (100, None, 1),
        (150, [1.0, None, 1.0], 1),
        (200, [float("inf"), 1.0, 1.0], None),
        (250, [1.0], 1),
        (300, [], 1),
        (7, [2.0, 2.0, 2.0, 2.0], 1),
        (7, [2.0, 2.0, 2.0, 2.0], 1),
        (50, [1e20, 1.0], 1),
        (50, [1e20, 1.0], 1),
        (None, [1.0, 1.0, 1.0], 1),
        (-50, [-1.0, -0.001, 0.0], 1),
    ]
    df = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 as rank", "2 as block", "3 as id", "4 as cells")
    small = [r for r in rows if not (r[1] and 1e20 in r[1])]
    assert found(vt.top_k(df.where("not array_contains(embedding, float(1e20)) or embedding is null "
                                   "or array_contains(embedding, float(1e20)) is null"))) == plain(small)
    assert found(vt.top_k(df)) == plain(rows)
    edge = [(50 * i, [v, 5.0], 1) for i, v in enumerate((-(2.0**55), 2.0**55, -1e30, 1e30, -1.0, 0.0))]
    assert found(vt.top_k(spark.createDataFrame(edge, SCHEMA))) == plain(edge)
    assert vt.top_k(df.limit(0)).collect() == []
    assert vt.top_k(df.where("vec_id = 7")).collect() == []
    assert vt.top_k(df.where("vec_id = 0")).collect() == []
