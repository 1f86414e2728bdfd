"""What a load shuffles: keys, and of whole rows only the cells that it stores."""

from __future__ import annotations

import re
from decimal import Decimal

from helpers import AS_OF, event, events
from pyspark.sql import Window, functions as F

from flowledger.functions.numeric import exact_sum
from flowledger.operators.keyed import replace_by_key
from flowledger.operators.numbering import stage
from flowledger.operators.staging import add_temporal_metrics, prepare_staging
from flowledger.operators.validation import validate
from flowledger.plans import loads, pipeline
from flowledger.store import Warehouse


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def optimized(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_metrics_are_not_shuffled_with_every_row(spark):
    rows = [event(queue_name="old"), event(queue_name="new", completed_at="2031-03-10T10:30:00Z")]
    valid = validate(events(spark, *rows)).staged().valid
    staged = prepare_staging(valid, AS_OF).drop(*loads.NOT_LOADED)
    window = next(line for line in optimized(staged).splitlines() if "Window [" in line)
    below = optimized(staged).split(window, 1)[1]
    carried = re.findall(r"Project \[(.*)\]", below)[0]  # what goes into the window
    for name in ("age_us", "turnaround_us", "turnaround_hours", "age_hours", "processing_minutes"):
        assert f"AS {name}#" not in carried
    kept = prepare_staging(valid, AS_OF)
    wanted = add_temporal_metrics(kept, AS_OF)
    assert kept.columns == wanted.columns
    assert kept.collect() == wanted.collect()
    assert [r.queue_name for r in kept.collect()] == ["new"]


def test_stored_rows_stay_where_they_lie_where_nothing_is_replaced(spark):
    stored = stage(spark.createDataFrame([(1, "a"), (2, "b"), (None, "n")], "k bigint, v string"))
    batch = spark.createDataFrame([(3, "c"), (3, "d"), (None, "m")], "k bigint, v string")
    found = replace_by_key(stored, batch, ["k"])
    assert "Join" not in plan(found)
    assert sorted(r.v for r in found.collect()) == ["a", "b", "c", "d", "m", "n"]
    again = spark.createDataFrame([(2, "x"), (None, "m")], "k bigint, v string")
    assert sorted(r.v for r in replace_by_key(stored, again, ["k"]).collect()) == ["a", "m", "n", "x"]


def test_sums_go_beyond_64_bits(spark):
    top = (1 << 63) - 1
    numbers = spark.createDataFrame([(1, n) for n in (top, top, top, 5, -7, None)] + [(2, None)], "g int, n bigint")
    sums = numbers.groupBy("g").agg(exact_sum(F.col("n")).alias("s"))
    assert {r.g: r.s for r in sums.collect()} == {1: Decimal(3 * top - 2), 2: None}
    assert dict(sums.dtypes)["s"] == "decimal(29,0)"
    # decimal halves would be added up as decimals: slower, and three times the space
    assert "sum(cast" not in optimized(sums).replace(" as decimal", "")


def test_a_run_looks_for_repeated_source_rows_once(spark, tmp_path, monkeypatch):
    looked = []
    find = loads.firsts_of_repeated
    monkeypatch.setattr(loads, "firsts_of_repeated", lambda rows, keys: looked.append(keys) or find(rows, keys))
    store = Warehouse(spark, f"{tmp_path}/warehouse").create()
    unique = [event(workflow_id=f"REQ-{i}") for i in range(3)]
    result = pipeline.refresh_rows(store, events(spark, *unique), f"{tmp_path}/run", AS_OF)
    assert result["staging_rows"] == 3
    assert len(looked) == 1

    repeated = [event(workflow_id="REQ-8", source_row_number="1", source_file_name="b.csv") for _ in range(2)]
    other = event(workflow_id="REQ-9", source_row_number="2", source_file_name="b.csv")
    result = pipeline.refresh_rows(store, events(spark, *repeated, other), f"{tmp_path}/again", AS_OF)
    assert result["staging_rows"] == 2
    assert store["workflow_events_raw"].count() == 5


def test_parts_of_a_shuffle_stay_small_whatever_number_the_session_has(spark):
    # some 70 MB that do not compress, in a session of 4 shuffle partitions
    wide = {f"c{i}": F.xxhash64("id", F.lit(i)) for i in range(8)}
    dealt = spark.range(1_000_000).withColumns(wide)
    latest = dealt.withColumn("n", F.row_number().over(Window.partitionBy("c0").orderBy("id")))
    kept = F.bit_xor(F.xxhash64("n", *wide))
    sizes = latest.groupBy(F.spark_partition_id().alias("part")).agg(F.count("*").alias("rows"), kept).collect()
    assert sum(r.rows for r in sizes) == 1_000_000
    assert max(r.rows for r in sizes) < 150_000
