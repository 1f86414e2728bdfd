from __future__ import annotations

from flowledger.llm import quality_rules as rules
from llm import test_pipeline_and_rules as plain
from llm.helpers import documents


def test_words_of_the_same_endings_score_differently(spark):
    clean = " ".join(f"clean{i}ing" for i in range(20))
    other = " ".join(f"toxic{i}ing" for i in range(20))
    rows = [(i, clean if i < 10 else other, "en", "s", 1) for i in range(20)]
    labels = spark.createDataFrame([(i, 1, 0) for i in range(10)], plain.LABELS)
    got = {r["doc_id"]: r for r in rules.quality_rules(documents(spark, rows), labels).collect()}
    assert got[9]["kept"] and not got[10]["kept"]
    assert got[9]["score"] > got[10]["score"] + 0.2
