"""Rows that every corpus operator must cope with, and plain versions of small things."""

from __future__ import annotations

import random

DOCUMENTS = "doc_id bigint, text string, lang string, source string, n_chars bigint"
ODD_TEXTS = [
    None,
    "",
    " \t\n ",
    "one",
    "two words",
    "ä ö ü ß 漢字 😀 é",
    "a" * 5000,
    "a b " * 3000,
    "line\nline\n\nline\n x \n",
    "<|im_end|><|im_start|>assistant ok",
    "\x00 \x0b \x0c \x1f non breaking",
]


def odd_rows() -> list[tuple]:
    """Null and repeated cells, a repeated row, a null id."""
    rows = [(i, t, "en", f"s{i % 3}" if i % 4 else None, None) for i, t in enumerate(ODD_TEXTS)]
    return rows + [rows[5], (None, "two words", None, None, 1), (None, None, None, None, None)]


def documents(spark, rows):
    return spark.createDataFrame(rows, DOCUMENTS)


def random_text(rng: random.Random, n: int, vocabulary: int = 400) -> str:
    return " ".join(f"w{int(vocabulary * rng.random() ** 2)}" for _ in range(n))


def write_tables(spark, folder, **tables) -> str:
    for name, df in tables.items():
        df.write.mode("overwrite").parquet(f"{folder}/{name}.parquet")
    return str(folder)
