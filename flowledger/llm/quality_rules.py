"""Quality rules: heuristic counts, then a hashed n-gram log-likelihood ratio.

Two multinomials over hashed n-grams are estimated, one from trusted documents and one from the whole
raw corpus (in the manner of importance resampling by hashed n-gram features). A document's score is
the mean over its n-grams of log(p_trusted / p_raw); it is kept if the mean is not below a fixed
threshold. No randomness is involved, and each document is judged by its whole text.

The n-grams are whole words and pairs of neighbouring words, hashed with all their characters.

Everything is DataFrame and SQL functions. The per-document counts are array functions inside one row,
so no text is shuffled; only bucket counts (at most `BUCKETS` rows per task) are.

Edge cases: a null text is empty; a text without words has no n-grams, score null, and fails the base
rule; without trusted documents both multinomials are equal, the ratio is 0 and the base rule decides.
Null ids are kept as they are and trusted never; repeated rows are judged alike; other columns pass.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from flowledger.llm.common import SPACE_CHARS, free_name, text_of, word_list

BUCKETS = 1 << 14  # hashed n-gram space; also the bound of the table each task holds
TRUSTED_ROWS = 20_000  # bound of the sample of labelled documents the trusted multinomial is fitted on
SMOOTHING = 1.0  # added to every bucket of both multinomials
THRESHOLD = -0.2  # lowest mean log-likelihood ratio (nats per n-gram) that is kept

WINDOW = 5  # words of a repeated window
MIN_WORDS = 10
MAX_REPEAT_PERCENT = 20
SYMBOLS = "[#*$%&|<>]"

COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def trusted_ids(labels: DataFrame, rows: int = TRUSTED_ROWS) -> DataFrame:
    """Ids of documents labelled good and not toxic: at most `rows`, chosen by hash, same every time."""
    good = labels.where((F.col("quality") == 1) & (F.coalesce(F.col("toxic"), F.lit(0)) == 0))
    ids = good.where(F.col("doc_id").isNotNull()).select("doc_id").distinct()
    return ids.orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)


def with_next(df: DataFrame, words: str) -> tuple[DataFrame, str]:
    """Add, beside each word, the next one (the list ends one word earlier)."""
    following = free_name(df, "_next")
    rest = F.slice(words, F.lit(2), F.greatest(F.size(words) - 1, F.lit(0)))
    return df.withColumn(following, rest), following


def _bucket(*parts, buckets: int) -> Column:
    return F.pmod(F.xxhash64(*parts), F.lit(buckets)).cast("int")


def _repeat_words(df: DataFrame, words: str, out: str) -> DataFrame:
    """Words inside `WINDOW`-word windows that occur twice or more in the same text."""
    windows, ranked, starts = (free_name(df, n) for n in ("_windows", "_ranked", "_starts"))
    # a window at every word: the look-ahead takes five words, the match itself only steps one word on
    five = "(?=(" + " ".join(["[^ ]++"] * WINDOW) + "))[^ ]++ "
    df = df.withColumn(
        windows, F.regexp_extract_all(F.array_join(words, " "), F.lit(five), F.lit(1))
    )
    repeated = F.size(F.array_distinct(windows)) < F.size(windows)
    # equal windows become neighbours; only texts that have any are sorted
    df = df.withColumn(
        ranked,
        F.when(
            repeated,
            F.sort_array(
                F.transform(windows, lambda x, i: F.struct(F.xxhash64(x).alias("h"), i.alias("i")))
            ),
        ),
    )

    def same(p, at):
        return F.coalesce(F.get(F.col(ranked), at)["h"] == p["h"], F.lit(False))

    found = F.filter(ranked, lambda p, j: same(p, j - 1) | same(p, j + 1))
    df = df.withColumn(starts, F.sort_array(F.transform(found, lambda p: p["i"])))
    # each window adds its words up to the start of the next one
    covered = F.aggregate(
        F.transform(
            starts,
            lambda s, j: F.least(
                F.lit(WINDOW), F.coalesce(F.get(F.col(starts), j + 1) - s, F.lit(WINDOW))
            ),
        ),
        F.lit(0).cast("bigint"),
        lambda a, b: a + b,
    )
    df = df.withColumn(out, F.coalesce(covered, F.lit(0).cast("bigint")))
    return df.drop(windows, ranked, starts)


def base_counts(docs: DataFrame, text: str, words: str) -> DataFrame:
    """Add the columns of `COUNTS` and `base_failed`; `words` holds the word list of `text`."""
    lines = F.filter(
        F.split(F.col(text), "\n"), lambda x: F.btrim(x, F.lit(SPACE_CHARS)) != ""
    )
    kept_lines = free_name(docs, "_lines")
    df = docs.withColumn(kept_lines, lines).withColumns(
        {
            "n_words": F.size(words).cast("bigint"),
            "word_chars": F.char_length(F.array_join(words, "")).cast("bigint"),
            "n_symbols": F.regexp_count(F.col(text), F.lit(SYMBOLS)).cast("bigint"),
            "n_dup_lines": (F.size(kept_lines) - F.size(F.array_distinct(kept_lines))).cast("bigint"),
        }
    )
    df = _repeat_words(df.drop(kept_lines), words, "n_repeat_words")
    failed = (F.col("n_words") < MIN_WORDS) | (
        100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words")
    )
    return df.withColumn("base_failed", failed)


def fit_ratio(docs: DataFrame, trusted: DataFrame, buckets: int = BUCKETS) -> list[float]:
    """log(p_trusted / p_raw) of every bucket, from whole texts of all documents.

    The result has `buckets` numbers whatever the corpus size.
    """
    trusted = F.broadcast(trusted.select(F.col("doc_id").alias("_trusted_id")))  # <= TRUSTED_ROWS ids
    words = docs.select("doc_id", word_list(text_of("text")).alias("_words"))
    flagged = words.join(trusted, F.col("doc_id") == F.col("_trusted_id"), "left")
    paired, following = with_next(flagged, "_words")
    ngrams = paired.select(
        F.col("_trusted_id").isNotNull().cast("bigint").alias("_in"),
        F.explode(F.arrays_zip(F.col("_words").alias("a"), F.col(following).alias("b"))).alias("g"),
    )
    a, b = F.col("g.a"), F.col("g.b")
    both = F.array(_bucket(a, buckets=buckets), F.when(b.isNotNull(), _bucket(a, b, buckets=buckets)))
    hashed = ngrams.select("_in", F.explode(both).alias("bucket")).where("bucket is not null")
    counted = hashed.groupBy("bucket").agg(
        F.count("*").alias("n"), F.sum("_in").alias("trusted")
    )
    raw, good = [0] * buckets, [0] * buckets
    for row in counted.collect():  # at most `buckets` rows
        raw[row["bucket"]], good[row["bucket"]] = row["n"], row["trusted"]
    return log_ratio(good, raw)


def log_ratio(good: list[int], raw: list[int]) -> list[float]:
    import math

    if not sum(good):
        return [0.0] * len(raw)
    extra = SMOOTHING * len(raw)
    all_good, all_raw = math.log(sum(good) + extra), math.log(sum(raw) + extra)
    return [
        math.log(g + SMOOTHING) - all_good - math.log(r + SMOOTHING) + all_raw
        for g, r in zip(good, raw, strict=True)
    ]


def with_mean_ratio(df: DataFrame, words: str, ratio: list[float], out: str) -> DataFrame:
    """Add the mean of the ratios of a document's n-grams, null without any."""
    # one foldable text: the optimizer turns it into a constant array
    constant = F.split(F.lit(",".join(map(repr, ratio))), ",").cast("array<double>")
    n = len(ratio)

    def at(a, b):
        alone = F.get(constant, _bucket(a, buckets=n))
        return F.when(b.isNull(), alone).otherwise(alone + F.get(constant, _bucket(a, b, buckets=n)))

    df, following = with_next(df, words)
    total = F.aggregate(
        F.zip_with(words, following, at), F.lit(0.0), lambda acc, x: acc + x
    )
    mean = F.when(F.size(words) > 0, total / (2 * F.size(words) - 1))
    return df.withColumn(out, mean).drop(following)


def judge(
    docs: DataFrame, ratio: list[float], threshold: float = THRESHOLD
) -> DataFrame:
    """`docs` with the counts, `base_failed`, `score` and `kept`."""
    text, words = free_name(docs, "_text"), free_name(docs, "_words")
    df = docs.drop(*COUNTS, "base_failed", "score", "kept").withColumn(text, text_of("text"))
    df = base_counts(df.withColumn(words, word_list(F.col(text))), text, words)
    df = with_mean_ratio(df, words, ratio, "score").drop(text, words)
    kept = ~F.col("base_failed") & (F.coalesce(F.col("score"), F.lit(0.0)) >= threshold)
    # The last term is always true. Since it isn't deterministic, the optimizer leaves a filter on `kept`
    # above this projection; pushed down, it would evaluate the array functions within one another.
    return df.withColumn("kept", kept & (F.monotonically_increasing_id() >= 0))


def quality_rules(
    docs: DataFrame,
    labels: DataFrame,
    threshold: float = THRESHOLD,
    trusted_rows: int = TRUSTED_ROWS,
    buckets: int = BUCKETS,
) -> DataFrame:
    """Judge every document; see the module text for the method and the edge cases."""
    ratio = fit_ratio(docs, trusted_ids(labels, trusted_rows), buckets)
    return judge(docs, ratio, threshold)
