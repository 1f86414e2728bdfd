"""Spelling variants: words one edit apart, found with a bit-sliced position index.

The vocabulary of a block of words is held vertically: for each position and letter one bitset of the words
that have this letter there. A query runs over its letters and keeps two sets of words, bit by bit in whole
machine words: those that agree so far (zero errors), and those that have differed once. One step narrows
both with the bitset of the next letter; words leave the first set and enter the second where they differ.
What the second set is narrowed with afterwards says which edit it was: the same position (a letter
replaced), the next one (a letter more in the word of the vocabulary) or the one before (a letter less).
Bits are ordered by falling count, then by word, so a word's form is the first bit of its result.

How work is dealt. Only words of lengths n and n + 1 can be near. Where they first differ is one position
between 0 and n, so every near pair belongs to exactly one class n and one window of positions. Words of a
class are grouped by the letters outside the window, which both words of a pair share; queries count errors
only inside it. The first window holds all positions. While a group is too large for a block, its window is
cut in half and its words go to two smaller groups. In a window of one position only words that share all
other letters remain, at most the square of the alphabet. So no group grows with the data, also where a
third of the vocabulary begins alike, nothing is dropped, and a pair is met once. Small groups of the same
class and window share a block. Each block answers with one row per word that has near words, not per pair.

Edge cases: null and empty texts have no words; a null id counts as empty in the hash that picks the runs
that lose a letter; words of any length take part, and blocks are limited by letters, not words; ties in
count go to the smaller word; repeated rows count again; an empty table gives no words; other columns,
whatever their names, are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from flowledger.llm.common import Steps, crc32_sql, text_of

RUN_PATTERN = r"[A-Za-zÀ-ÿ]+"  # fixed: what a word is made of
TYPOS = 97  # runs whose checksum this divides lose a letter
MIN_LETTERS = 5
MIN_COUNT = 3
FORM_RATIO = 2  # a form is at least so many times as frequent as the word

BLOCK_LETTERS = 1 << 16  # letters of the words of a block, and of a group that is not cut further
TILE = 1 << 15  # machine words of a bitset a task works on at a time

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_GROUP = ["n", "lo", "hi", "letters"]


# --- the index -----------------------------------------------------------------------------------------


class PositionIndex:
    """Bitsets of words of one length by position and letter."""

    def __init__(self, words: np.ndarray):
        """`words`: letters as numbers, one row per word, best word first."""
        self.count, self.length = words.shape
        self.width = -(-self.count // 64)  # machine words of a bitset
        self.letters, self.planes = [], []
        for column in words.T:
            letters, which = np.unique(column, return_inverse=True)
            bits = np.zeros((len(letters) + 1, 64 * self.width), bool)  # the last set stays empty
            bits[which, np.arange(self.count)] = True
            self.letters.append(letters)
            self.planes.append(np.packbits(bits, axis=1, bitorder="little").view("<u8"))

    def all(self, queries: int) -> np.ndarray:
        bits = np.arange(64 * self.width) < self.count
        return np.tile(np.packbits(bits, bitorder="little").view("<u8"), (queries, 1))

    def having(self, position: int, letters: np.ndarray) -> np.ndarray:
        """Per query the words that have its letter at a position."""
        known = self.letters[position]
        at = np.minimum(np.searchsorted(known, letters), len(known) - 1)
        return self.planes[position][np.where(known[at] == letters, at, len(known))]


def replaced(index: PositionIndex, queries: np.ndarray, lo: int, hi: int) -> np.ndarray:
    """Words of the queries' length that differ from them in one letter, inside the window."""
    zero, one = index.all(len(queries)), np.zeros((len(queries), index.width), np.uint64)
    for i in range(index.length):
        same = index.having(i, queries[:, i])
        one &= same
        if lo <= i < hi:
            one |= zero & ~same
        zero &= same
    return one


def longer(index: PositionIndex, queries: np.ndarray, lo: int, hi: int) -> np.ndarray:
    """Words with one letter more than the queries, first different inside the window."""
    zero, one = index.all(len(queries)), np.zeros((len(queries), index.width), np.uint64)
    n = index.length - 1
    for i in range(n):
        same = index.having(i, queries[:, i])
        if lo <= i < hi:
            one |= zero & ~same
        one &= index.having(i + 1, queries[:, i])
        zero &= same
    if lo <= n < hi:
        one |= zero
    return one


def shorter(index: PositionIndex, queries: np.ndarray, lo: int, hi: int) -> np.ndarray:
    """Words with one letter less than the queries, first different inside the window."""
    zero, one = index.all(len(queries)), np.zeros((len(queries), index.width), np.uint64)
    n = index.length
    for i in range(n + 1):
        if i:
            one &= index.having(i - 1, queries[:, i])
        same = index.having(i, queries[:, i]) if i < n else np.uint64(0)
        if lo <= i < hi:
            one |= zero & ~same
        if i < n:
            zero &= same
    return one


def first_bits(sets: np.ndarray) -> np.ndarray:
    """The lowest bit of each row of bitsets that has any."""
    at = np.argmax(sets != 0, axis=1)
    word = sets[np.arange(len(sets)), at]
    return 64 * at + np.bitwise_count((word & (~word + np.uint64(1))) - np.uint64(1))


def near_words(words: list[str], n: int, lo: int, hi: int, letters: int = BLOCK_LETTERS):
    """For each of the words (of lengths n and n + 1, best first): how many others are near, and the place
    of the first of them, -1 without any. Only pairs that first differ inside the window count."""
    sizes = np.array([len(w) for w in words])
    count, best = np.zeros(len(words), np.int64), np.full(len(words), len(words), np.int64)
    places = {length: np.flatnonzero(sizes == length) for length in (n, n + 1)}
    rows = {
        length: np.frombuffer("".join([words[p] for p in at]).encode("utf-32-le"), "<u4").reshape(len(at), length)
        for length, at in places.items()
    }
    for length, ask in ((n, ((n, replaced), (n + 1, shorter))), (n + 1, ((n, longer),))):
        step = max(1, letters // length)
        for begin in range(0, len(places[length]), step):  # words of the index
            index = PositionIndex(rows[length][begin : begin + step])
            own = places[length][begin : begin + step]
            tile = max(1, TILE // index.width)
            for asked, search in ask:
                for at in range(0, len(places[asked]), tile):
                    found = search(index, rows[asked][at : at + tile], lo, hi)
                    hits = np.bitwise_count(found).sum(axis=1, dtype=np.int64)
                    some = np.flatnonzero(hits)
                    who = places[asked][at : at + tile][some]
                    count[who] += hits[some]
                    best[who] = np.minimum(best[who], own[first_bits(found[some])])
    return count, np.where(count > 0, best, -1)


# --- words ---------------------------------------------------------------------------------------------


def runs() -> Column:
    """Runs of letters of a document as an array, some of them without a letter."""
    found = F.regexp_extract_all(F.translate(text_of("text"), _UPPER, _LOWER), F.lit(RUN_PATTERN), F.lit(0))
    doc = F.coalesce(F.col("doc_id").cast("string"), F.lit(""))

    def spelled(run: Column) -> Column:
        checksum = F.crc32(F.concat(doc, F.lit(":"), run).cast("binary"))
        gone = (checksum % F.char_length(run)).cast("int")
        without = F.concat(F.substring(run, F.lit(1), gone), F.substring(run, gone + 2, F.char_length(run)))
        return F.when(checksum % TYPOS == 0, without).otherwise(run)

    return F.transform(found, spelled)


def vocabulary(docs: DataFrame, min_letters: int = MIN_LETTERS, min_count: int = MIN_COUNT) -> DataFrame:
    """(word, n) of the words of all texts that are long and frequent enough."""
    words = docs.select(F.explode(runs()).alias("word")).where(F.char_length("word") >= min_letters)
    return words.groupBy("word").agg(F.count("*").alias("n")).where(F.col("n") >= min_count)


# --- dealing -------------------------------------------------------------------------------------------


def _outside() -> Column:
    """Hash of the letters outside the window: the first `lo` and the last n - hi. Groups of the same hash
    may fall together, which only makes them larger."""
    n_after = F.greatest(F.col("n") - F.col("hi"), F.lit(0))
    after = F.substring(F.col("word"), F.char_length("word") - n_after + 1, n_after)
    return F.xxhash64(F.substring(F.col("word"), F.lit(1), F.col("lo")), after)


def _windows(words: DataFrame) -> DataFrame:
    """Every word in its two classes, with the window of all positions."""
    length = F.char_length("word")
    rows = words.select("word", F.col("n").alias("freq"), F.explode(F.array(length, length - 1)).alias("n"))
    rows = rows.withColumns({"lo": F.lit(0), "hi": F.col("n") + 1})
    return rows.withColumn("letters", _outside())


def _halves(rows: DataFrame) -> DataFrame:
    middle = F.call_function("div", F.col("lo") + F.col("hi"), F.lit(2)).cast("int")
    half = F.explode(
        F.array(
            F.struct(F.col("lo"), middle.alias("hi")), F.struct(middle.alias("lo"), F.col("hi"))
        )
    )
    cut = rows.select("word", "freq", "n", half.alias("window")).select("word", "freq", "n", "window.*")
    return cut.withColumn("letters", _outside())


def deal(words: DataFrame, steps: Steps, block_letters: int = BLOCK_LETTERS) -> DataFrame:
    """(word, freq, n, lo, hi, block): the words of every block, at most about `block_letters` letters each."""
    done, rows = [], steps.stage(_windows(words))
    weight = F.sum(F.char_length("word")).alias("weight")
    while True:  # a window halves each time: as many rounds as the longest word's length has bits
        too_large = (F.col("weight") > block_letters) & (F.col("hi") - F.col("lo") > 1)
        groups = steps.stage(rows.groupBy(*_GROUP).agg(weight).where(too_large).select(*_GROUP))
        done.append(rows.join(groups, _GROUP, "left_anti"))
        if groups.isEmpty():
            break
        rows = steps.stage(_halves(rows.join(groups, _GROUP, "left_semi")))
    dealt = done[0]
    for more in done[1:]:
        dealt = dealt.unionByName(more)
    dealt = steps.stage(dealt)
    blocks = dealt.groupBy("n", "lo", "hi").agg(
        F.ceil(F.sum(F.char_length("word")) / block_letters).alias("blocks")
    )  # as many rows as there are lengths and windows
    return dealt.join(blocks, ["n", "lo", "hi"]).withColumn("block", F.pmod("letters", "blocks"))


def near(words: DataFrame, steps: Steps, block_letters: int = BLOCK_LETTERS) -> DataFrame:
    """(word, n_near, best) of every word that has near ones; `best` is the most frequent of them, as a
    struct of its negative count and itself."""
    members = F.sort_array(F.collect_list(F.struct((-F.col("freq")).alias("minus"), "word")))
    blocks = deal(words, steps, block_letters).groupBy("n", "lo", "hi", "block").agg(members.alias("members"))

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                listed, minus = [m["word"] for m in row["members"]], [m["minus"] for m in row["members"]]
                count, best = near_words(listed, row["n"], row["lo"], row["hi"], block_letters)
                some = np.flatnonzero(count).tolist()
                columns = [
                    [listed[i] for i in some],
                    count[some].tolist(),
                    [minus[best[i]] for i in some],
                    [listed[best[i]] for i in some],
                ]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(columns, _FOUND.types, strict=True)], schema=_FOUND
                )

    found = blocks.mapInArrow(search, "word string, n_near bigint, minus bigint, form string")
    return found.groupBy("word").agg(
        F.sum("n_near").alias("n_near"), F.min(F.struct("minus", "form")).alias("best")
    )


_FOUND = pa.schema(
    [("word", pa.string()), ("n_near", pa.int64()), ("minus", pa.int64()), ("form", pa.string())]
)


def roots(forms: DataFrame, steps: Steps) -> DataFrame:
    """(word, root) of every word that has a form, following forms to the last.

    Counts at least double along the way, so there are no circles, and each round doubles how far a word
    has followed: rounds grow with the logarithm of the logarithm of the largest count."""
    reached = steps.stage(forms.select("word", F.col("form").alias("root")))
    while True:
        ahead = reached.select(F.col("word").alias("root"), F.col("root").alias("next"))
        moved = steps.stage(
            reached.join(ahead, "root", "left").select("word", "root", "next")
        )
        reached = moved.select("word", F.coalesce("next", "root").alias("root"))
        if moved.where("next IS NOT NULL").isEmpty():
            return reached


def variants(
    docs: DataFrame,
    min_letters: int = MIN_LETTERS,
    min_count: int = MIN_COUNT,
    block_letters: int = BLOCK_LETTERS,
) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of every word of the texts; see the module text."""
    steps = Steps(docs.sparkSession)
    words = steps.stage(vocabulary(docs, min_letters, min_count))
    found = words.join(near(words, steps, block_letters), "word", "left")
    most = -F.col("best.minus")
    has_form = most >= FORM_RATIO * F.col("n")
    judged = steps.stage(
        found.select(
            "word",
            F.when(has_form, F.col("best.form")).alias("form"),
            "n",
            F.coalesce("n_near", F.lit(0)).cast("bigint").alias("n_near"),
            F.when(has_form, most).alias("form_n"),
        )
    )
    ends = roots(judged.where("form IS NOT NULL"), steps)
    joined = judged.join(ends, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )
    written = Steps(docs.sparkSession).stage(joined)
    steps.drop()
    return written


def oracle_sql() -> str:
    return f"""
WITH RECURSIVE found AS (
  SELECT doc_id, unnest(regexp_extract_all(translate(text, '{_UPPER}', '{_LOWER}'), '[a-zÀ-ÿ]+')) AS run FROM documents
), counted AS (
  SELECT doc_id, run, count(*) AS times, hex(encode(coalesce(doc_id::VARCHAR, '') || ':' || run)) AS digits
  FROM found GROUP BY ALL
), hashed AS (
  SELECT run, times, {crc32_sql('digits')} AS h FROM counted
), words AS (
  SELECT CASE WHEN h % {TYPOS} = 0 THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word,
    sum(times)::BIGINT AS n
  FROM hashed GROUP BY 1 HAVING length(word) >= {MIN_LETTERS} AND sum(times) >= {MIN_COUNT}
), cut AS (
  SELECT word, n, i, substr(word, 1, i) || substr(word, i + 2) AS rest
  FROM (SELECT word, n, unnest(range(length(word))) AS i FROM words)
), pairs AS (
  SELECT a.word, b.word AS other, b.n AS other_n FROM cut a JOIN cut b ON a.i = b.i AND a.rest = b.rest AND a.word <> b.word
  UNION
  SELECT c.word, w.word, w.n FROM cut c JOIN words w ON w.word = c.rest
  UNION
  SELECT w.word, c.word, c.n FROM cut c JOIN words w ON w.word = c.rest
), best AS (
  SELECT word, count(*) AS n_near, max(other_n) AS top FROM pairs GROUP BY word
), judged AS (
  SELECT w.word, w.n, coalesce(n_near, 0) AS n_near, CASE WHEN top >= {FORM_RATIO} * w.n THEN top END AS form_n,
    CASE WHEN top >= {FORM_RATIO} * w.n THEN (SELECT min(other) FROM pairs p WHERE p.word = w.word AND p.other_n = top) END AS form
  FROM words w LEFT JOIN best USING (word)
), walk AS (
  SELECT word, word AS root, form AS next FROM judged
  UNION ALL
  SELECT walk.word, next, j.form FROM walk JOIN judged j ON j.word = walk.next
)
SELECT word, form, root, n, n_near, form_n FROM judged JOIN walk USING (word) WHERE next IS NULL
"""
