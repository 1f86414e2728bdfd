"""Scoring texts with a class-based bigram model.

P(word | previous word) = P(class | previous class) * P(word | class). Tokens are the words of a text, A-Z
in lower case, and one end; the end also stands before the first word. The model learns from the documents
whose CRC-32 of the id is not `HELD_OUT` modulo `FOLDS`; all documents are scored.

* Words are counted over all training documents and stay a table that grows with the corpus.
* Classes come from exchange clustering, in two steps. First units are exchanged: each of the most frequent
  words is one, all others are bundled by their last letters, the end is one of its own. Each unit moves in
  turn to the class that gives the class bigrams the highest likelihood, until no unit moves. The bigram
  counts of units have `UNITS`^2 cells whatever the corpus.
* Then every word that is not a unit of its own, however rare, leaves its bundle: the classes before and
  behind it are counted over all training documents, and it moves to the class where the likelihood gains
  most. These moves are made side by side, each against the class bigrams of the first step; a word has
  2 * `CLASSES` + 1 counts at most, so a group is small however frequent its word.
* P(class | class) and P(word | class) add one to every count; each class has one place for unknown words,
  and a word unknown to training goes by its last letters.

A task looks up count and class of the words of at least some frequency, at most `FREQUENT`, in a table it
holds. It sends on the others with their places, to be joined with the table of all words; the classes found
are filled in where they are missing in the document, one byte per token. Class bigrams are counted, and
scores summed up, over these bytes.

Words are known by a 64-bit hash of their bytes.

Edge cases: a null or empty text is its end alone; a null id hashes like an empty one (so it is in
training); texts and words of any length count whole; repeated rows are texts of their own; without
training documents all counts are zero; other columns are not used.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from flowledger.llm.rolling import POWERS, PIECE, buffer_of
from flowledger.operators.numbering import stage

FOLDS, HELD_OUT = 7, 2  # fixed values of the contract
FREQUENT = 1 << 17  # most words a task looks up in a table of its own
OWN_UNITS = 512  # frequent words that are clustered one by one
BUNDLES = 256  # units of all other words, by their last `ENDING` bytes
ENDING = 3
UNITS = OWN_UNITS + BUNDLES + 1
CLASSES = 32
ROUNDS = 20  # of the exchange, at most
SLICE = 2000  # texts a task turns into tokens at a time

_LOWER = np.array([c + 32 if 65 <= c <= 90 else c for c in range(256)], np.uint8)
_SPACE = np.array([c == 32 or 9 <= c <= 13 for c in range(256)])


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


_LETTER = _mix((np.arange(256, dtype=np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15))
END = int(_mix(_LETTER[255:])[0].view(np.int64))  # the hash of a byte that no text holds
END_BUNDLE = BUNDLES


# --- tokens -------------------------------------------------------------------------------------------


def _cuts(data: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[int, int, int, int]]:
    """(begin, end, first text, behind the last): texts together, long ones cut between words."""
    i, n = 0, len(offsets) - 1
    while i < n:
        j = max(int(np.searchsorted(offsets, offsets[i] + PIECE, "right")) - 1, i + 1)
        at, end = int(offsets[i]), int(offsets[j])
        while end - at > 2 * PIECE:
            look = at + PIECE
            while look < end and not _SPACE[data[look]]:
                spaces = np.flatnonzero(_SPACE[data[look : min(look + PIECE, end)]])
                look += int(spaces[0]) if len(spaces) else PIECE
            if look >= end:
                break
            yield at, look, i, i + 1
            at = look
        yield at, end, i, j
        i = j


def words_of(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hash, bundle and text number of every word of the texts data[offsets[i]:offsets[i+1]], in order."""
    out: list[tuple] = []
    for begin, end, first, behind in _cuts(data, offsets):
        part = _LOWER[data[begin:end]]
        if not len(part):
            continue
        inside = ~_SPACE[part]
        heads, tails = inside.copy(), inside.copy()
        heads[1:] &= ~inside[:-1]
        tails[:-1] &= ~inside[1:]
        inner = offsets[first + 1 : behind] - begin  # borders between texts
        inner = inner[(inner > 0) & (inner < len(part))]
        heads[inner] |= inside[inner]
        tails[inner - 1] |= inside[inner - 1]
        start, last = np.flatnonzero(heads), np.flatnonzero(tails)
        up, down = POWERS.upto(len(part) + 1)
        sums = np.zeros(len(part) + 1, np.uint64)
        np.cumsum(_LETTER[part] * up[: len(part)], out=sums[1:])
        hashes = _mix((sums[last + 1] - sums[start]) * down[start])
        ending = np.zeros(len(start), np.uint64)
        for k in range(ENDING):
            letter = np.where(last - k >= start, part[np.maximum(last - k, 0)], 0).astype(np.uint64)
            ending = ending * np.uint64(257) + letter
        bundle = (_mix(ending + np.uint64(1)) % np.uint64(BUNDLES)).astype(np.int32)
        text = np.searchsorted(offsets[first + 1 : behind], start + begin, "right") + first
        out.append((hashes.view(np.int64), bundle, text))
    if not out:
        return np.empty(0, np.int64), np.empty(0, np.int32), np.empty(0, np.int64)
    return tuple(np.concatenate(c) for c in zip(*out, strict=True))


def tokens_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The words of a batch of texts with an end behind each text."""
    hashes, bundle, text = words_of(*buffer_of(column))
    n = len(column)
    behind = np.searchsorted(text, np.arange(n), "right")
    return (
        np.insert(hashes, behind, END),
        np.insert(bundle, behind, END_BUNDLE),
        np.insert(text, behind, np.arange(n)),
    )


def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    return (b.slice(at, SLICE) for b in batches for at in range(0, b.num_rows, SLICE))


# --- what is learnt -----------------------------------------------------------------------------------


def _word_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in _slices(batches):
        hashes, bundle, _ = tokens_of(batch.column("text"))
        words, first, n = np.unique(hashes, return_index=True, return_counts=True)
        yield pa.RecordBatch.from_arrays(
            [pa.array(words), pa.array(bundle[first]), pa.array(n)], ["word", "bundle", "n"]
        )


@dataclass
class Model:
    """Everything a task holds; its size follows from the parameters alone."""

    tokens: int  # in training
    words: int  # different ones
    frequent: np.ndarray  # hashes in order
    counts: np.ndarray  # of the frequent words
    units: np.ndarray  # of the frequent words
    groups: np.ndarray  # classes of the frequent words
    classes: np.ndarray  # of the units
    pairs: np.ndarray  # bigrams of classes
    moves: np.ndarray  # log10 P(class | previous class)
    rooms: np.ndarray  # log10 of what divides count + 1 in P(word | class)

    def unit(self, hashes: np.ndarray, bundle: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Unit of each token, and its place among the frequent words or -1."""
        unit = bundle + OWN_UNITS
        if not len(self.frequent):
            return unit, np.full(len(hashes), -1)
        at = np.minimum(np.searchsorted(self.frequent, hashes), len(self.frequent) - 1)
        at = np.where(self.frequent[at] == hashes, at, -1)
        return np.where(at >= 0, self.units[at], unit), at


    def group(self, hashes: np.ndarray, bundle: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Class of each token, that of its bundle if it is not among the frequent words; its place there or -1."""
        at = self.unit(hashes, bundle)[1]
        group = self.classes[bundle + OWN_UNITS]
        if len(self.frequent):
            group = np.where(at >= 0, self.groups[at], group)
        return group, at


def _bigrams(batches: Iterator[pa.RecordBatch], model: Model) -> Iterator[pa.RecordBatch]:
    n = np.zeros(UNITS * UNITS, np.int64)
    for batch in _slices(batches):
        hashes, bundle, _ = tokens_of(batch.column("text"))
        unit = model.unit(hashes, bundle)[0].astype(np.int64)
        before = np.r_[OWN_UNITS + END_BUNDLE, unit[:-1]]
        n += np.bincount(before * UNITS + unit, minlength=len(n))
    found = np.flatnonzero(n)
    for at in range(0, len(found), 1 << 16):
        part = found[at : at + (1 << 16)]
        yield pa.RecordBatch.from_arrays([pa.array(part), pa.array(n[part])], ["pair", "n"])


def _n_log_n(x: np.ndarray) -> np.ndarray:
    return x * np.log(np.maximum(x, 1))


def exchange_classes(bigrams: np.ndarray, classes: int = CLASSES, rounds: int = ROUNDS) -> np.ndarray:
    """Class of each unit: moves one unit at a time to where the class bigram likelihood is highest.

    The likelihood is the sum of n log n over class pairs less that over classes, on either side. The last
    unit, the end, keeps a class of its own.
    """
    units = len(bigrams)
    weight = bigrams.sum(axis=0)
    order = np.argsort(-weight[:-1], kind="stable")
    found = np.full(units, classes - 1)
    found[order] = np.arange(units - 1) % (classes - 1)
    member = np.zeros((units, classes), np.int64)
    member[np.arange(units), found] = 1
    pairs = member.T @ bigrams @ member
    follow, precede = bigrams @ member, bigrams.T @ member  # unit -> classes behind it, before it
    diagonal = np.arange(classes - 1)
    for _ in range(rounds):
        moved = False
        for u in order:
            if not weight[u]:
                continue
            old, own = found[u], bigrams[u, u]
            after, before = follow[u].copy(), precede[u].copy()
            after[old] -= own
            before[old] -= own
            # without the unit
            pairs[old] -= after
            pairs[:, old] -= before
            pairs[old, old] -= own
            # with it in each class b: row b, column b and the crossing change
            rows, columns = pairs[:-1] + after, pairs[:, :-1].T + before
            gain = (_n_log_n(rows) - _n_log_n(pairs[:-1])).sum(axis=1)
            gain += (_n_log_n(columns) - _n_log_n(pairs[:, :-1].T)).sum(axis=1)
            cross = pairs[diagonal, diagonal]
            a, b = after[:-1], before[:-1]
            gain += _n_log_n(cross + a + b + own) - _n_log_n(cross + a) - _n_log_n(cross + b) + _n_log_n(cross)
            for total, add in ((pairs.sum(axis=1)[:-1], after.sum() + own), (pairs.sum(axis=0)[:-1], before.sum() + own)):
                gain -= _n_log_n(total + add) - _n_log_n(total)
            new = int(np.argmax(gain))
            if gain[new] <= gain[old] + 1e-9:
                new = old
            pairs[new] += after
            pairs[:, new] += before
            pairs[new, new] += own
            if new != old:
                moved = True
                found[u] = new
                follow[:, old] -= bigrams[:, u]
                follow[:, new] += bigrams[:, u]
                precede[:, old] -= bigrams[u]
                precede[:, new] += bigrams[u]
        if not moved:
            break
    return found


def word_gains(
    after: np.ndarray, before: np.ndarray, own: np.ndarray, old: np.ndarray, pairs: np.ndarray
) -> np.ndarray:
    """What the likelihood gains by adding each word alone to each class, the word taken out of its class `old`.

    `after` and `before` count the classes behind and before each word, itself included; `own` counts how often
    it follows itself. `pairs` are the class bigrams with all words where they are.
    """
    words, classes = np.arange(len(own)), pairs.shape[0]
    weight = after.sum(axis=1)
    after, before = after.copy(), before.copy()
    after[words, old] -= own
    before[words, old] -= own

    def crossed(counts: np.ndarray, others: np.ndarray, pairs: np.ndarray) -> np.ndarray:
        i, k = np.nonzero(counts)
        n, cells = counts[i, k], pairs[:, k].T.copy()  # cells[e, class] = pairs[class, k[e]] without the word
        cells[np.arange(len(i)), old[i]] -= n
        same = np.flatnonzero(k == old[i])
        cells[same] -= others[i[same]]
        cells[same, old[i[same]]] -= own[i[same]]
        gain = np.zeros((len(own), classes))
        if len(i):
            begin = np.flatnonzero(np.r_[True, i[1:] != i[:-1]])
            gain[i[begin]] = np.add.reduceat(_n_log_n(cells + n[:, None]) - _n_log_n(cells), begin)
        return gain

    gain = crossed(after, before, pairs) + crossed(before, after, pairs.T)
    taken = np.zeros(after.shape, np.int64)
    taken[words, old] = 1
    cell = np.diagonal(pairs) - taken * (after + before + own[:, None])
    gain += _n_log_n(cell + after + before + own[:, None]) + _n_log_n(cell)
    gain -= _n_log_n(cell + after) + _n_log_n(cell + before)
    for total in (pairs.sum(axis=1), pairs.sum(axis=0)):
        left = total - taken * weight[:, None]
        gain -= _n_log_n(left + weight[:, None]) - _n_log_n(left)
    return gain


def _contexts(batches: Iterator[pa.RecordBatch], model: Model) -> Iterator[pa.RecordBatch]:
    """Classes behind (k) and before (classes + k) the words without a unit of their own; 2 * classes: themselves."""
    classes = len(model.moves)
    for batch in _slices(batches):
        hashes, bundle, _ = tokens_of(batch.column("text"))
        unit = model.unit(hashes, bundle)[0]
        group = model.classes[unit]
        before = np.r_[model.classes[-1], group[:-1]]
        moving = np.flatnonzero((unit >= OWN_UNITS) & (unit < OWN_UNITS + END_BUNDLE))
        again = moving[moving > 0]
        again = again[hashes[again] == hashes[again - 1]]
        word = np.r_[hashes[moving], hashes[moving], hashes[again]]
        # the end is behind every text, so a word always has a token behind it
        context = np.r_[group[moving + 1], classes + before[moving], np.full(len(again), 2 * classes)]
        order = np.lexsort((context, word))
        word, context = word[order], context[order]
        new = np.flatnonzero(np.r_[len(word) > 0, (word[1:] != word[:-1]) | (context[1:] != context[:-1])][: len(word)])
        n = np.diff(np.r_[new, len(word)])
        yield pa.RecordBatch.from_arrays(
            [pa.array(word[new]), pa.array(context[new], pa.int32()), pa.array(n, pa.int64())], ["word", "context", "n"]
        )


def _moved(batches: Iterator[pa.RecordBatch], model: Model, pairs: np.ndarray) -> Iterator[pa.RecordBatch]:
    """The class of each word after its move."""
    classes = len(pairs)
    for batch in (b.slice(at, SLICE) for b in batches for at in range(0, b.num_rows, SLICE)):
        word, bundle = (batch.column(c).to_numpy() for c in ("word", "bundle"))
        old = model.classes[model.unit(word, bundle)[0]]
        found = batch.column("found")
        owner = np.repeat(np.arange(len(word)), found.value_lengths().fill_null(0).to_numpy(zero_copy_only=False))
        parts = found.flatten()
        counts = np.zeros((len(word), 2 * classes + 1), np.int64)
        counts[owner, parts.field("context").to_numpy()] = parts.field("n").to_numpy()
        moves = np.flatnonzero(counts.any(axis=1))
        counts, group = counts[moves], old.copy()
        if len(moves):
            after, before, own = counts[:, :classes], counts[:, classes:-1], counts[:, -1]
            gain = word_gains(after, before, own, old[moves], pairs)[:, :-1]  # the end is alone in its class
            best, rows = np.argmax(gain, axis=1), np.arange(len(moves))
            group[moves] = np.where(gain[rows, best] > gain[rows, old[moves]] + 1e-9, best, old[moves])
        yield pa.RecordBatch.from_arrays(
            [batch.column("word"), batch.column("bundle"), batch.column("n"), pa.array(group, pa.int32())],
            ["word", "bundle", "n", "group"],
        )


def classes_of_words(training: DataFrame, counts: DataFrame, model: Model) -> DataFrame:
    """(word, bundle, n, group), written: the class of every word of `training`, `model` being fitted to units."""
    shared = training.sparkSession.sparkContext.broadcast((model, model.pairs))
    rows = training.select("text").mapInArrow(
        lambda b: _contexts(b, shared.value[0]), "word bigint, context int, n bigint"
    )
    # dealt by word, so that neither grouping nor the join moves rows again
    rows = rows.repartition("word").groupBy("word", "context").agg(F.sum("n").alias("n"))
    found = rows.groupBy("word").agg(F.collect_list(F.struct("context", "n")).alias("found"))
    words = counts.join(found, "word", "left").select("word", "bundle", "n", "found")
    return stage(
        words.mapInArrow(lambda b: _moved(b, *shared.value), "word bigint, bundle int, n bigint, group int")
    )


def _frequent_words(counts: DataFrame, most: int, third: str = "bundle") -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes in order, counts and bundles of all words from some frequency on, `most` at most."""
    level = F.floor(F.log2("n") * 16).cast("int")
    histogram = counts.groupBy(level.alias("level")).agg(F.count("*").alias("words")).collect()  # < 1100 rows
    total, least = 0, None
    for row in sorted(histogram, key=lambda r: -r["level"]):
        if total + row["words"] > most:
            break
        total, least = total + row["words"], row["level"]
    if least is None:
        return np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.int32)
    kept = counts.where(level >= least).select("word", "n", third).toArrow()  # <= `most` rows
    columns = [kept.column(c).to_numpy() for c in ("word", "n", third)]
    order = np.argsort(columns[0])
    return tuple(c[order] for c in columns)


def fit(training: DataFrame, counts: DataFrame, classes: int = CLASSES, frequent: int = FREQUENT) -> Model:
    """Classes of units; `counts` (word, bundle, n) are the written counts of all words of `training`."""
    bundles = {
        r["bundle"]: (r["n"], r["words"])
        for r in counts.groupBy("bundle").agg(F.sum("n").alias("n"), F.count("*").alias("words")).collect()
    }  # BUNDLES + 1 rows
    tokens, words = (sum(v[k] for v in bundles.values()) for k in (0, 1))
    hashes, n, bundle = _frequent_words(counts, frequent)
    units = bundle.astype(np.int64) + OWN_UNITS
    own = np.lexsort((hashes, -n))
    own = own[bundle[own] != END_BUNDLE][:OWN_UNITS]
    units[own] = np.arange(len(own))
    unit_n, unit_words = np.zeros(UNITS, np.int64), np.zeros(UNITS, np.int64)
    for b, (total, different) in bundles.items():
        unit_n[OWN_UNITS + b], unit_words[OWN_UNITS + b] = total, different
    np.add.at(unit_n, bundle[own] + OWN_UNITS, -n[own])
    np.add.at(unit_words, bundle[own] + OWN_UNITS, -1)
    unit_n[: len(own)], unit_words[: len(own)] = n[own], 1

    zero = np.zeros(UNITS, np.int64)
    none = np.zeros((classes, classes), np.int64)
    model = Model(tokens, words, hashes, n, units, zero[:0], zero, none, none, np.zeros(classes))
    shared = training.sparkSession.sparkContext.broadcast(model)
    rows = training.select("text").mapInArrow(lambda b: _bigrams(b, shared.value), "pair bigint, n bigint")
    table = rows.groupBy("pair").agg(F.sum("n").alias("n")).toArrow()  # at most UNITS^2 rows
    bigrams = np.zeros(UNITS * UNITS, np.int64)
    bigrams[table.column("pair").to_numpy()] = table.column("n").to_numpy()
    bigrams = bigrams.reshape(UNITS, UNITS)

    model.classes = exchange_classes(bigrams, classes)
    member = np.zeros((UNITS, classes), np.int64)
    member[np.arange(UNITS), model.classes] = 1
    model.groups = model.classes[units]
    _weigh(model, member.T @ bigrams @ member, unit_n @ member, unit_words @ member)
    return model


def _weigh(model: Model, pairs: np.ndarray, n: np.ndarray, words: np.ndarray) -> None:
    """Probabilities from class bigrams, and tokens and different words of each class."""
    model.pairs = pairs
    model.moves = np.log10(pairs + 1) - np.log10(pairs.sum(axis=1, keepdims=True) + len(pairs))
    model.rooms = np.log10(n + words + 1)


# --- scoring ------------------------------------------------------------------------------------------


def _partial_scores(batches: Iterator[pa.RecordBatch], model: Model) -> Iterator[pa.RecordBatch]:
    """Per text: the classes of its tokens as far as the task knows, and its rare words with their places."""
    from pyspark import TaskContext

    place = TaskContext.get().partitionId() << 33
    for batch in _slices(batches):
        size = batch.num_rows
        hashes, bundle, text = tokens_of(batch.column("text"))
        group, at = model.group(hashes, bundle)
        common = at >= 0
        n = np.bincount(text, minlength=size)
        begin = np.r_[0, np.cumsum(n)]
        sums = [
            n,
            np.bincount(text[common], minlength=size),
            np.bincount(text[common], np.log10(model.counts[at[common]] + 1.0), size).astype(float),
        ]
        rare = np.flatnonzero(~common)
        offsets = pa.array(np.searchsorted(rare, begin), pa.int32())
        known = group.astype(np.uint8).tobytes()
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(np.arange(place, place + size)),
                batch.column("doc_id"),
                batch.column("held_out"),
                *(pa.array(s) for s in sums),
                pa.array([known[a:b] for a, b in zip(begin[:-1], begin[1:], strict=True)], pa.binary()),
                pa.ListArray.from_arrays(offsets, pa.array(hashes[rare], pa.int64())),
                pa.ListArray.from_arrays(offsets, pa.array(rare - begin[text[rare]], pa.int32())),
            ],
            ["place", "doc_id", "held_out", "n_tokens", "n_common", "log_common", "groups", "rare", "at"],
        )
        place += size


_PARTIAL = (
    "place bigint, doc_id bigint, held_out boolean, n_tokens bigint, n_common bigint, log_common double, "
    "groups binary, rare array<bigint>, at array<int>"
)
_DONE = ["doc_id", "held_out", "n_tokens", "n_known", "log_counts"]


def _filled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The classes of all tokens, those of rare words put where they belong."""
    for batch in batches:
        groups, found = batch.column("groups"), batch.column("found")
        whole = []
        for known, cells in zip(groups, found, strict=True):
            data = known.as_py()
            if cells.is_valid:
                own = np.frombuffer(data, np.uint8).copy()
                own[cells.values.field("at").to_numpy()] = cells.values.field("group").to_numpy()
                data = own.tobytes()
            whole.append(data)
        columns = [batch.column(c) for c in _DONE] + [pa.array(whole, pa.binary())]
        yield pa.RecordBatch.from_arrays(columns, [*_DONE, "groups"])


def _steps(groups: pa.Array, end: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Class before each token, its class, its text; every text closes with the end, whose class is its own."""
    texts = groups.to_pylist()
    group = np.frombuffer(b"".join(texts), np.uint8).astype(np.int64)
    owner = np.repeat(np.arange(len(texts)), [len(t) for t in texts])
    return np.r_[end, group[:-1]][: len(group)], group, owner


def _class_bigrams(batches: Iterator[pa.RecordBatch], classes: int, end: int) -> Iterator[pa.RecordBatch]:
    n = np.zeros(classes * classes, np.int64)
    for batch in batches:
        before, group, _ = _steps(batch.column("groups"), end)
        n += np.bincount(before * classes + group, minlength=len(n))
    found = np.flatnonzero(n)
    yield pa.RecordBatch.from_arrays([pa.array(found), pa.array(n[found])], ["pair", "n"])


def _class_scores(batches: Iterator[pa.RecordBatch], model: Model) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        before, group, owner = _steps(batch.column("groups"), int(model.classes[-1]))
        sums = np.bincount(owner, model.moves[before, group] - model.rooms[group], batch.num_rows).astype(float)
        yield pa.RecordBatch.from_arrays(
            [*(batch.column(c) for c in _DONE), pa.array(sums)], [*_DONE, "log_class"]
        )


def is_held_out():
    return F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % FOLDS == HELD_OUT


def score(docs: DataFrame, classes: int = CLASSES, frequent: int = FREQUENT) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score and score of every document."""
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), is_held_out().alias("held_out"), "text")
    training = rows.where("not held_out").select("text")
    found = training.mapInArrow(_word_counts, "word bigint, bundle int, n bigint")
    counts = stage(found.groupBy("word").agg(F.min("bundle").alias("bundle"), F.sum("n").alias("n")))
    model = fit(training, counts, classes, frequent)
    words = classes_of_words(training, counts, model)
    model.groups = _frequent_words(words, frequent, "group")[2]
    context = docs.sparkSession.sparkContext
    shared = context.broadcast(model)
    partial = stage(rows.mapInArrow(lambda b: _partial_scores(b, shared.value), _PARTIAL))

    rare = partial.select("place", F.explode(F.arrays_zip("rare", "at")).alias("r"))
    rare = rare.select("place", F.col("r.rare").alias("word"), F.col("r.at").alias("at"))
    joined = rare.join(words.select("word", "n", "group"), "word")  # words unknown to training add log10(1)
    sums = joined.groupBy("place").agg(
        F.count("*").alias("n_rare"),
        F.sum(F.log10(F.col("n") + 1.0)).alias("log_rare"),
        F.collect_list(F.struct("at", "group")).alias("found"),
    )
    whole = partial.drop("rare", "at").join(sums, "place", "left").select(
        "doc_id",
        "held_out",
        "n_tokens",
        (F.col("n_common") + F.coalesce("n_rare", F.lit(0))).alias("n_known"),
        (F.col("log_common") + F.coalesce("log_rare", F.lit(0.0))).alias("log_counts"),
        "groups",
        "found",
    )
    done = "doc_id bigint, held_out boolean, n_tokens bigint, n_known bigint, log_counts double"
    filled = stage(whole.mapInArrow(_filled, f"{done}, groups binary"))

    end = int(model.classes[-1])
    seen = filled.where("not held_out").select("groups").mapInArrow(
        lambda b: _class_bigrams(b, classes, end), "pair bigint, n bigint"
    )
    pairs, n, different = np.zeros(classes * classes, np.int64), np.zeros(classes, np.int64), np.zeros(classes, np.int64)
    for row in seen.groupBy("pair").agg(F.sum("n").alias("n")).collect():  # at most classes^2 rows
        pairs[row["pair"]] = row["n"]
    for row in words.groupBy("group").agg(F.sum("n").alias("n"), F.count("*").alias("words")).collect():
        n[row["group"]], different[row["group"]] = row["n"], row["words"]
    _weigh(model, pairs.reshape(classes, classes), n, different)
    weighed = context.broadcast(model)
    scored = filled.mapInArrow(lambda b: _class_scores(b, weighed.value), f"{done}, log_class double")
    room = math.log10(model.tokens + model.words + 1)
    return scored.select(
        "doc_id",
        "held_out",
        "n_tokens",
        "n_known",
        F.lit(model.tokens).cast("bigint").alias("train_tokens"),
        (F.col("log_counts") - F.col("n_tokens") * F.lit(room)).alias("base_score"),
        (F.col("log_counts") + F.col("log_class")).alias("score"),
    )
