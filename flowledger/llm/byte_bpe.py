"""Byte-level BPE encoding and decoding by tree reduction.

A text is cut into matches of the vocabulary's pattern, and each match is encoded on its own by merging
the neighbours of lowest rank. Both steps reduce a tree over the text:

* Matches: the halves of a text are matched on their own. When two neighbours are joined, matches near
  the seam are given up and found anew over both, until a match begins where one of the right half
  begins. The pattern never looks back, so all further matches of the right half stand. On the left a
  match stands if it ends `MARGIN` or more characters before the seam, further than the pattern looks on.
* Tokens: the halves of a long match are encoded on their own. Tokens next to the seam are encoded anew
  as one window, which grows on either side until its outermost token and the neighbour outside stay
  apart when just the two are encoded. A sequence in which all neighbours stay apart pairwise is the
  encoding of its text: merges inside two tokens happen in the same order alone as in company, so the
  first merge across a seam would also happen for the two alone. Hence nothing outside can change.

Decoding concatenates token bytes up a tree. Vocabulary file and pattern are parameters; the files are
those of an installed package and are read by each worker once.

Edge cases: null and empty texts have no tokens and decode to no bytes; texts and matches of any length
are handled whole; control strings are ordinary text; repeated rows and other columns pass as they are.
"""

from __future__ import annotations

import base64
from array import array
from collections.abc import Iterator
from functools import lru_cache
from hashlib import sha256
from heapq import heapify, heappop, heappush

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

VOCABULARY = public_tokenizers.path("byte_bpe_50k.tiktoken")
PATTERN = public_tokenizers.PATTERN

LEAF_CHARS = 8192  # texts up to this length are matched in one piece
LEAF_IDS = 1 << 16  # ids up to this number are decoded in one piece
LEAF_BYTES = 6  # stretches of a match up to this length are merged in one piece
SCANNED_BYTES = 40  # stretches up to this length look for the next merge by scanning
MARGIN = 3  # characters of the longest fixed string in the pattern
CACHED_MATCHES = 100_000  # encodings of matches a worker remembers, twice
CACHED_PARTS = 50_000  # the same for leaves and windows, and for pairs of neighbours
CACHED_BYTES = 24  # longest leaf or window that is remembered
SLICE = 1000  # texts a worker holds results of
_NEVER = 1 << 60  # above every rank


class _Memo(dict):
    """Remembers results of a function; when full, what was used since the last time stays at hand."""

    def __init__(self, function, most: int):
        super().__init__()
        self.function, self.most, self.old = function, most, {}

    def __missing__(self, key):
        if len(self) >= self.most:
            self.old = dict(self)
            self.clear()
        value = self.old.get(key)
        if value is None:
            value = self.function(key)
        self[key] = value
        return value


class Tokenizer:
    """One vocabulary: byte strings by rank, and the pattern that cuts texts into matches."""

    def __init__(self, path: str = VOCABULARY, pattern: str = PATTERN):
        import regex

        with open(path, "rb") as file:
            self.ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
        self.bytes_of = {rank: token for token, rank in self.ranks.items()}
        self.vocabulary = pa.array([self.bytes_of.get(i) for i in range(max(self.bytes_of) + 1)], pa.binary())
        self.decimals = pa.array([b"%d " % i for i in range(len(self.vocabulary))], pa.binary())
        self.pattern = regex.compile(pattern)
        self.matched = _Memo(self._packed, CACHED_MATCHES)
        self.merged = _Memo(self.merge, CACHED_PARTS)
        self.apart = _Memo(self._stay_apart, CACHED_PARTS)

    # tokens of one match

    def merge(self, text: bytes) -> list[int]:
        """Merge neighbours, lowest rank first and leftmost among equals."""
        ranks = self.ranks
        if (whole := ranks.get(text)) is not None:
            return [whole]
        if len(text) > SCANNED_BYTES:
            return self._merge_long(text)
        get, part = ranks.get, [text[i : i + 1] for i in range(len(text))]
        pairs = [get(a + b, _NEVER) for a, b in zip(part, part[1:], strict=False)]
        while pairs and (least := min(pairs)) < _NEVER:
            i = pairs.index(least)
            part[i : i + 2] = [part[i] + part[i + 1]]
            del pairs[i]
            if i < len(pairs):
                pairs[i] = get(part[i] + part[i + 1], _NEVER)
            if i:
                pairs[i - 1] = get(part[i - 1] + part[i], _NEVER)
        return [ranks[p] for p in part]

    def _merge_long(self, text: bytes) -> list[int]:
        """The same with a heap over a linked list."""
        ranks, n = self.ranks, len(text)
        part = [text[i : i + 1] for i in range(n)]
        before, after = list(range(-1, n - 1)), list(range(1, n + 1))
        heap = [
            (rank, i, 2) for i in range(n - 1) if (rank := ranks.get(text[i : i + 2])) is not None
        ]
        heapify(heap)
        while heap:
            _, i, size = heappop(heap)
            j = after[i]
            if part[i] is None or j >= n or len(part[i]) + len(part[j]) != size:
                continue  # one of the two has been merged meanwhile
            part[i], part[j] = part[i] + part[j], None
            after[i] = k = after[j]
            if k < n:
                before[k] = i
                if (rank := ranks.get(part[i] + part[k])) is not None:
                    heappush(heap, (rank, i, size + len(part[k])))
            if (h := before[i]) >= 0 and (rank := ranks.get(part[h] + part[i])) is not None:
                heappush(heap, (rank, h, len(part[h]) + size))
        return [ranks[p] for p in part if p is not None]

    def _stay_apart(self, pair: tuple[int, int]) -> bool:
        return self.merge(self.bytes_of[pair[0]] + self.bytes_of[pair[1]]) == list(pair)

    def join(self, left: list[int], right: list[int]) -> list[int]:
        """The encoding of two neighbouring stretches of one match."""
        if not left or not right or self.apart[left[-1], right[0]]:
            return left + right
        i = j = 1
        while True:
            text = self.decode(left[len(left) - i :] + right[:j])
            window = self.merged[text] if len(text) <= CACHED_BYTES else self.merge(text)
            left_open = i < len(left) and not self.apart[left[-i - 1], window[0]]
            right_open = j < len(right) and not self.apart[window[-1], right[j]]
            if not left_open and not right_open:
                return left[: len(left) - i] + window + right[j:]
            if left_open:
                i = min(2 * i, len(left))
            if right_open:
                j = min(2 * j, len(right))

    def encode_match(self, match: bytes) -> list[int]:
        if len(match) <= LEAF_BYTES:
            return self.merged[match]
        if (whole := self.ranks.get(match)) is not None:
            return [whole]
        half = len(match) // 2
        return self.join(self.encode_match(match[:half]), self.encode_match(match[half:]))

    # matches of one text

    def matches(self, text: str, start: int = 0, end: int | None = None, leaf: int = LEAF_CHARS) -> list[str]:
        end = len(text) if end is None else end
        if end - start <= leaf:
            return self.pattern.findall(text, start, end)
        seam = (start + end) // 2
        left = self.matches(text, start, seam, leaf)
        right = self.matches(text, seam, end, leaf)
        at = seam
        while left and at > seam - MARGIN:
            at -= len(left.pop())
        kept, right_at = 0, seam  # matches of the right half given up, and where the next begins
        found = self.pattern.finditer(text, at, end)
        while True:
            while right_at < at and kept < len(right):
                right_at += len(right[kept])
                kept += 1
            if at == right_at:
                return left + right[kept:]
            if (match := next(found, None)) is None:
                return left
            left.append(match.group())
            at = match.end()

    def _packed(self, match: str) -> bytes:
        return array("i", self.encode_match(match.encode())).tobytes()

    def encode_packed(self, text: str, leaf: int = LEAF_CHARS) -> np.ndarray:
        """Ids of a text: those of its matches side by side."""
        return np.frombuffer(b"".join(map(self.matched.__getitem__, self.matches(text, leaf=leaf))), np.int32)

    def encode(self, text: str, leaf: int = LEAF_CHARS) -> list[int]:
        return self.encode_packed(text, leaf).tolist()

    def decode(self, ids: list[int]) -> bytes:
        if len(ids) <= LEAF_CHARS:
            return b"".join(map(self.bytes_of.__getitem__, ids))
        half = len(ids) // 2
        return self.decode(ids[:half]) + self.decode(ids[half:])

    def decode_array(self, ids: pa.Array) -> bytes:
        """The same for an Arrow array: a leaf is taken from the vocabulary at once."""
        return _concatenated(self.vocabulary, ids)

    def decimal_text(self, ids: pa.Array) -> bytes:
        """Ids as decimal numbers, joined by one space."""
        return _concatenated(self.decimals, ids)[:-1]


def _concatenated(strings: pa.Array, ids: pa.Array) -> bytes:
    """The strings at the given places one behind the other, joined up a tree over leaves."""
    if len(ids) <= LEAF_IDS:
        _, offsets, data = strings.take(ids).buffers()  # the strings lie one behind the other in it
        end = np.frombuffer(offsets, np.int32)[len(ids)] if len(ids) else 0
        return data[: int(end)].to_pybytes() if end else b""
    half = len(ids) // 2
    return _concatenated(strings, ids.slice(0, half)) + _concatenated(strings, ids.slice(half))


@lru_cache(maxsize=2)
def tokenizer(path: str = VOCABULARY, pattern: str = PATTERN) -> Tokenizer:
    """The worker's own copy, loaded once."""
    return Tokenizer(path, pattern)


def _slices(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
    return (b.slice(at, SLICE) for b in batches for at in range(0, len(b), SLICE))


def with_tokens(
    docs: DataFrame, out: str = "token_ids", path: str = VOCABULARY, pattern: str = PATTERN
) -> DataFrame:
    """`docs` with the token ids of `text` in column `out` (replaced if it is there)."""

    @F.arrow_udf("array<int>")
    def encode(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        own = tokenizer(path, pattern)
        for texts in _slices(batches):
            offsets, parts = [0], []
            for text in texts:
                parts.append(own.encode_packed(text.as_py() or ""))
                offsets.append(offsets[-1] + len(parts[-1]))
            values = np.concatenate([np.empty(0, np.int32), *parts])
            yield pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(values))

    return docs.withColumn(out, encode("text"))


def with_decoded(
    tokens: DataFrame, out: str = "decoded", ids: str = "token_ids", path: str = VOCABULARY
) -> DataFrame:
    """`tokens` with the bytes of the token ids in column `out`; null ids give no bytes."""

    @F.arrow_udf("binary")
    def decode(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        own = tokenizer(path)
        for lists in _slices(batches):
            yield pa.array([own.decode_array(x.values) if x.is_valid else b"" for x in lists], pa.binary())

    return tokens.withColumn(out, decode(ids))


def round_trip(text: str = "text", path: str = VOCABULARY, pattern: str = PATTERN) -> Column:
    """Struct of the number of token ids of a text, the SHA-256 of the ids as decimal text, and that of the
    bytes the ids decode to. The ids stay in the task that made them."""

    @F.arrow_udf("struct<n_tokens:bigint,ids:binary,decoded:binary>")
    def digests(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        own = tokenizer(path, pattern)
        for texts in _slices(batches):
            sizes, listed, decoded = [], [], []
            for each in texts:
                ids = pa.array(own.encode_packed(each.as_py() or ""))
                sizes.append(len(ids))
                listed.append(sha256(own.decimal_text(ids)).digest())
                decoded.append(sha256(own.decode_array(ids)).digest())
            columns = [pa.array(sizes, pa.int64()), pa.array(listed, pa.binary()), pa.array(decoded, pa.binary())]
            yield pa.StructArray.from_arrays(columns, ["n_tokens", "ids", "decoded"])

    return digests(text)
