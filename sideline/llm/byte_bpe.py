"""Byte-level BPE: encoding by ranked merges over the byte arrays of distinct words, decoding by joining pieces.

A text is split by the vocabulary's pattern; each match (a "word") is encoded alone. A word's bytes are
folded: of all adjacent pairs the leftmost one of lowest rank is merged, until no pair has a rank. The rank
map is a literal of fixed size (the vocabulary file), sent once to each executor. A worker folds each distinct
word once and keeps its ids in a bounded memo, so texts are encoded in place: no shuffle, and a lost executor
costs only its own tasks. Decoding looks up each id's bytes and concatenates them.

``fold_words`` is the same fold with Spark's higher-order functions alone, for a column of words. Run over the
distinct words of each document it gives equal ids at several times the CPU (README has figures), so ``encode``
folds in the Python workers.
"""

from __future__ import annotations

import base64
import heapq
import json
import zlib
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from .common import small_batches, text_of

#: Words a worker remembers; when full, the memo starts anew.
MEMO_WORDS = 400_000
#: Longer words are merged with a heap instead of by scanning.
LONG_WORD = 64
NO_RANK = 1 << 62


def read_ranks(path: str) -> dict[bytes, int]:
    """A rank file: base64 bytes and rank on each line."""
    with open(path, "rb") as f:
        return {base64.b64decode(piece): int(rank) for piece, rank in (line.split() for line in f if line.strip())}


def fold(word: bytes, rank) -> list[int]:
    """Ids of one word; ``rank(bytes, default)`` looks up ranks."""
    whole = rank(word, None)
    if whole is not None:
        return [whole]
    if len(word) > LONG_WORD:
        return _fold_long(word, rank)
    parts = [word[i:i + 1] for i in range(len(word))]
    pairs = [rank(word[i:i + 2], NO_RANK) for i in range(len(word) - 1)]
    while pairs:
        best = min(pairs)
        if best == NO_RANK:
            break
        i = pairs.index(best)
        parts[i:i + 2] = [parts[i] + parts[i + 1]]
        del pairs[i]
        if i < len(pairs):
            pairs[i] = rank(parts[i] + parts[i + 1], NO_RANK)
        if i:
            pairs[i - 1] = rank(parts[i - 1] + parts[i], NO_RANK)
    return [rank(p, None) for p in parts]


def _fold_long(word: bytes, rank) -> list[int]:
    """The same merges with a heap of (rank, start) over linked parts: n log n for any length."""
    n = len(word)
    end, before = list(range(1, n + 1)), list(range(-1, n - 1))  # by a part's start: its end, the part before
    alive = [True] * n
    heap = [(r, i, i + 2) for i in range(n - 1) if (r := rank(word[i:i + 2], None)) is not None]
    heapq.heapify(heap)
    while heap:
        _, i, stop = heapq.heappop(heap)
        mid = end[i]
        if not alive[i] or mid >= n or not alive[mid] or end[mid] != stop:
            continue  # one of the two has been merged since
        end[i], alive[mid] = stop, False
        if stop < n:
            before[stop] = i
            if (r := rank(word[i:end[stop]], None)) is not None:
                heapq.heappush(heap, (r, i, end[stop]))
        if (p := before[i]) >= 0 and (r := rank(word[p:stop], None)) is not None:
            heapq.heappush(heap, (r, p, stop))
    out, i = [], 0
    while i < n:
        out.append(rank(word[i:end[i]], None))
        i = end[i]
    return out


class Memo(dict):
    """Word -> ids, folded on first sight."""

    def __init__(self, ranks: dict[bytes, int]):
        super().__init__()
        self.rank = ranks.get

    def __missing__(self, word: str) -> list[int]:
        if len(self) >= MEMO_WORDS:
            self.clear()
        ids = fold(word.encode(), self.rank)
        if len(word) <= LONG_WORD:
            self[word] = ids
        return ids


_tools: dict[tuple, tuple] = {}  # of this task: splitter, memo and pieces of the vocabulary in use


def _tools_of(ranks: dict[bytes, int], pattern: str) -> tuple:
    key = (id(ranks), pattern)  # the memo holds on to ranks, so the id stays its own
    if key not in _tools:
        _tools.clear()
        _tools[key] = (regex.compile(pattern).findall, Memo(ranks), {i: piece for piece, i in ranks.items()})
    return _tools[key]


def _encoded(texts: pa.Array, ranks: dict[bytes, int], pattern: str) -> pa.ListArray:
    split, memo, _ = _tools_of(ranks, pattern)
    offsets, values = [0], [np.zeros(0, "int32")]
    for t in texts:
        values.append(np.fromiter(chain.from_iterable(map(memo.__getitem__, split(t.as_py() or ""))), "int32"))
        offsets.append(offsets[-1] + len(values[-1]))
    return pa.ListArray.from_arrays(pa.array(offsets, "int32"), pa.array(np.concatenate(values)))


def _decoded(ids: pa.ListArray, pieces: dict[int, bytes]) -> pa.Array:
    flat, ends, piece = ids.values.to_numpy(zero_copy_only=False), ids.offsets.to_numpy(), pieces.__getitem__
    return pa.array([b"".join(map(piece, flat[ends[i]:ends[i + 1]].tolist())) if ok.as_py() else None
                     for i, ok in enumerate(ids.is_valid())], pa.binary())


def encode(docs: DataFrame, ranks: dict[bytes, int], pattern: str) -> DataFrame:
    """doc_id, ids (array of int): every whole text, one row per row.

    NULL and empty texts have no ids; repeated rows repeat; an empty table gives no rows; a word of any length
    is encoded whole. No special tokens. Other columns of ``docs`` are not read.
    """
    small_batches(docs)
    shared = docs.sparkSession.sparkContext.broadcast(ranks)

    @arrow_udf("array<int>")
    def encoded(texts: pa.Array) -> pa.Array:
        return _encoded(texts, shared.value, pattern)

    return docs.select("doc_id", encoded(text_of()).alias("ids"))


def decode(encoded: DataFrame, ranks: dict[bytes, int]) -> DataFrame:
    """``encoded`` with ``decoded`` (binary): the bytes of its ids, concatenated. NULL ids decode to NULL; an
    unknown id is an error."""
    small_batches(encoded)
    shared = encoded.sparkSession.sparkContext.broadcast({i: piece for piece, i in ranks.items()})

    @arrow_udf("binary")
    def decoded(ids: pa.Array) -> pa.Array:
        return _decoded(ids, shared.value)

    return encoded.withColumn("decoded", decoded("ids"))


def round_trip(docs: DataFrame, ranks: dict[bytes, int], pattern: str) -> DataFrame:
    """doc_id, ids, decoded: ``decode`` of ``encode`` in one worker per task. Apart, they take two workers, and
    chained by Spark the encoder runs twice.

    NULL and empty texts have no ids and decode to no bytes; repeated rows and NULL doc_ids repeat; an empty table gives
    no rows; other columns are not read."""
    small_batches(docs)
    shared = docs.sparkSession.sparkContext.broadcast(ranks)

    @arrow_udf("struct<ids array<int>, decoded binary>")
    def both(texts: pa.Array) -> pa.Array:
        ranks = shared.value
        ids = _encoded(texts, ranks, pattern)
        return pa.StructArray.from_arrays([ids, _decoded(ids, _tools_of(ranks, pattern)[2])], ["ids", "decoded"])

    both_of = docs.select("doc_id", both(text_of()).alias("b"))
    return both_of.select("doc_id", "b.ids", "b.decoded")


def fold_words(word: Column, ranks: dict[bytes, int], buckets: int = 1 << 14) -> Column:
    """Ids of a column of words (strings), with Spark's higher-order functions only.

    The literal rank map is an array of small maps, indexed by a hash of the piece, since looking a key up in
    one map scans it. The fold keeps the word as an array of pieces, in hexadecimal, and merges the leftmost
    pair of lowest rank, once per step, until no pair has a rank.
    """
    spread: list[dict[str, int]] = [{} for _ in range(buckets)]
    for piece, r in ranks.items():
        h = piece.hex().upper()
        spread[zlib.crc32(h.encode()) % buckets][h] = r
    literal = F.from_json(F.lit(json.dumps(spread)), "array<map<string,int>>")

    def rank(piece: Column) -> Column:
        return F.try_element_at(literal[(F.crc32(piece.cast("binary")) % buckets).cast("int")], piece)

    def bind(value: Column, use) -> Column:
        return F.transform(F.array(value), use)[0]

    def merge(parts: Column, pairs: Column) -> Column:
        i = F.array_position(pairs, F.array_min(pairs)).cast("int")
        merged = F.concat(F.slice(parts, 1, i - 1), F.array(F.concat(parts[i - 1], parts[i])),
                          F.slice(parts, i + 2, F.greatest(F.size(parts) - i - 1, F.lit(0))))
        return F.when(F.array_min(pairs).isNull(), parts).otherwise(merged)

    def step(parts: Column, _: Column) -> Column:
        at = F.when(F.size(parts) > 1, F.sequence(F.lit(0), F.size(parts) - 2)).otherwise(F.array().cast("array<int>"))
        return bind(F.transform(at, lambda i: rank(F.concat(parts[i], parts[i + 1]))), lambda pairs: merge(parts, pairs))

    h = F.hex(word.cast("binary"))
    n = F.octet_length(word)
    single = F.when(n > 0, F.transform(F.sequence(F.lit(0), F.greatest(n, F.lit(1)) - 1), lambda i: F.substring(h, i * 2 + 1, F.lit(2)))).otherwise(F.array().cast("array<string>"))
    steps = F.when(n > 1, F.sequence(F.lit(1), F.greatest(n, F.lit(2)) - 1)).otherwise(F.array().cast("array<int>"))
    return F.transform(F.aggregate(steps, single, step), rank)
