"""Document fingerprints by context-triggered piecewise hashing.

A rolling hash of the last seven bytes ends a chunk wherever it hits the trigger of the block size (and
after four blocks at the latest), so chunk boundaries depend on nearby bytes only and an edit changes few chunks. Each chunk gives one character of a
signature. A fingerprint is ``block:signature:signature of twice the block``; the block size doubles from 3 until
64 blocks cover the text. Fingerprints are compared by edit distance of the signatures that share a block size;
sizes further apart than a factor of two are not comparable (likeness 0).

Chunks are found with array operations over the whole text's bytes; edit distances are Spark's ``levenshtein``.

``neighbours`` pairs each document with the next one in doc_id order without one global sort of texts: Spark's range
partitioning of the keys alone gives cuts, texts move once, to the range of their key, each range is put in order in
its own task, and the first document of each range is also sent to the range before.
"""

from __future__ import annotations

import bisect

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from .common import small_batches, text_of

WINDOW = 7
MIN_BLOCK = 3
CHUNKS = 64
#: A chunk ends after so many blocks at the latest: periodic texts hit no trigger, or one in each period.
MAX_CHUNK = 4
ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"
#: Odd multipliers of the rolling hash, one per place in the window.
PLACES = tuple((0x9E3779B1 * (2 * i + 1)) & 0xFFFFFFFF for i in range(WINDOW))
#: Documents in a range of doc_ids, on average, and ranges at most (their cuts are sent to all tasks, a few MB).
RANGE_DOCS = 2000
MAX_RANGES = 100_000


def _rolling(data: np.ndarray) -> np.ndarray:
    """A 32-bit hash of the WINDOW bytes that end at each byte (fewer at the start)."""
    x = data.astype("uint32") + np.uint32(1)
    h = np.zeros(len(x), "uint32")
    for back, factor in enumerate(PLACES):
        if back < len(x):
            h[back:] += x[:len(x) - back] * np.uint32(factor)
    h ^= h >> np.uint32(15)
    h *= np.uint32(0x85EBCA6B)
    return h ^ (h >> np.uint32(13))


def _signature(raw: bytes, rolled: np.ndarray, block: int) -> str:
    ends = (np.flatnonzero(rolled % np.uint32(block) == block - 1) + 1).tolist()
    if not ends or ends[-1] != len(raw):
        ends.append(len(raw))
    start, out, most = 0, [], MAX_CHUNK * block
    for end in ends:
        while start < end:
            stop = min(end, start + most)
            out.append(ALPHABET[xxhash.xxh32_intdigest(raw[start:stop]) & 63])
            start = stop
    return "".join(out)


def fingerprint(text: str) -> str:
    """``block:signature:double-block signature``; an empty text has empty signatures."""
    raw = text.encode()
    if not raw:
        return f"{MIN_BLOCK}::"
    block = MIN_BLOCK
    while block * CHUNKS < len(raw):
        block *= 2
    rolled = _rolling(np.frombuffer(raw, "uint8"))
    return f"{block}:{_signature(raw, rolled, block)}:{_signature(raw, rolled, 2 * block)}"


def fingerprint_of(text: Column) -> Column:
    """The fingerprint of a text column; NULL stays NULL."""

    @arrow_udf("string")
    def ctph(texts: pa.Array) -> pa.Array:
        return pa.array([None if t.as_py() is None else fingerprint(t.as_py()) for t in texts], pa.string())

    return ctph(text)


def likeness(a: Column, b: Column) -> Column:
    """0 to 1: one minus the edit distance by the longer signature, the best over shared block sizes."""
    a, b = F.split(a, ":"), F.split(b, ":")
    block_a, block_b = a[0].cast("bigint"), b[0].cast("bigint")

    def alike(x: Column, y: Column) -> Column:
        longer = F.greatest(F.length(x), F.length(y))
        return F.when(longer == 0, F.lit(1.0)).otherwise(1.0 - F.levenshtein(x, y) / longer)

    return (F.when(block_a == block_b, F.greatest(alike(a[1], b[1]), alike(a[2], b[2])))
            .when(block_a == 2 * block_b, alike(a[1], b[2]))
            .when(2 * block_a == block_b, alike(a[2], b[1])).otherwise(F.lit(0.0)))


def _cuts(keyed: DataFrame, range_docs: int) -> list[tuple[bool, int, int]]:
    """The first (doc_id is NULL, doc_id, tie) of each range of about ``range_docs`` rows, in order: as Spark's sampling
    deals the keys, so clusters of ids, far-off ones and NULLs make no range larger. At most ``MAX_RANGES``."""
    ranges = max(1, min(MAX_RANGES, keyed.count() // range_docs))
    dealt = keyed.repartitionByRange(ranges, F.col("doc_id").asc_nulls_last(), F.col("tie")).withColumn("part", F.spark_partition_id())
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "tie")).alias("first")
    return sorted((r.first.none, r.first.doc_id or 0, r.first.tie) for r in dealt.groupBy("part").agg(first).collect())


def neighbours(docs: DataFrame, columns: dict[str, Column], range_docs: int = RANGE_DOCS) -> DataFrame:
    """doc_id, ``columns`` of each document, and the same of the next one as ``next_*``.

    Ascending doc_id; the last document's next is the first (one document: itself). Repeated doc_ids are ordered
    by a hash of the text; NULL doc_ids come last. One row per row of ``docs``. Rows go to ranges of about
    ``range_docs``, the first of each also to the range before; only rows that agree in doc_id and text stay together.
    """
    keyed = docs.select("doc_id", F.xxhash64(text_of()).alias("tie"))
    cuts = docs.sparkSession.sparkContext.broadcast(_cuts(keyed, range_docs))
    last = max(len(cuts.value) - 1, 0)

    @arrow_udf("struct<range int, first boolean>")
    def placed(ids: pa.Array, ties: pa.Array) -> pa.Array:
        ranges, firsts = [], []
        for i, t in zip(ids.to_pylist(), ties.to_pylist()):
            key = (i is None, i or 0, t)
            ranges.append(max(bisect.bisect_right(cuts.value, key) - 1, 0))
            firsts.append(cuts.value[ranges[-1]] == key)
        return pa.StructArray.from_arrays([pa.array(ranges, pa.int32()), pa.array(firsts, pa.bool_())], ["range", "first"])

    rows = docs.select("doc_id", F.xxhash64(text_of()).alias("tie"), *[c.alias(name) for name, c in columns.items()])
    rows = rows.withColumn("place", placed("doc_id", "tie"))
    at = F.col("place.range")
    own = F.struct(at.alias("to"), F.lit(False).alias("wraps"), F.lit(True).alias("own"))
    copy = F.struct(F.when(at == 0, last).otherwise(at - 1).alias("to"), (at == 0).alias("wraps"), F.lit(False).alias("own"))
    sent = F.explode(F.when(F.col("place.first"), F.array(own, copy)).otherwise(F.array(own))).alias("at")
    rows = rows.select("doc_id", "tie", *columns, sent)
    order = Window.partitionBy("at.to").orderBy("at.wraps", F.col("doc_id").asc_nulls_last(), "tie", F.col("at.own").desc())
    return (rows.select("doc_id", "at.own", *columns, *[F.lead(c).over(order).alias(f"next_{c}") for c in columns])
            .where("own").drop("own"))


def fingerprints(docs: DataFrame) -> DataFrame:
    """doc_id, fingerprint: one row per row. NULL texts are empty; equal texts have equal fingerprints."""
    small_batches(docs)
    return docs.select("doc_id", fingerprint_of(text_of()).alias("fingerprint"))


def against_edits(docs: DataFrame) -> DataFrame:
    """doc_id, n_chars, edited, fingerprint, edited_fingerprint, near_edited, near_next.

    ``edited`` is the text with its last n_chars // 4 code points replaced by the first as many (or all) of the
    next document's text. NULL texts are empty; an empty table gives no rows; other columns are not read.
    """
    small_batches(docs)
    t = text_of()
    pairs = neighbours(docs, {"t": t, "fp": fingerprint_of(t)})
    n = F.length("t")
    tail = F.floor(n / 4).cast("int")
    edited = F.concat(F.substring(F.col("t"), F.lit(1), n - tail), F.substring(F.col("next_t"), F.lit(1), tail))
    rows = pairs.select("doc_id", n.cast("bigint").alias("n_chars"), edited.alias("edited"), "fp", "next_fp")
    rows = rows.withColumn("edited_fp", fingerprint_of(F.col("edited")))
    return rows.select("doc_id", "n_chars", "edited", F.col("fp").alias("fingerprint"),
                       F.col("edited_fp").alias("edited_fingerprint"),
                       likeness(F.col("fp"), F.col("edited_fp")).alias("near_edited"),
                       likeness(F.col("fp"), F.col("next_fp")).alias("near_next"))
