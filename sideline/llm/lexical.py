"""Ranked lexical search over a length-stratified index.

Documents of equal normaliser m form a stratum. Within a stratum the weight that a term adds to a document depends
on its frequency tf alone, so a block of a stratum keeps the postings of each term by falling tf, and the impact
``10**9 * tf div (1000 * tf + 12 * m)`` is computed once per tf that occurs in it.

The largest tf of a term in a stratum bounds what any document of it can score. For each item the strata are visited
by falling bound in two waves: the first takes the best strata until they hold ``FIRST_DOCS`` documents, its k-th best
score is a floor, and the second visits only strata whose bound reaches that floor. Inside a block the block's own
largest tfs are tested again. Strata that are left out hold no document of the result, so the result is exact.

Strata are dealt into blocks of bounded size (a stratum may hold a third of all rows); items meet blocks by an
equi-join on (m, block), never all at once. The index takes every document; given terms, it keeps only postings of
terms whose bit is set in a bitmap of fixed size, and joins remove what else had the same bit.
"""

from __future__ import annotations

import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from .common import small_batches, table

TOP = 20
#: Documents that the strata of an item's first wave hold at least, and postings of a block.
FIRST_DOCS = 2_000
BLOCK_POSTINGS = 100_000
#: Bits of the bitmap of the terms asked for: 1 MiB, whatever their number.
BITS = 1 << 23
_BUCKET = 1 << 15  # bits of Spark's bitmaps

_KEPT = b"0123456789abcdefghijklmnopqrstuvwxyz"
_FOLD = bytes(c + 32 if 65 <= c <= 90 else c if c >= 128 or c in _KEPT else 32 for c in range(256))


def terms_of(text: bytes) -> Counter:
    """Terms of a text and how often each occurs: runs of ASCII letters, digits and all characters beyond ASCII,
    A-Z lower-cased."""
    return Counter(text.translate(_FOLD).split())


def _bitmap(terms: DataFrame) -> bytes:
    """BITS bits; set are those of the CRC-32 of each ``term``."""
    bit = F.crc32(F.col("term").cast("binary")).bitwiseAND(F.lit(BITS - 1))
    parts = (terms.select(bit.alias("bit")).groupBy(F.shiftright("bit", 15).alias("nth"))
             .agg(F.bitmap_construct_agg(F.col("bit").bitwiseAND(F.lit(_BUCKET - 1))).alias("bits")).collect())
    out = bytearray(BITS // 8)
    for p in parts:
        out[p["nth"] * _BUCKET // 8:(p["nth"] + 1) * _BUCKET // 8] = p["bits"]
    return bytes(out)


def _counter(asked: bytes | None):
    """A function of a text column: n (all terms with repeats), terms and tfs (of the terms asked for)."""

    @arrow_udf("n bigint, terms array<string>, tfs array<int>")
    def counted(texts: pa.Array) -> pa.Array:
        ns, ends, terms, tfs = [], [0], [], []
        for t in texts.cast(pa.binary()):
            found = terms_of(t.as_py() or b"")
            ns.append(found.total())
            if asked is not None:
                found = {x: k for x, k in found.items() if asked[(h := zlib.crc32(x) & (BITS - 1)) >> 3] >> (h & 7) & 1}
            terms.extend(found)
            tfs.extend(found.values())
            ends.append(len(terms))
        at = pa.array(ends, pa.int32())
        words = pa.array(terms, pa.binary()).cast(pa.string())
        return pa.StructArray.from_arrays(
            [pa.array(ns, pa.int64()), pa.ListArray.from_arrays(at, words), pa.ListArray.from_arrays(at, pa.array(tfs, pa.int32()))],
            ["n", "terms", "tfs"])

    return counted


class Index:
    """``rows`` (row, doc_id, m, terms, tfs), ``strata`` (m, docs, blocks), ``tops`` (m, term, top, docs: the largest tf
    of a term in a stratum and the documents that hold it) and the counts ``n_docs`` and ``n_terms``."""

    def __init__(self, docs: DataFrame, terms: DataFrame | None = None, block_postings: int = BLOCK_POSTINGS):
        small_batches(docs)
        counted = _counter(None if terms is None else _bitmap(terms))
        rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("bigint").alias("doc_id"),
                           counted(F.col("text").cast("string")).alias("c")).select("row", "doc_id", "c.*")
        rows = table(rows, "lexical-rows")
        seen = rows.where("n > 0").agg(F.count(F.lit(1)).alias("docs"), F.sum("n").alias("terms")).first()
        self.n_docs, self.n_terms = seen["docs"], seen["terms"] or 0
        m = F.expr(f"75 + (25 * n * {self.n_docs}L) div {max(self.n_terms, 1)}L")
        self.rows = rows.where("size(terms) > 0").select("row", "doc_id", m.alias("m"), "terms", "tfs")
        blocks = F.ceil(F.sum(F.size("terms")) / F.lit(block_postings)).cast("bigint")
        self.strata = table(self.rows.groupBy("m").agg(F.count(F.lit(1)).alias("docs"), blocks.alias("blocks")), "lexical-strata")
        posting = self.rows.select("m", F.explode(F.arrays_zip(F.col("terms").alias("term"), F.col("tfs").alias("tf"))).alias("p"))
        self.tops = table(posting.groupBy("m", "p.term").agg(F.max("p.tf").alias("top"), F.count(F.lit(1)).alias("docs")), "lexical-tops")

    def weights(self) -> DataFrame:
        """term, w."""
        df = self.tops.groupBy("term").agg(F.sum("docs").alias("df"))
        w = F.floor(F.lit(1000.0) * F.log(F.lit(2.0 * self.n_docs + 2.0) / (2.0 * F.col("df") + 1.0)))
        return df.select("term", w.cast("bigint").alias("w"))


#: What a term of the largest tf ``top`` adds in stratum ``m``, before its weight.
_IMPACT = "(1000000000L * top) div (1000L * top + 12L * m)"


def _scored(top: int):
    """Scores of a block's documents for the items that visit it: at most ``top`` of each item."""

    def of_block(docs: pa.Table, visits: pa.Table) -> pa.Table:
        out: dict[str, list] = {"item": [], "doc_id": [], "row": [], "score": []}
        if docs.num_rows and visits.num_rows:
            m = docs["m"][0].as_py()
            ids, rows = docs["doc_id"].combine_chunks(), docs["row"].to_numpy()
            order_ids = ids.fill_null(np.iinfo("int64").max).to_numpy()
            lists = docs["terms"].combine_chunks()
            lengths = np.diff(lists.offsets.to_numpy())
            coded = lists.flatten().dictionary_encode()
            code, tf = coded.indices.to_numpy(), docs["tfs"].combine_chunks().flatten().to_numpy()
            order = np.lexsort((-tf, code))  # postings: by term, then by falling tf
            owner = np.repeat(np.arange(docs.num_rows), lengths)[order]
            tfs, nth = np.unique(tf, return_inverse=True)
            tfs = tfs.astype("int64")
            impact = ((10**9 * tfs) // (1000 * tfs + 12 * m))[nth[order]]
            begin = np.searchsorted(code[order], np.arange(len(coded.dictionary) + 1))
            at = {t: i for i, t in enumerate(coded.dictionary.to_pylist())}
            for item, terms, weights, floor in zip(*(visits[c].to_pylist() for c in ("item", "terms", "weights", "floor"))):
                own = [(at[t], w) for t, w in zip(terms, weights) if t in at]
                if sum(w * int(impact[begin[c]]) for c, w in own) < max(floor, 1):
                    continue
                score = np.zeros(docs.num_rows, "int64")
                for c, w in own:
                    score[owner[begin[c]:begin[c + 1]]] += w * impact[begin[c]:begin[c + 1]]
                found = np.flatnonzero(score >= max(floor, 1))
                if len(found) > top:
                    least = np.partition(score[found], len(found) - top)[len(found) - top]
                    found = found[score[found] >= least]
                found = found[np.lexsort((rows[found], order_ids[found], -score[found]))][:top]
                out["item"] += [item] * len(found)
                out["doc_id"] += ids.take(pa.array(found)).to_pylist()
                out["row"] += rows[found].tolist()
                out["score"] += score[found].tolist()
        return pa.table({k: pa.array(v, pa.int64()) for k, v in out.items()})

    return of_block


def _visit(index: Index, visits: DataFrame, vectors: DataFrame, top: int) -> DataFrame:
    """item, doc_id, row, score of the best of each block that ``visits`` (item, m, floor) names."""
    block = F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("blocks") - 1)).alias("block")
    asked = (visits.join(index.strata, "m").select("item", "m", "floor", block).join(vectors, "item"))
    held = (index.rows.join(index.strata.join(visits.select("m").distinct(), "m", "left_semi").select("m", "blocks"), "m")
            .select("row", "doc_id", "m", F.pmod("row", "blocks").alias("block"), "terms", "tfs"))
    return held.groupBy("m", "block").cogroup(asked.groupBy("m", "block")).applyInArrow(
        _scored(top), "item bigint, doc_id bigint, row bigint, score bigint")


def search(docs: DataFrame, items: DataFrame, top: int = TOP, first_docs: int = FIRST_DOCS,
           block_postings: int = BLOCK_POSTINGS) -> DataFrame:
    """item_id, rank, doc_id, score: for each item (item_id, text) the ``top`` documents of the highest score above 0,
    equal scores by ascending doc_id (NULL last).

    NULL and empty texts have no terms: such documents count nowhere and are never found, such items get no rows.
    Repeated documents are ranked one by one; repeated items (equal in item_id and text) are one item, items that
    share only their item_id are each ranked by themselves. Empty tables give no rows; other columns are not read.
    """
    spark = docs.sparkSession
    named = items.select("item_id", F.col("text").cast("string").alias("text")).distinct()
    named = named.select(F.monotonically_increasing_id().alias("item"), "item_id", _counter(None)(F.col("text")).alias("c"))
    named = table(named.select("item", "item_id", F.arrays_zip(F.col("c.terms").alias("term"), F.col("c.tfs").alias("tf")).alias("terms")), "lexical-items")
    wanted = named.select("item", F.explode("terms").alias("t")).select("item", "t.term", F.col("t.tf").cast("bigint").alias("times"))
    index = Index(docs, wanted.select("term"), block_postings)
    if not index.n_docs:
        return spark.createDataFrame([], "item_id bigint, rank int, doc_id bigint, score bigint")
    # terms that no item holds leave the tops here
    weighted = table(wanted.join(index.weights(), "term").select("item", "term", (F.col("times") * F.col("w")).alias("weight")), "lexical-weights")
    vectors = table(weighted.groupBy("item").agg(F.collect_list(F.struct("term", "weight")).alias("v"))
                    .select("item", F.col("v.term").alias("terms"), F.col("v.weight").alias("weights")), "lexical-vectors")
    bounds = (weighted.join(index.tops.select("m", "term", F.expr(_IMPACT).alias("impact")), "term")
              .groupBy("item", "m").agg(F.sum(F.col("weight") * F.col("impact")).alias("bound")).where("bound > 0"))
    order = Window.partitionBy("item").orderBy(F.desc("bound"), "m").rowsBetween(Window.unboundedPreceding, -1)
    before = F.coalesce(F.sum("docs").over(order), F.lit(0))
    bounds = table(bounds.join(index.strata.select("m", "docs"), "m").select("item", "m", "bound", before.alias("before")), "lexical-bounds")
    first = table(_visit(index, bounds.where(F.col("before") < first_docs).select("item", "m", F.lit(0).cast("bigint").alias("floor")),
                         vectors, top), "lexical-first")
    best = Window.partitionBy("item").orderBy(F.desc("score"), F.col("doc_id").asc_nulls_last(), "row")
    floors = first.withColumn("nth", F.row_number().over(best)).where(F.col("nth") == top).select("item", F.col("score").alias("floor"))
    rest = (bounds.where(F.col("before") >= first_docs).join(floors, "item", "left").withColumn("floor", F.coalesce("floor", F.lit(0).cast("bigint")))
            .where(F.col("bound") >= F.col("floor")).select("item", "m", "floor"))
    found = first.unionByName(_visit(index, table(rest, "lexical-rest"), vectors, top))
    ranked = found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= top)
    return ranked.join(named.select("item", "item_id"), "item").select("item_id", "rank", "doc_id", "score")
