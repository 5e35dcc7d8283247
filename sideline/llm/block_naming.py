"""Exact dedup by deterministic block naming.

A text is cut into blocks of ``block_chars`` code points. The distinct blocks are sorted into integer
names; then adjacent pairs of names are sorted into new integer names, again and again, until each
text has one name. Two texts have the same (number of blocks, name) if and only if they are equal: no
step trusts a hash.

The sort that gives names is done within buckets: ``name = bucket * 2**RANK_BITS + rank``, where the
bucket is some bits of a hash and the rank is the place of the block among the *distinct blocks of its
bucket in sorted order*. Different blocks differ in bucket or in rank, so names are collision-free
whatever the hash does. Buckets are many (2**40), so nearly all hold one block, whose rank is 1 without
looking; only blocks of buckets with two or more are looked up. The whole text is therefore shuffled
once (as distinct blocks, to find such buckets), not again for each occurrence.

Hot blocks: distinct blocks are gathered with a map-side set, so a block that a third of all rows
hold reaches the shuffle once per map task. Rows that carry a hot identity are joined on a small
per-identity table, which AQE splits.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import cut, free_name, lower_ascii, table, text_of

BLOCK_CHARS = 4096
BUCKET_BITS = 40
RANK_BITS = 23


def _bucket(c: Column, bits: int) -> Column:
    return F.shiftrightunsigned(F.xxhash64(c), 64 - bits)


def _ranks(items: DataFrame, level: int) -> DataFrame:
    """(bucket, item, rank) of buckets that hold two or more distinct items; usually empty."""
    sets = items.groupBy("bucket").agg(F.collect_set("item").alias("items")).where(F.size("items") > 1)
    ranked = sets.select("bucket", F.posexplode(F.array_sort("items")).alias("rank", "item"))
    checked = F.when(F.col("rank") < 2**RANK_BITS - 1, F.col("rank") + 1).otherwise(
        F.raise_error(F.lit("a bucket holds more items than a rank can number: raise bucket_bits")).cast("int"))
    return table(ranked.select("bucket", "item", checked.alias("rank")), f"ranks{level}")


def _named(items: DataFrame, level: int) -> DataFrame:
    """``items`` (key columns, bucket, item) with the item replaced by its integer name."""
    ranks = _ranks(items.select("bucket", "item"), level)
    name = F.shiftleft(F.col("bucket"), RANK_BITS) + F.coalesce(F.col("rank"), F.lit(1)).cast("bigint")
    keys = [c for c in items.columns if c not in ("bucket", "item")]
    return items.join(ranks, ["bucket", "item"], "left").select(*keys, name.alias("name"))


def identities(docs: DataFrame, block_chars: int = BLOCK_CHARS, bucket_bits: int = BUCKET_BITS) -> DataFrame:
    """doc_id, text_sha256, n_rows, n_blocks, name: one row per distinct (doc_id, normalised text).

    (n_blocks, name) is the text's identity. ``n_rows`` counts repeated rows. NULL texts are empty; an
    empty text is one empty block. Columns other than doc_id and text are not read.
    """
    t = docs.select("doc_id", lower_ascii(text_of()).alias("t"))
    starts = F.sequence(F.lit(0), F.greatest(F.ceil(F.length("t") / block_chars).cast("int"), F.lit(1)) - 1)
    blocks = F.transform(starts, lambda i: F.substring(F.col("t"), i * block_chars + 1, F.lit(block_chars)))
    items = (t.select("doc_id", F.sha2("t", 256).alias("text_sha256"), F.posexplode(blocks).alias("pos", "item"))
             .withColumn("bucket", _bucket(F.col("item"), bucket_bits)))
    rows = (_named(items, 0).groupBy("doc_id", "text_sha256")
            .agg(F.sum(F.when(F.col("pos") == 0, 1).otherwise(0)).alias("n_rows"),
                 F.array_sort(F.collect_set(F.struct("pos", "name"))).alias("names"))
            .select("doc_id", "text_sha256", "n_rows", F.size("names").alias("n_blocks"),
                    F.col("names.name").alias("names")))
    done, level = [], 0
    while True:
        rows = cut(rows)
        one = F.size("names") == 1
        done.append(rows.where(one).select("doc_id", "text_sha256", "n_rows", "n_blocks",
                                           F.element_at("names", 1).alias("name")))
        rows = rows.where(~one)
        if rows.isEmpty():
            break
        level += 1
        half = F.sequence(F.lit(0), F.floor((F.size("names") - 1) / 2).cast("int"))
        pairs = F.transform(half, lambda i: F.struct(
            F.col("names")[2 * i].alias("left"),
            F.coalesce(F.try_element_at("names", 2 * i + 2), F.lit(0)).cast("bigint").alias("right")))
        items = (rows.select("doc_id", "text_sha256", "n_rows", "n_blocks", F.posexplode(pairs).alias("pos", "item"))
                 .withColumn("bucket", _bucket(F.struct("item.left", "item.right"), bucket_bits)))
        rows = (_named(items, level).groupBy("doc_id", "text_sha256", "n_rows", "n_blocks")
                .agg(F.array_sort(F.collect_list(F.struct("pos", "name"))).alias("names"))
                .withColumn("names", F.col("names.name")))
    out = done[0]
    for d in done[1:]:
        out = out.unionByName(d)
    return out


def exact_groups(docs: DataFrame, block_chars: int = BLOCK_CHARS, bucket_bits: int = BUCKET_BITS) -> DataFrame:
    """One row per input row: doc_id, keep_id, group_size, kept, text_sha256.

    Texts are equal when they are identical after lower-casing A-Z; NULL counts as empty. Of equal texts
    the row with the largest doc_id stays (``kept``); among repeated rows of that doc_id, one. NULL
    doc_ids lose to any other; a group with no other doc_id has a NULL keep_id and keeps one row. An empty
    table gives no rows.
    """
    ident = identities(docs, block_chars, bucket_bits)
    groups = ident.groupBy("n_blocks", "name").agg(F.max("doc_id").alias("keep_id"), F.sum("n_rows").alias("group_size"),
                                                   F.count(F.lit(1)).alias("members"))
    shared = table(groups.where("members > 1").drop("members"), "groups")  # written, so both sides of the join can be split
    return (ident.join(shared, ["n_blocks", "name"], "left")
            .select("doc_id", F.when(F.col("group_size").isNull(), F.col("doc_id")).otherwise(F.col("keep_id")).alias("keep_id"),
                    F.coalesce("group_size", "n_rows").alias("group_size"), "text_sha256",
                    F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("n_rows"))).alias("nth"))
            .select("doc_id", "keep_id", "group_size",
                    (F.col("doc_id").eqNullSafe(F.col("keep_id")) & (F.col("nth") == 1)).alias("kept"), "text_sha256"))


def drop_exact(docs: DataFrame) -> DataFrame:
    """``docs`` with one row per group of equal texts (the kept one); same columns.

    Among repeated rows of the kept doc_id, the first by text, then by the other plain columns, stays.
    """
    key, nth = free_name(docs, "_key"), free_name(docs, "_nth")
    kept = exact_groups(docs).where("kept").select(
        F.concat_ws("|", F.col("doc_id").cast("string"), "text_sha256").alias(key))
    rows = docs.withColumn(key, F.concat_ws("|", F.col("doc_id").cast("string"), F.sha2(lower_ascii(text_of()), 256)))
    plain = [c for c, kind in docs.dtypes if not kind.startswith(("map", "array", "struct", "variant"))]
    order = Window.partitionBy(key).orderBy("text", *[c for c in plain if c != "text"])
    return (rows.join(kept, key, "left_semi").withColumn(nth, F.row_number().over(order))
            .where(F.col(nth) == 1).select(*docs.columns))
