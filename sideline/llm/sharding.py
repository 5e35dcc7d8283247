"""Sharding by sampled splitters, under the law ``bytes``: the shards' sizes are near equal.

A size-weighted sample of keys gives quantile boundaries that cut the key space into many fine ranges of
about equal bytes. A key that holds several ranges' worth of bytes shows as a boundary drawn several times;
its rows are dealt over those ranges by doc_id. The ranges' real sizes are then measured, and ranges that
turn out overfull are subdivided (by key first, by doc_id if one key still fills them). Last, consecutive
ranges fill the shards, and each range's start and its rows' places in it give gapless slots.

The key is a hash of the text, so equal texts lie together and mostly share a shard; only a group heavier
than a fine range is spread. Texts are read once; all later steps work on (key, doc_id, size, crc) rows.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import cut, table, text_of

SHARDS = 8
RANGES_PER_SHARD = 128
SAMPLES_PER_RANGE = 16
ROWS_PER_RANGE = 1_000_000
OVERFULL = 2.0


def _number(of: Column, digits: int) -> Column:
    """The first hexadecimal digits of an MD5 as a number (plain SQL can repeat it)."""
    return F.conv(F.substring(F.md5(of.cast("binary")), 1, digits), 16, 10).cast("bigint")


def _row_number(purpose: str) -> Column:
    """A number below 2**52 from a row's doc_id, key and size, another one for each purpose."""
    return _number(F.concat_ws("|", F.lit(purpose), "key", F.coalesce(F.col("doc_id").cast("string"), F.lit("null")), "size"), 13)


def sized(docs: DataFrame) -> DataFrame:
    """doc_id, size, crc, key of every row."""
    t = text_of()
    return docs.select("doc_id", (F.octet_length(t) + 1).cast("bigint").alias("size"),
                       F.crc32(t.cast("binary")).alias("crc"), _number(t, 15).alias("key"))


def splitters(rows: DataFrame, total: int, ranges: int, per_range: int = SAMPLES_PER_RANGE) -> list[int]:
    """At most ``ranges - 1`` boundaries: quantiles of about ``ranges * per_range`` keys, drawn with chances
    in proportion to size (a row larger than one share is drawn several times). Bounded by its parameters."""
    share = F.col("size") * F.lit(ranges * per_range / max(total, 1))
    chance = _row_number("draw") / F.lit(float(2**52))
    drawn = rows.select("key", F.floor(share + chance).cast("int").alias("n")).where("n > 0")
    keys = drawn.select(F.explode(F.array_repeat("key", F.col("n"))).alias("key"))
    got = keys.agg(F.array_sort(F.collect_list("key")).alias("k"))
    n = F.size("k")
    at = F.transform(F.sequence(F.lit(1), F.lit(ranges - 1)), lambda i: F.floor(i * n / ranges).cast("int"))
    picked = got.select(F.when(n >= ranges, F.transform(at, lambda i: F.col("k")[i])).otherwise(F.col("k")).alias("s"))
    return picked.first()["s"] if ranges > 1 else []


def _bound(cuts: list[int], key: Column, upper: bool) -> Column:
    """How many of the sorted ``cuts`` are below ``key`` (with ``upper``: or equal to it), by binary search."""
    if not cuts:
        return F.lit(0)
    array = F.split(F.lit(",".join(map(str, cuts))), ",").cast("array<bigint>")  # folded into one literal
    steps = F.array(*[F.lit(2**b) for b in reversed(range(len(cuts).bit_length()))])

    def step(pos, width):
        at = pos + width
        value = F.try_element_at(array, at)
        goes = (value <= key) if upper else (value < key)
        return F.when(goes, at).otherwise(pos)

    return F.aggregate(steps, F.lit(0), step)


def ranged(rows: DataFrame, total: int, ranges: int) -> DataFrame:
    """``rows`` with ``range`` and the subdivisions ``by_key`` and ``by_doc`` (0 where not subdivided)."""
    cuts = splitters(rows, total, ranges)
    # rows of a key that is drawn as a boundary c >= 2 times are dealt over the c - 1 ranges it fills
    r = rows.withColumn("hi", _bound(cuts, F.col("key"), True)).withColumn("lo", _bound(cuts, F.col("key"), False))
    deal = F.col("lo") + 1 + F.pmod(_row_number("deal"), F.col("hi") - F.col("lo") - 1).cast("int")
    r = r.withColumn("range", F.when(F.col("hi") - F.col("lo") >= 2, deal).otherwise(F.col("hi"))).drop("hi", "lo")
    r = cut(r.withColumns({"by_key": F.lit(0), "by_doc": F.lit(0)}))
    mean = max(total / ranges, 1.0)
    for name, hashed in (("by_key", _number(F.concat_ws("|", F.lit("part"), "key"), 13)), ("by_doc", _row_number("part"))):
        full = (r.groupBy("range", "by_key").agg(F.sum("size").alias("held")).where(F.col("held") > OVERFULL * mean)
                .select("range", "by_key", F.ceil(F.col("held") / mean).cast("int").alias("parts")))
        full = table(full, "overfull")  # at most ranges / OVERFULL rows
        sub = F.coalesce(F.pmod(hashed, F.col("parts")).cast("int"), F.lit(0))
        columns = [sub.alias(c) if c == name else F.col(c) for c in r.columns]
        r = r.join(full, ["range", "by_key"], "left").select(*columns)
    return r


def shard(docs: DataFrame, shards: int = SHARDS, ranges_per_shard: int = RANGES_PER_SHARD,
          rows_per_range: int = ROWS_PER_RANGE) -> DataFrame:
    """doc_id, size, text_crc32, shard, slot: one row per row of ``docs``.

    ``size`` is the text's UTF-8 bytes plus 1 (NULL: 1). Slots count from 0 without gaps in each shard.
    Repeated rows are interchangeable; NULL doc_ids come first. Reruns agree. A document is never cut, so a
    shard can miss its share by about half the largest document. An empty table gives no rows.
    """
    rows = cut(sized(docs))
    n, total = rows.agg(F.count(F.lit(1)), F.coalesce(F.sum("size"), F.lit(0))).first()
    ranges = max(shards * ranges_per_shard, math.ceil(n / rows_per_range))
    place = ["range", "by_key", "by_doc"]
    r = cut(ranged(rows, total, ranges))
    order = Window.orderBy(*place)
    before = lambda w, c: F.coalesce(F.sum(c).over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    held = r.groupBy(*place).agg(F.sum("size").alias("held"), F.count(F.lit(1)).alias("n"))
    middle = before(order, "held") + F.col("held") / 2
    held = held.withColumn("shard", F.least(F.floor(middle * shards / max(total, 1)).cast("int"), F.lit(shards - 1)))
    held = held.withColumn("first", before(Window.partitionBy("shard").orderBy(*place), "n"))
    held = table(held.select(*place, "shard", "first"), "ranges")  # a few rows per range
    own = Window.partitionBy(*place).orderBy("key", "doc_id", "size", "crc")
    return (r.withColumn("nth", F.row_number().over(own)).join(held, place)
            .select("doc_id", "size", F.col("crc").alias("text_crc32"), "shard",
                    (F.col("first") + F.col("nth") - 1).alias("slot")))
