"""Mixing sources to target weights by systematic sampling.

Each source has a target number of words; its rate is target / words, the expected copies of each of its
documents. Within a source the documents are put in order (by size, then doc_id) and their expected copies
are summed up; one random offset is added to the sums, and a document is emitted once for each integer
boundary that its interval crosses. The order by size makes the words taken telescope: they differ from the
target by about the size of the largest document at most.

A source can hold a third of all rows, so the prefix sum is taken in two steps: rows are range-partitioned
on the full order (a hot source spans many ranges), each (range, source) is summed, the few sums are
prefix-summed, and rows add their range's start. Sums are whole numbers in units of 2**-32 copies, so
neither the order of additions nor a rerun can move a boundary.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import cut, free_name

WEIGHTS = (1, 2, 3)
MAX_COPIES = 3
SEED = "mix-2"
UNIT = 2**32


def word_count(c: Column) -> Column:
    """Number of maximal runs of characters that are not ASCII white space; NULL has none."""
    return F.coalesce(F.regexp_count(c.cast("string"), F.lit(r"[^\x20\x09-\x0D]+")).cast("bigint"), F.lit(0).cast("bigint"))


def offset(source: Column, seed: str = SEED) -> Column:
    """A source's random offset in units of 2**-32, fixed by the seed."""
    named = F.concat(F.lit(f"{seed}|"), F.coalesce(F.concat(F.lit("s"), source.cast("string")), F.lit("null")))
    return F.conv(F.substring(F.sha2(named, 256), 1, 8), 16, 10).cast("bigint")


def targets(sizes: DataFrame, weights=WEIGHTS, max_copies: int = MAX_COPIES) -> DataFrame:
    """source, source_size, target: from (source, size) rows.

    Sources in code point order, NULL last, weigh ``weights``, repeating, and share the words of all
    sources; no target exceeds ``max_copies`` times its source's words, and the excess goes to the others
    by weight. In closed form: in the order of cap / weight the capped sources come first, and the others
    share what is left. One row per source; only this table is ever put in one order.
    """
    by_source = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    ranked = by_source.withColumn("nth", F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())))
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), ((F.col("nth") - 1) % len(weights) + 1).cast("int"))
    whole = "decimal(38,0)"
    s = (ranked.withColumn("weight", weight.cast("bigint")).withColumn("cap", F.col("source_size") * max_copies))
    order = Window.orderBy(F.col("cap") / F.col("weight"), "nth")
    before = F.coalesce(F.sum("cap").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    s = (s.withColumn("total", F.sum("source_size").over(Window.partitionBy()))
         .withColumn("rest", F.col("total") - before)
         .withColumn("open", F.sum("weight").over(order.rowsBetween(Window.currentRow, Window.unboundedFollowing)))
         .withColumn("capped", F.col("rest").cast(whole) * F.col("weight") > F.col("cap").cast(whole) * F.col("open")))
    free = F.when(~F.col("capped"), F.col("weight"))
    everyone = Window.partitionBy()
    level_rest = F.col("total") - F.coalesce(F.sum(F.when(F.col("capped"), F.col("cap"))).over(everyone), F.lit(0))
    share = F.col("weight") * level_rest.cast("double") / F.sum(free).over(everyone).cast("double")
    return s.select("source", "source_size",
                    F.when(F.col("capped"), F.col("cap").cast("double")).otherwise(share).alias("target"))


def copies(sized: DataFrame, goals: DataFrame, seed: str = SEED, max_copies: int = MAX_COPIES) -> DataFrame:
    """``sized`` (source, size, doc_id, tie) with source_size, target and ``copies``, the times each row is taken.

    ``tie`` orders rows of one doc_id. Rows that agree in all four are interchangeable. NULL sources are one
    source, NULL doc_ids come first. A source without words has target 0 and gives no copies.
    """
    g = goals.withColumnRenamed("source", "_source")
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    rows = (sized.join(g, sized["source"].eqNullSafe(g["_source"])).drop("_source")
            .withColumn("part", F.round(F.least(rate, F.lit(float(max_copies))) * UNIT).cast("bigint")))
    order = ["source", "size", "doc_id", "tie"]
    rows = cut(rows.repartitionByRange(*order).withColumn("range", F.spark_partition_id()))
    whole = "decimal(38,0)"
    before = Window.partitionBy("source").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    starts = (rows.groupBy("source", "range").agg(F.sum(F.col("part").cast("decimal(20,0)")).cast(whole).alias("sum"))
              .select(F.col("source").alias("_source"), F.col("range").alias("_range"),
                      F.coalesce(F.sum("sum").over(before), F.lit(0)).cast(whole).alias("start")))
    own = (Window.partitionBy("source", "range").orderBy("size", "doc_id", "tie")
           .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    summed = rows.withColumn("upto", F.sum(F.col("part").cast("decimal(20,0)")).over(own))
    placed = summed.join(starts, summed["source"].eqNullSafe(F.col("_source")) & (F.col("range") == F.col("_range")))
    end = (F.col("start") + F.col("upto") + offset(F.col("source"), seed)).cast(whole)
    crossed = F.floor(end / F.lit(UNIT).cast("decimal(12,0)")) - F.floor((end - F.col("part")) / F.lit(UNIT).cast("decimal(12,0)"))
    return placed.select(*order, "source_size", "target", crossed.cast("bigint").alias("copies"))


def sized(docs: DataFrame) -> DataFrame:
    return docs.select("source", word_count(F.col("text")).alias("size"), "doc_id",
                       F.xxhash64(F.coalesce(F.col("text"), F.lit(""))).alias("tie"))


def mix(docs: DataFrame, weights=WEIGHTS, seed: str = SEED, max_copies: int = MAX_COPIES) -> DataFrame:
    """doc_id, size, source_size, target, taken: one row per row of ``docs``; taken = copies * size.

    NULL and empty texts have size 0 and take nothing; repeated rows each take their own part; an empty
    table gives no rows; other columns of ``docs`` are not read.
    """
    s = cut(sized(docs))
    return copies(s, targets(s, weights, max_copies), seed, max_copies).select(
        "doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"))


def sample(docs: DataFrame, weights=WEIGHTS, seed: str = SEED, max_copies: int = MAX_COPIES) -> DataFrame:
    """The mix itself: each row of ``docs`` repeated as often as it is taken, with the columns of ``docs``.

    NULL and empty texts have size 0 and are never taken; NULL is a source of its own; repeated rows each have their
    own copies; an empty table gives no rows.
    """
    s = cut(sized(docs))
    taken = copies(s, targets(s, weights, max_copies), seed, max_copies).where("copies > 0")
    key, tie, nth, times, each = (free_name(docs, n) for n in ("_key", "_tie", "_nth", "_times", "_each"))
    same = Window.partitionBy(key, tie)
    joined = lambda d: F.concat_ws("|", F.coalesce(d["doc_id"].cast("string"), F.lit("null")), d["source"])
    taken = taken.select(joined(taken).alias(key), F.col("tie").alias(tie), F.col("copies").alias(times))
    taken = taken.withColumn(nth, F.row_number().over(same.orderBy(F.col(times).desc())))
    rows = docs.withColumn(key, joined(docs)).withColumn(tie, F.xxhash64(F.coalesce(F.col("text"), F.lit(""))))
    plain = [c for c, kind in docs.dtypes if c != "text" and not kind.startswith(("map", "array", "struct", "variant"))]
    rows = rows.withColumn(nth, F.row_number().over(same.orderBy(*(plain or [key]))))
    return (rows.join(taken, [key, tie, nth])
            .withColumn(each, F.explode(F.sequence(F.lit(1).cast("bigint"), F.col(times)))).select(*docs.columns))
