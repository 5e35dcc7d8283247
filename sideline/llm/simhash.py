"""SimHash near-dedup by meet-in-the-middle ball hashing.

Two fingerprints differ in at most r bits if and only if some 64-bit value lies within r // 2 bits of one and
within r - r // 2 bits of the other. So every distinct fingerprint emits all variants within half the radius
(2081 for r = 4); fingerprints that share a variant are linked.

The shuffle is on the leading bits of the variants: a fingerprint is sent to each value its variants' leading
bits can take (29 rows for 7 bits instead of 2081), and the task that owns those leading bits makes the
remaining bits of the variants, sorts them and finds equal ones. The number of leading bits grows with the
number of fingerprints so that a task's share stays the same; shares that are still too large (dense groups)
are sent on by their next bits until none is. In a task, work larger than its memory bound is again split by further bits.

All fingerprints that share a variant lie within the radius of each other, so each run of equal variants gives
a star of links to its smallest member, verified bit by bit, not all pairs. Links are reduced to a forest
within the task, again and again as they come, and joined to components over the whole corpus by alternating stars (each step a few joins and
partial aggregates over links, checkpointed). Exact copies meet as one fingerprint before all this.
"""

from __future__ import annotations

import math
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from .common import cut, free_name, small_batches, table, text_of

SHINGLE_WORDS = 4
MAX_BITS = 4
SEED = 42
#: Variants that one task is meant to hold, and that it holds at once at most.
TASK_VARIANTS = 4_000_000
CHUNK_VARIANTS = 6_000_000
SPLIT_BITS = 6
MOST_BITS = 60


def fingerprint(text: str, shingle_words: int = SHINGLE_WORDS) -> int:
    """Signed 64-bit SimHash of a text: bit set if set in over half of the shingles' hashes."""
    words = text.encode().lower().split()  # ASCII only: A-Z, and white space as \\x20 \\x09-\\x0D
    if not words:
        return 0
    last = max(len(words) - shingle_words, 0)
    hashes = [xxhash.xxh64_intdigest(b" ".join(words[i:i + shingle_words]), SEED) for i in range(last + 1)]
    counts = np.zeros(64, "int64")
    for i in range(0, len(hashes), 65536):
        some = np.array(hashes[i:i + 65536], "<u8").view("u1").reshape(-1, 8)
        counts += np.unpackbits(some, axis=1, bitorder="little").sum(axis=0, dtype="int64")
    bits = np.packbits(counts * 2 > len(hashes), bitorder="little")
    return int(bits.view("<i8")[0])


def fingerprints(docs: DataFrame, shingle_words: int = SHINGLE_WORDS):
    """A function of a text column that gives its fingerprint (bigint)."""
    small_batches(docs)

    @arrow_udf("bigint")
    def simhash(texts: pa.Array) -> pa.Array:
        return pa.array([fingerprint(t.as_py() or "", shingle_words) for t in texts], pa.int64())

    return simhash


def _masks(bits: int, flips: int) -> np.ndarray:
    """All ``bits``-wide masks with at most ``flips`` bits set, fewest first."""
    return np.array([sum(1 << b for b in c) for k in range(flips + 1) for c in combinations(range(bits), k)], "uint64")


def _stars(low: np.ndarray, ids: np.ndarray, spare: np.ndarray, width: int, out) -> None:
    """Links between rows of ``ids`` that share a variant of their ``width`` low bits; a row may flip
    ``spare`` bits of them. Work beyond CHUNK_VARIANTS is split by the next leading bits."""
    top = int(spare.max(initial=0))
    sizes = [sum(math.comb(width, k) for k in range(s + 1)) for s in range(top + 1)]
    if len(low) < 2:
        return
    if sum(sizes[s] * int((spare == s).sum()) for s in range(top + 1)) > CHUNK_VARIANTS and width > 1:
        step = min(4, width)
        lead = low >> np.uint64(width - step)
        rest = low & np.uint64((1 << (width - step)) - 1)
        flips = np.array([bin(x).count("1") for x in range(1 << step)])
        for q in range(1 << step):
            used = flips[(lead ^ np.uint64(q)).astype("int64")]
            near = used <= spare
            _stars(rest[near], ids[near], (spare - used)[near], width - step, out)
        return
    variants, owners = [], []
    for s in range(top + 1):
        own = spare == s
        masks = _masks(width, s)
        variants.append((low[own][:, None] ^ masks[None, :]).ravel())
        owners.append(np.repeat(ids[own], len(masks)))
    v, o = np.concatenate(variants), np.concatenate(owners)
    order = np.argsort(v)
    v = v[order]
    same = v[1:] == v[:-1]
    inside = np.zeros(len(v), bool)
    inside[1:] |= same
    inside[:-1] |= same
    at = np.flatnonzero(inside)  # only members of runs of two or more
    if not len(at):
        return
    o, v = o[order[at]], v[at]
    begins = np.flatnonzero(np.r_[True, v[1:] != v[:-1]])
    least = np.minimum.reduceat(o, begins)
    hub = np.repeat(least, np.diff(np.r_[begins, len(o)]))
    links = np.unique(np.stack([hub, o], axis=1)[hub != o], axis=0)
    if len(links):
        out.append(links)


def _roots(links: np.ndarray, n: int) -> np.ndarray:
    """Smallest index reachable from each of ``n`` indices."""
    root = np.arange(n)
    while True:
        low = np.minimum(root[links[:, 0]], root[links[:, 1]])
        new = root.copy()
        np.minimum.at(new, root[links[:, 0]], low)
        np.minimum.at(new, root[links[:, 1]], low)
        new = new[new]
        if (new == root).all():
            return root
        root = new


class _Forest:
    """Links among ``fps``, verified and reduced to a forest whenever as many as there are nodes (or a million) wait."""

    def __init__(self, fps: np.ndarray, radius: int):
        self.fps, self.radius = fps, radius
        self.root = np.arange(len(fps))
        self.waiting: list[np.ndarray] = []
        self.held = 0

    def append(self, links: np.ndarray) -> None:
        self.waiting.append(links)
        self.held += len(links)
        if self.held > max(len(self.fps), 1_000_000):
            self.reduce()

    def reduce(self) -> None:
        if self.waiting:
            links = np.concatenate(self.waiting)
            links = links[np.bitwise_count(self.fps[links[:, 0]] ^ self.fps[links[:, 1]]) <= self.radius]
            own = np.stack([np.arange(len(self.root)), self.root], axis=1)
            self.root = _roots(np.concatenate([own, links]), len(self.root))
            self.waiting, self.held = [], 0

    def links(self) -> np.ndarray:
        self.reduce()
        child = np.flatnonzero(self.root != np.arange(len(self.root)))
        return np.stack([self.fps[child], self.fps[self.root[child]]], axis=1)


def _links_of(fps: np.ndarray, part: int, lead_bits: int, radius: int, half: int) -> np.ndarray:
    """Verified links, as a forest, among fingerprints sent to one value of the leading bits."""
    fps = np.unique(fps)
    low = fps & np.uint64((1 << (64 - lead_bits)) - 1) if lead_bits else fps
    lead = (fps >> np.uint64(64 - lead_bits)) ^ np.uint64(part) if lead_bits else np.zeros(len(fps), "uint64")
    spare = half - np.bitwise_count(lead).astype("int64")
    found = _Forest(fps, radius)
    _stars(low, np.arange(len(fps)), spare, 64 - lead_bits, found)
    return found.links()


def parts_of(fps: DataFrame, max_bits: int = MAX_BITS, task_variants: int = TASK_VARIANTS) -> DataFrame:
    """fp, part, spare, lead: each fingerprint at every value of the ``lead`` leading bits that its variants can take, with
    the flips that are left. As many bits as keep a part at about ``task_variants`` on average; parts of over four
    times as many variants are sent on by further bits, again and again, until none is left."""
    half = max_bits // 2
    n = fps.count()
    ball = sum(math.comb(64, k) for k in range(half + 1))
    bits = min(MOST_BITS, max(0, math.ceil(math.log2(max(1, n * ball / task_variants)))))

    def sent(lead: int, made: int, left):
        """Rows for each value that ``made`` more leading bits of the variants can take."""
        masks = F.lit(",".join(map(str, _masks(made, half).tolist())))
        flips = F.explode(F.split(masks, ",").cast("array<bigint>")).alias("mask")
        return left.select("fp", "part", "spare", flips).where(F.bit_count("mask") <= F.col("spare")).select(
            "fp", ((F.col("part") * F.lit(1 << made)) + (F.shiftrightunsigned("fp", 64 - lead - made).bitwiseAND(F.lit((1 << made) - 1))
                                                          .bitwiseXOR(F.col("mask")))).alias("part"),
            (F.col("spare") - F.bit_count("mask")).alias("spare"))

    rows = fps.select("fp", F.lit(0).cast("bigint").alias("part"), F.lit(half).alias("spare"))
    if bits:
        rows = sent(0, bits, rows)
    done = []
    while True:
        width = 64 - bits
        cost = sum((F.when(F.col("spare") == s, F.lit(sum(math.comb(width, k) for k in range(s + 1)))).otherwise(0)
                    for s in range(half + 1)), F.lit(0)).cast("bigint")
        dense = table(rows.groupBy("part").agg(F.sum(cost).alias("cost")).where(F.col("cost") > 4 * task_variants)
                      .select("part", F.lit(True).alias("dense")), "dense")
        if bits + SPLIT_BITS > MOST_BITS or dense.isEmpty():
            done.append(rows.withColumn("lead", F.lit(bits)))
            break
        rows = rows.join(dense, "part", "left")
        done.append(rows.where("dense is null").select("fp", "part", "spare", F.lit(bits).alias("lead")))
        rows = table(sent(bits, SPLIT_BITS, rows.where("dense")), "sent-on")
        bits += SPLIT_BITS
    out = done[0]
    for more in done[1:]:
        out = out.unionByName(more)
    return out


def links(fps: DataFrame, max_bits: int = MAX_BITS, task_variants: int = TASK_VARIANTS) -> DataFrame:
    """a, b: links among the distinct values of ``fps`` (column fp, bigint); any two values that differ in at
    most ``max_bits`` bits are connected through links, and no link joins values of different components."""
    if max_bits % 2:
        raise ValueError("the radius must be even, so that both halves are equal")
    half = max_bits // 2

    def of_part(rows: pd.DataFrame) -> pd.DataFrame:
        found = _links_of(rows["fp"].to_numpy("int64").view("uint64"), int(rows["part"].iloc[0]), int(rows["lead"].iloc[0]),
                          max_bits, half)
        return pd.DataFrame({"a": found[:, 0].view("int64") if len(found) else np.zeros(0, "int64"),
                             "b": found[:, 1].view("int64") if len(found) else np.zeros(0, "int64")})

    parts = parts_of(fps, max_bits, task_variants).drop("spare")
    return parts.groupBy("lead", "part").applyInPandas(of_part, "a bigint, b bigint")


def components(edges: DataFrame) -> DataFrame:
    """node, root: each node that has a link, and the smallest node it is connected to.

    Alternating stars: each node's larger neighbours are linked to the smallest of its neighbourhood, then each
    node and its smaller neighbours to the smallest of those, until nothing changes. A node's smallest neighbour
    is a partial aggregate; hubs with many links are joined on a table of one row per node, which AQE splits.
    """
    pairs = cut(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u != v").distinct())
    state = None
    while True:
        both = pairs.unionByName(pairs.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = (both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .where("u != v").distinct())
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (large.join(low, "u").select(F.explode(F.array(F.struct("u", F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e"))
                 .select("e.u", "e.v").where("u != v").distinct())
        pairs = cut(small)
        new = pairs.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if new == state:
            break
        state = new
    roots = pairs.groupBy("u").agg(F.min("v").alias("root")).select(F.col("u").alias("node"), "root")
    return roots


def _grouped(docs: DataFrame, shingle_words: int, max_bits: int) -> DataFrame:
    """doc_id, tie, fp, root, component_id of every row."""
    t = text_of()
    rows = cut(docs.select("doc_id", F.xxhash64(t).alias("tie"), fingerprints(docs, shingle_words)(t).alias("fp")))
    fps = cut(rows.groupBy("fp").agg(F.min("doc_id").alias("least")))
    roots = components(links(fps.select("fp"), max_bits))
    rooted = cut(fps.join(roots, fps["fp"] == roots["node"], "left")
                 .select("fp", "least", F.coalesce("root", "fp").alias("root")))
    smallest = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    return rows.join(rooted.join(smallest, "root").select("fp", "root", "component_id"), "fp")


def near_groups(docs: DataFrame, shingle_words: int = SHINGLE_WORDS, max_bits: int = MAX_BITS) -> DataFrame:
    """doc_id, fp (bigint), component_id: one row per row of ``docs``.

    Texts whose fingerprints differ in at most ``max_bits`` bits are linked; component_id is the smallest doc_id
    that links reach. NULL and wordless texts have fingerprint 0, linked like any other; a text of fewer words
    than a shingle is one shingle. Repeated rows repeat; a NULL doc_id is never the smallest, and a component
    of NULL doc_ids alone has a NULL component_id; an empty table gives no rows. Other columns are not read.
    """
    return _grouped(docs, shingle_words, max_bits).select("doc_id", "fp", "component_id")


def keep_one(docs: DataFrame, shingle_words: int = SHINGLE_WORDS, max_bits: int = MAX_BITS) -> DataFrame:
    """``docs`` with one row of each component, that of the smallest doc_id (NULL last); same columns. Of
    repeated rows of that doc_id, the first by the other plain columns stays."""
    key, tie, nth = (free_name(docs, c) for c in ("_key", "_tie", "_nth"))
    first = F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "tie"))
    kept = (_grouped(docs, shingle_words, max_bits).groupBy("root").agg(first.alias("one"))
            .select(F.coalesce(F.col("one.doc_id").cast("string"), F.lit("null")).alias(key), F.col("one.tie").alias(tie)))
    rows = (docs.withColumn(key, F.coalesce(docs["doc_id"].cast("string"), F.lit("null")))
            .withColumn(tie, F.xxhash64(text_of())))
    plain = [c for c, kind in docs.dtypes if c != "text" and not kind.startswith(("map", "array", "struct", "variant"))]
    order = Window.partitionBy(key, tie).orderBy(*(plain or [key]))
    return (rows.join(kept, [key, tie], "left_semi").withColumn(nth, F.row_number().over(order))
            .where(F.col(nth) == 1).select(*docs.columns))
