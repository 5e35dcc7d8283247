"""MinHash near-dedup by a multi-index Hamming join over b-bit signatures.

A document is the set of its word shingles. Its signature has CHUNKS * WIDTH components of 8 bits, each taken from the
least value of the set under one of as many hash functions, so two sets of Jaccard similarity s agree in a component
with probability s (and 1/256 of the rest). The distance of two signatures is the number of components that differ.

The signature is split into CHUNKS chunks of WIDTH components. By pigeonhole, signatures at a distance of at most
2 * CHUNKS - 1 = 39 agree in some chunk up to one component. So each signature is listed, chunk by chunk, under every
choice of one component left out (CHUNKS * WIDTH = 120 keys), and all pairs up to distance 39 meet under some key.
A pair of similarity 0.85 is expected at distance 18; it lies beyond 39 with a probability below one in a million, and
even then is found unless all 20 chunks have two errors.

Pairs under a key are not all made. First each key links its members to the one that meets most others (its hub), each
distinct pair is held against the full shingle sets, and what is confirmed is joined into components. Then only pairs of
*different* components that share a key remain: blocks of bounded size are compared by signature, each pair under the
first key it shares, and what is within the distance and can reach the similarity by size is confirmed on the full sets
too. So every pair under the distance is either compared or already connected. Sets of equal content meet as one node
before all this. Shingles are named by 64 bits; two different ones of a pair agree with probability 2**-64.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from .common import cut, free_name, small_batches, table, text_of
from .simhash import components

SHINGLE_WORDS = 3
PERCENT = 85
CHUNKS = 20
WIDTH = 6
DISTANCE = 2 * CHUNKS - 1
#: Members of a key that are compared with as many others at a time.
BLOCK_ROWS = 512
#: Shingles that the rows of a bin of blocks have in all, about.
BIN_SHINGLES = 2_000_000
#: Bits of the bitmap of documents whose sets are made: 1 MiB, whatever their number.
BITS = 1 << 23
_BUCKET = 1 << 15

_K = [np.uint64(k) for k in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9)]
#: Odd multipliers, one for each component, from their numbers.
_HASHES = np.array([xxhash.xxh64_intdigest(b"component %d" % i) | 1 for i in range(CHUNKS * WIDTH)], "uint64")


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * _K[0]
    x = (x ^ (x >> np.uint64(29))) * _K[1]
    return x ^ (x >> np.uint64(32))


def shingle_set(text: bytes, shingle_words: int = SHINGLE_WORDS) -> np.ndarray:
    """Sorted 64-bit names of the different shingles; of fewer words, of the whole sequence; of none, empty."""
    words = text.lower().split()  # ASCII only: A-Z, and white space as \\x20 \\x09-\\x0D
    if not words:
        return np.zeros(0, "uint64")
    coded = pa.array(words, pa.binary()).dictionary_encode()
    names = np.array([xxhash.xxh64_intdigest(w) for w in coded.dictionary.to_pylist()], "uint64")[coded.indices.to_numpy()]
    k = min(shingle_words, len(names))
    out = np.full(len(names) - k + 1, k, "uint64") * _K[2]
    for i in range(k):
        out = _mixed(out + names[i:len(names) - k + 1 + i])
    return np.unique(out)


def signature(names: np.ndarray) -> bytes:
    least = np.empty(len(_HASHES), "uint64")
    step = max(1, (1 << 17) // max(len(names), 1))  # the products of a step stay in the cache
    for i in range(0, len(_HASHES), step):
        least[i:i + step] = (_HASHES[i:i + step, None] * names[None, :]).min(axis=1)
    return ((least * _K[0]) >> np.uint64(56)).astype("uint8").tobytes()


def _signer(shingle_words: int):
    """A function of a text column: n_shingles, key (128 bits that name the set) and signature (NULL without words)."""

    @arrow_udf("n_shingles bigint, key binary, signature binary")
    def signed(texts: pa.Array) -> pa.Array:
        out: tuple[list, list, list] = ([], [], [])
        for t in texts.cast(pa.binary()):
            names = shingle_set(t.as_py() or b"", shingle_words)
            out[0].append(len(names))
            out[1].append(xxhash.xxh3_128_digest(names.tobytes()) if len(names) else None)
            out[2].append(signature(names) if len(names) else None)
        return pa.StructArray.from_arrays([pa.array(out[0], pa.int64()), pa.array(out[1], pa.binary()), pa.array(out[2], pa.binary())],
                                          ["n_shingles", "key", "signature"])

    return signed


def _keys(signatures: np.ndarray) -> np.ndarray:
    """Keys of each signature (rows): a chunk's components but one, and which chunk and which one is left out."""
    chunks = signatures.reshape(-1, CHUNKS, WIDTH).astype("int64")
    out = np.zeros((len(chunks), CHUNKS, WIDTH), "int64")
    for left_out in range(WIDTH):
        for i in range(WIDTH):
            if i != left_out:
                out[:, :, left_out] = out[:, :, left_out] << 8 | chunks[:, :, i]
        out[:, :, left_out] = (out[:, :, left_out] * CHUNKS + np.arange(CHUNKS)) * WIDTH + left_out
    return out.reshape(len(chunks), CHUNKS * WIDTH)


def _signatures(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), "uint8").reshape(-1, CHUNKS * WIDTH)


def _listed(batches):
    for b in batches:
        keys = _keys(_signatures(b["signature"]))
        yield pa.record_batch({"key": pa.array(keys.ravel()), "node": pa.array(np.repeat(b["node"].to_numpy(), keys.shape[1]))})


def _distance():
    @arrow_udf("int")
    def distance(a: pa.Array, b: pa.Array) -> pa.Array:
        return pa.array((_signatures(a) != _signatures(b)).sum(axis=1).astype("int32"))

    return distance


def _similar(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    both = len(np.intersect1d(a, b, assume_unique=True))
    return 100 * both >= percent * (len(a) + len(b) - both)


def _confirmed(percent: int):
    @arrow_udf("boolean")
    def confirmed(a: pa.Array, b: pa.Array) -> pa.Array:
        return pa.array([_similar(np.frombuffer(x.as_buffer(), "uint64"), np.frombuffer(y.as_buffer(), "uint64"), percent)
                         for x, y in zip(a, b)], pa.bool_())

    return confirmed


def _sets(docs: DataFrame, nodes: DataFrame, wanted: DataFrame, shingle_words: int) -> DataFrame:
    """node, names: the shingle sets of the nodes ``wanted``, made anew from the texts of their first documents. A bitmap of
    fixed size tells which texts to read; what else has the same bit is joined away."""
    at = F.pmod(F.xxhash64("doc_id"), F.lit(BITS))
    parts = (nodes.join(wanted, "node", "left_semi").select(F.pmod(F.xxhash64("least"), F.lit(BITS)).alias("bit"))
             .groupBy(F.shiftright("bit", 15).alias("nth")).agg(F.bitmap_construct_agg(F.col("bit").bitwiseAND(F.lit(_BUCKET - 1))).alias("bits")).collect())
    held = bytearray(BITS // 8)
    for p in parts:
        held[p["nth"] * _BUCKET // 8:(p["nth"] + 1) * _BUCKET // 8] = p["bits"]
    held = bytes(held)

    @arrow_udf("key binary, names binary")
    def made(bits: pa.Array, texts: pa.Array) -> pa.Array:
        keys, names = [], []
        for bit, t in zip(bits.to_pylist(), texts.cast(pa.binary())):
            own = shingle_set(t.as_py(), shingle_words) if held[bit >> 3] >> (bit & 7) & 1 else ()
            names.append(own.tobytes() if len(own) else None)
            keys.append(xxhash.xxh3_128_digest(names[-1]) if len(own) else None)
        return pa.StructArray.from_arrays([pa.array(keys, pa.binary()), pa.array(names, pa.binary())], ["key", "names"])

    found = docs.select(F.col("doc_id").alias("least"), made(at, text_of()).alias("s")).where("s.key IS NOT NULL").select("least", "s.*")
    one = nodes.join(wanted, "node", "left_semi").select("node", "key", F.col("least").alias("_least"))
    return table(found.join(one, (found["key"] == one["key"]) & found["least"].eqNullSafe(one["_least"]))
                 .select("node", "names").dropDuplicates(["node"]), "minhash-sets")


def _members(nodes: DataFrame) -> DataFrame:
    """key, node, members: the keys that several nodes share."""
    keys = nodes.select("node", "signature").mapInArrow(_listed, "key bigint, node bigint")
    shared = keys.groupBy("key").agg(F.count(F.lit(1)).alias("members")).where(F.col("members") > 1)
    return table(keys.join(shared, "key"), "minhash-members")


def _star_links(members: DataFrame, nodes: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """a, b: confirmed links between members of a key and its hub, the one that meets most others over all keys."""
    degree = members.groupBy("node").agg(F.sum("members").alias("degree"))
    ranked = members.join(degree, "node").select("key", "node", F.struct("degree", "node").alias("rank"))
    hubs = ranked.groupBy("key").agg(F.max("rank").alias("hub")).select("key", F.col("hub.node").alias("hub"))
    pairs = members.join(hubs, "key").where("node != hub").select(F.least("node", "hub").alias("a"), F.greatest("node", "hub").alias("b")).distinct()
    one = nodes.select("node", "signature", "n_shingles")
    pairs = (pairs.join(one.withColumnsRenamed({"node": "a", "signature": "sa", "n_shingles": "na"}), "a")
             .join(one.withColumnsRenamed({"node": "b", "signature": "sb", "n_shingles": "nb"}), "b")
             .where(100 * F.least("na", "nb") >= percent * F.greatest("na", "nb"))
             .where(_distance()("sa", "sb") <= DISTANCE).select("a", "b"))
    pairs = table(pairs, "minhash-stars")
    return (pairs.join(sets.withColumnsRenamed({"node": "a", "names": "sa"}), "a").join(sets.withColumnsRenamed({"node": "b", "names": "sb"}), "b")
            .where(_confirmed(percent)("sa", "sb")).select("a", "b"))


def _pairs_of(size: np.ndarray, group: np.ndarray, small: int = 64):
    """Places (i, j), i < j, of rows of one group, some at a time; ``group`` is sorted, ``size`` its groups' sizes.
    Small groups are paired side by side, all of one offset at once, large ones row by row."""
    of = size[group]
    few = np.flatnonzero(of <= small)
    for d in range(1, int(of[few].max(initial=1))):
        i = few[:-d][group[few[:-d]] == group[few[d:]]] if len(few) > d else few[:0]
        if not len(i):
            break
        yield i, i + d
    for g in np.flatnonzero(size > small):
        own = np.flatnonzero(group == g)
        for n, i in enumerate(own[:-1]):
            yield np.full(len(own) - n - 1, i), own[n + 1:]


def _compared(percent: int):
    """The pairs to confirm of a bin of blocks: members of different components within the distance, each pair under
    the first key that it shares."""

    def of_bin(rows: pa.Table) -> pa.Table:
        columns = {c: rows[c].to_numpy() for c in ("key", "main", "other", "side", "node", "root", "n_shingles")}
        order = np.lexsort([columns[c] for c in ("node", "other", "main", "key")])
        key, main, other, side, node, root, n = (columns[c][order] for c in ("key", "main", "other", "side", "node", "root", "n_shingles"))
        signed = _signatures(rows["signature"])[order]
        change = np.r_[True, (key[1:] != key[:-1]) | (main[1:] != main[:-1]) | (other[1:] != other[:-1])]
        group = np.cumsum(change) - 1
        xs, ys = [], []
        for i, j in _pairs_of(np.bincount(group), group):
            ok = ((side[i] != side[j]) | (main[i] == other[i])) & (root[i] != root[j])
            ok &= 100 * np.minimum(n[i], n[j]) >= percent * np.maximum(n[i], n[j])
            i, j = i[ok], j[ok]
            for at in range(0, len(i), 1 << 14):
                p, q = i[at:at + (1 << 14)], j[at:at + (1 << 14)]
                near = (signed[p] != signed[q]).sum(axis=1) <= DISTANCE
                p, q = p[near], q[near]
                if len(p):
                    a, b = _keys(signed[p]), _keys(signed[q])
                    first = a[np.arange(len(p)), (a == b).argmax(axis=1)] == key[p]
                    xs.append(node[p[first]])
                    ys.append(node[q[first]])
        x, y = (np.concatenate(v) if v else np.zeros(0, "int64") for v in (xs, ys))
        some = int(len(x) > 0)
        return pa.table({"bin": pa.array([rows["bin"][0].as_py()] * some, pa.int64()),
                         "x": pa.array([x] * some, pa.list_(pa.int64())), "y": pa.array([y] * some, pa.list_(pa.int64()))})

    return of_bin


def _linked(percent: int):
    """Links among the pairs of a bin, held against the full sets; pairs that links connect already are not."""

    def of_bin(pairs: pa.Table, sets: pa.Table) -> pa.Table:
        names = {n: np.frombuffer(s.as_buffer(), "uint64") for n, s in zip(sets["node"].to_pylist(), sets["names"].combine_chunks())}
        root = {n: n for n in names}

        def find(n: int) -> int:
            while root[n] != n:
                root[n] = n = root[root[n]]
            return n

        links = []
        for xs, ys in zip(pairs["x"], pairs["y"]):
            for x, y in zip(xs.values.to_numpy().tolist(), ys.values.to_numpy().tolist()):
                a, b = find(x), find(y)
                if a != b and _similar(names[x], names[y], percent):
                    root[max(a, b)] = min(a, b)
                    links.append((x, y))
        return pa.table({"a": pa.array([a for a, _ in links], pa.int64()), "b": pa.array([b for _, b in links], pa.int64())})

    return of_bin


def _cross_links(members: DataFrame, rooted: DataFrame, sets: DataFrame, percent: int, block_rows: int) -> DataFrame:
    """a, b: confirmed links between nodes of different components (``rooted``: node, root, signature, n_shingles).

    Under each key the component with most members is the main one; its blocks meet the blocks of the others, and those
    each other. So members that are connected already cost no comparison among themselves. Small blocks are dealt by
    hash into bins, as many as keep the sets of a bin's rows at ``BIN_SHINGLES``."""
    held = members.select("key", "node").join(rooted.select("node", "root", "n_shingles"), "node")
    sizes = held.groupBy("key", "root").agg(F.count(F.lit(1)).alias("n"))
    mixed = (sizes.groupBy("key").agg(F.max(F.struct("n", "root")).alias("m"), F.sum("n").alias("all"))
             .where("m.n < all").select("key", F.col("m.root").alias("main_root"),
                                        F.ceil(F.col("m.n") / F.lit(block_rows)).cast("int").alias("mains"),
                                        F.ceil((F.col("all") - F.col("m.n")) / F.lit(block_rows)).cast("int").alias("others")))
    rows = held.join(mixed, "key")
    is_main = F.col("root") == F.col("main_root")
    # blocks of the main component are numbered -1, -2, ..., the others 0, 1, ...
    side = F.when(is_main, -1 - F.pmod(F.xxhash64("node"), "mains")).otherwise(F.pmod(F.xxhash64("node"), "others")).cast("int")
    rows = rows.withColumn("side", side)
    others = F.sequence(F.lit(0), F.col("others") - 1)
    with_others = F.transform(others, lambda o: F.struct(F.least(F.col("side"), o).alias("main"), F.greatest(F.col("side"), o).alias("other")))
    with_mains = F.transform(F.sequence(F.lit(1), F.col("mains")), lambda m: F.struct((-m).alias("main"), F.col("side").alias("other")))
    rows = table(rows.withColumn("t", F.explode(F.when(is_main, with_others).otherwise(F.concat(with_others, with_mains))))
                 .select("key", "t.main", "t.other", "side", "node", "root", "n_shingles"), "minhash-blocks")
    total = rows.agg(F.sum("n_shingles").alias("shingles")).first()["shingles"] or 0
    at = F.pmod(F.xxhash64("key", "main", "other"), F.lit(total // BIN_SHINGLES + 1))
    binned = rows.withColumn("bin", at).join(rooted.select("node", "signature"), "node")
    todo = table(binned.groupBy("bin").applyInArrow(_compared(percent), "bin bigint, x array<bigint>, y array<bigint>"), "minhash-pairs")
    needed = todo.select(F.col("bin").alias("_bin"), F.explode(F.array_union("x", "y")).alias("node")).join(sets, "node")
    return todo.groupBy("bin").cogroup(needed.groupBy("_bin")).applyInArrow(_linked(percent), "a bigint, b bigint")


def _grouped(docs: DataFrame, shingle_words: int, percent: int, block_rows: int) -> DataFrame:
    """doc_id, n_shingles, key, root (NULL without words), component_id of every row."""
    small_batches(docs)
    rows = table(docs.select("doc_id", _signer(shingle_words)(F.col("text").cast("string")).alias("s")).select("doc_id", "s.*"), "minhash-rows")
    nodes = (rows.where("key IS NOT NULL").groupBy("key")
             .agg(F.min("doc_id").alias("least"), F.first("n_shingles").alias("n_shingles"), F.first("signature").alias("signature")))
    nodes = table(nodes.withColumn("node", F.monotonically_increasing_id()), "minhash-nodes")
    members = _members(nodes)
    sets = _sets(docs, nodes, members.select("node").distinct(), shingle_words)
    roots = cut(components(_star_links(members, nodes, sets, percent)))
    rooted = table(nodes.join(roots.withColumnRenamed("node", "_node"), nodes["node"] == F.col("_node"), "left")
                   .select("node", "least", "key", "n_shingles", "signature", F.coalesce("root", nodes["node"]).alias("root")), "minhash-rooted")
    cross = table(_cross_links(members, rooted, sets, percent, block_rows), "minhash-cross")
    own = rooted.select("node", "root")
    between = (cross.join(own.withColumnsRenamed({"node": "a", "root": "ra"}), "a").join(own.withColumnsRenamed({"node": "b", "root": "rb"}), "b")
               .select(F.col("ra").alias("a"), F.col("rb").alias("b")))
    merged = components(between).select(F.col("root").alias("top"), F.col("node").alias("root"))
    rooted = table(rooted.join(merged, "root", "left").select("key", "least", F.coalesce("top", "root").alias("root")), "minhash-final")
    smallest = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    found = rooted.join(smallest, "root").select(F.col("key").alias("_key"), "root", "component_id")
    return (rows.join(found, rows["key"] == F.col("_key"), "left")
            .select("doc_id", "n_shingles", "key", "root", F.when(F.col("key").isNull(), F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id")))


def near_groups(docs: DataFrame, shingle_words: int = SHINGLE_WORDS, percent: int = PERCENT, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """doc_id, n_shingles, component_id, kept: one row per row of ``docs``.

    Documents whose shingle sets have 100 * intersection >= percent * union are linked; component_id is the smallest
    doc_id that links reach, kept tells whether it is the row's own. NULL and wordless texts have no shingles, are linked
    with nothing and keep their own doc_id; fewer words than a shingle are one shingle. Repeated rows repeat; a NULL
    doc_id is never the smallest and never kept, a component of NULL doc_ids alone has a NULL component_id; an empty
    table gives no rows; other columns are not read. ``percent`` below 85 needs a larger DISTANCE.
    """
    return _grouped(docs, shingle_words, percent, block_rows).select(
        "doc_id", "n_shingles", "component_id", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(False)).alias("kept"))


def keep_one(docs: DataFrame, shingle_words: int = SHINGLE_WORDS, percent: int = PERCENT) -> DataFrame:
    """``docs`` with one row of each component, that of the smallest doc_id (of repeated ones the first by text), and all
    rows without words or without doc_id; same columns."""
    nth = free_name(docs, "_nth")
    kept = near_groups(docs, shingle_words, percent).where("kept").select("doc_id").distinct()
    rows = docs.join(kept, "doc_id", "left_semi").unionByName(docs.where("doc_id IS NULL"))
    order = Window.partitionBy("doc_id").orderBy(F.coalesce("text", F.lit("")))
    return rows.withColumn(nth, F.row_number().over(order)).where((F.col(nth) == 1) | F.col("doc_id").isNull()).select(*docs.columns)
