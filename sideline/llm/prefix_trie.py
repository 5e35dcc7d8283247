"""Conversation prefix trie: balanced parentheses per shard, shared spines merged.

A conversation is its sequence of turns; each turn is named by the SHA-256 of its role and text, so a sequence is a
binary ``path`` of 32 bytes a turn, and paths sort as sequences do. Conversations are range-partitioned by
(path, conv_id); equal conversations may fall into several shards, so that no group lands in one task.

A shard's sorted paths spell its part of the trie as balanced parentheses: the turns that a path adds to the common
prefix with its predecessor open nodes, the turns that it leaves close them. Over blocks of the excess (opened minus
closed) lies a tree of least and greatest values; ``findclose`` skips blocks by it and so delimits each node's subtree.
Rank counts of ``()`` pairs give leaves; cumulative arrays in the order of opening give members and savings; the members
of a node are consecutive rows, over which a sparse table gives the least conv_id.

Only nodes on the prefix that a shard's first path shares with the last path of the shard before, or its last path with
the first of the shard after (the spines), are known in part. Each count is made so that shares add up: a node's text is
set off once, by the shard that meets the node first, which also counts it as a child; a leaf is counted by the last
shard that holds it, as only that one can know that no longer path follows. So merging spines is one sum by node name.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import cut, table

NAME = 32  # bytes of a turn's name
BLOCK = 64  # parentheses of a block
FAMILY = 5
HEADS = 9
ROOT = hashlib.sha256().hexdigest()
NODE = ("shard int, shared boolean, name string, parent_name string, conv_id bigint, depth bigint, parent_conv_id bigint, n_convs bigint, "
        "n_children bigint, n_leaves bigint, saved_tokens bigint, ends_sha256 string, ends string")
COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


class Parentheses:
    """Balanced parentheses (1 opens, 0 closes) with a tree of the least and greatest excess of their blocks."""

    def __init__(self, bits: np.ndarray):
        self.bits = bits
        self.excess = np.cumsum(2 * bits.astype("int64") - 1)
        blocks = -(-len(bits) // BLOCK)
        self.leaves = 1 << max(blocks - 1, 0).bit_length()
        padded = np.concatenate([self.excess, np.repeat(self.excess[-1:], blocks * BLOCK - len(bits))]).reshape(blocks, BLOCK)
        self.low = np.full(2 * self.leaves, np.iinfo("int64").max)
        self.high = np.full(2 * self.leaves, np.iinfo("int64").min)
        self.low[self.leaves:self.leaves + blocks], self.high[self.leaves:self.leaves + blocks] = padded.min(axis=1), padded.max(axis=1)
        level = self.leaves
        while level > 1:
            half = np.arange(level // 2, level)
            self.low[half] = np.minimum(self.low[2 * half], self.low[2 * half + 1])
            self.high[half] = np.maximum(self.high[2 * half], self.high[2 * half + 1])
            level //= 2

    def _scan(self, at: np.ndarray, target: np.ndarray) -> np.ndarray:
        """First place from ``at`` on, inside its block, with the target as its excess; -1 where there is none."""
        out, left = np.full(len(at), -1), np.arange(len(at))
        at = at.copy()
        while len(left):
            hit = self.excess[at[left]] == target[left]
            out[left[hit]] = at[left[hit]]
            left = left[~hit]
            at[left] += 1
            left = left[(at[left] % BLOCK != 0) & (at[left] < len(self.excess))]
        return out

    def findclose(self, opens: np.ndarray) -> np.ndarray:
        """Where the parentheses that open at ``opens`` close."""
        target = self.excess[opens] - 1
        out = self._scan(opens, target)
        far = np.flatnonzero(out < 0)
        node, goal = self.leaves + opens[far] // BLOCK, target[far]

        def holds(which: np.ndarray, at: np.ndarray) -> np.ndarray:
            return (self.low[at] <= goal[which]) & (goal[which] <= self.high[at])

        climbing = np.arange(len(far))
        while len(climbing):  # up to the first subtree on the right that holds the target
            at = node[climbing]
            right = at % 2 == 0
            found = right & holds(climbing, np.minimum(at + 1, 2 * self.leaves - 1))
            node[climbing] = np.where(found, at + 1, at // 2)
            climbing = climbing[~found]
        falling = np.flatnonzero(node < self.leaves)
        while len(falling):
            left = 2 * node[falling]
            node[falling] = np.where(holds(falling, left), left, left + 1)
            falling = falling[node[falling] < self.leaves]
        out[far] = self._scan((node - self.leaves) * BLOCK, goal)
        return out


def _common(a: bytes, b: bytes) -> int:
    """Turns that two paths have in common from the start."""
    n = min(len(a), len(b)) // NAME
    if a[:n * NAME] == b[:n * NAME]:
        return n
    return next(i for i in range(n) if a[i * NAME:i * NAME + NAME] != b[i * NAME:i * NAME + NAME])


def _least(values: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Smallest of values[begin:end] for each non-empty range, by a sparse table."""
    out = np.empty(len(begin), values.dtype)
    width = np.frexp((end - begin).astype("float64"))[1] - 1
    level = values
    for w in range(int(width.max(initial=0)) + 1):
        own = width == w
        out[own] = np.minimum(level[begin[own]], level[end[own] - (1 << w)])
        level = np.minimum(level[:-(1 << w)], level[1 << w:]) if len(level) > 1 << w else level
    return out


def _prefix_names(path: bytes, depth: int) -> list[str]:
    """Names of the nodes at depths 0 to ``depth`` on a path."""
    state, out = hashlib.sha256(), [ROOT]
    for i in range(depth):
        state.update(path[i * NAME:(i + 1) * NAME])
        out.append(state.copy().hexdigest())
    return out


def _shard_nodes(shard: int, rows: list[tuple[bytes, int, list[int]]], before: bytes | None, after: bytes | None) -> pa.Table:
    """The nodes of one shard. ``rows``: path, conv_id and bytes of each turn, sorted; ``before`` and ``after``: the
    last path of the shard before and the first of the one after, None where there is none."""
    paths = [p for p, _, _ in rows]
    convs = np.array([c for _, c, _ in rows], "int64")
    depths = np.array([len(p) // NAME for p in paths])
    common = np.array([0] + [_common(a, b) for a, b in zip(paths, paths[1:])])
    new = depths - common
    bits = np.repeat(np.r_[1, np.tile([0, 1], len(rows)), 0],
                     np.r_[1, np.stack([np.r_[0, depths[:-1] - common[1:]], new], axis=1).ravel(), depths[-1] + 1]).astype("int8")
    trie = Parentheses(bits)
    opens = np.flatnonzero(bits)
    closes = trie.findclose(opens)
    nodes = len(opens)
    first, last = np.arange(nodes), np.cumsum(bits)[closes]  # a subtree is the nodes first to last - 1
    own_row = np.repeat(np.arange(len(rows)), new)
    depth = np.r_[0, np.arange(1, nodes) - np.repeat(np.cumsum(new) - new, new) + np.repeat(common, new)]
    sizes = np.concatenate([np.asarray(s, "int64") for _, _, s in rows]) if depths.any() else np.zeros(0, "int64")
    size = np.r_[0, sizes[(np.cumsum(depths) - depths)[own_row] + depth[1:] - 1]]

    # the spines: indices of nodes by depth on the first and the last path
    shared_before = -1 if before is None else _common(before, paths[0])
    shared_after = -1 if after is None else _common(paths[-1], after)
    at_depth = np.zeros(int(depth.max()) + 1, "int64")
    at_depth[depth] = first  # the last node of each depth
    parent, path_now = np.full(nodes, -1), np.zeros(int(depth.max()) + 2, "int64")
    begins = np.cumsum(new) - new + 1
    for begin, n, c in zip(begins.tolist(), new.tolist(), common.tolist()):
        if n:
            parent[begin] = path_now[c]
            parent[begin + 1:begin + n] = np.arange(begin, begin + n - 1)
            path_now[c + 1:c + n + 1] = np.arange(begin, begin + n)
    names: dict[int, str] = dict(enumerate(_prefix_names(paths[0], shared_before))) if before is not None else {}
    if after is not None:
        names |= {int(at_depth[d]): x for d, x in enumerate(_prefix_names(paths[-1], shared_after))}
    owned = first > shared_before

    ending = np.cumsum(new)  # the node at which each row ends
    row = np.r_[0, np.cumsum(np.bincount(ending, minlength=nodes))]
    n_convs = row[last] - row[first]
    pair = np.r_[(bits[:-1] == 1) & (bits[1:] == 0), False]
    if depths[-1] <= shared_after:
        pair[opens[ending[-1]]] = False  # a later shard holds this node too
    leaves = np.r_[0, np.cumsum(pair)]
    saving = np.r_[0, np.cumsum(n_convs * size - owned * size)]
    children = np.bincount(parent[1:][owned[1:]], minlength=nodes) if nodes > 1 else np.zeros(nodes, "int64")
    conv_id = _least(convs, row[first], row[last])

    ends = [",".join(map(str, convs[a:b])) for a, b in zip(row[:-1].tolist(), row[1:].tolist())]
    shared = [i in names for i in range(nodes)]
    up = parent.tolist()
    return pa.table({
        "shard": pa.array([shard] * nodes, pa.int32()), "shared": pa.array(shared), "name": pa.array([names.get(i) for i in range(nodes)], pa.string()),
        "parent_name": pa.array([names.get(p) for p in up], pa.string()), "conv_id": pa.array(conv_id), "depth": pa.array(depth, pa.int64()),
        "parent_conv_id": pa.array([None if p < 0 or p in names else int(conv_id[p]) for p in up], pa.int64()),
        "n_convs": pa.array(n_convs, pa.int64()), "n_children": pa.array(children, pa.int64()),
        "n_leaves": pa.array(leaves[closes] - leaves[opens], pa.int64()), "saved_tokens": pa.array(saving[last] - saving[first], pa.int64()),
        "ends_sha256": pa.array([None if s else hashlib.sha256(e.encode()).hexdigest() for e, s in zip(ends, shared)], pa.string()),
        "ends": pa.array([e if s else None for e, s in zip(ends, shared)], pa.string())})


def _of_shard(rows: pa.Table, info: pa.Table) -> pa.Table:
    own = sorted(zip(rows["path"].to_pylist(), rows["conv_id"].to_pylist(), rows["sizes"].to_pylist()))
    one = info.to_pylist()[0]
    return _shard_nodes(one["shard"], own, one["before"], one["after"])


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 of the ``ends`` of each run of one name, comma-joined as they come; holds one batch at a time."""
    name, state = None, None

    def one() -> pa.RecordBatch:
        return pa.record_batch({"name": pa.array([name], pa.string()), "digest": pa.array([state.hexdigest()], pa.string())})

    for batch in batches:
        for n, e in zip(batch["name"].to_pylist(), batch["ends"]):
            if n != name:
                if state is not None:
                    yield one()
                name, state = n, hashlib.sha256()
            else:
                state.update(b",")
            state.update(e.as_py().encode())
    if state is not None:
        yield one()


def sequences(conversations: DataFrame) -> DataFrame:
    """conv_id, turns (array of name, hex, and size, the UTF-8 bytes of the text) in the order of turn, NULL first, equal
    turns by role and name. NULL role or text is empty; repeated rows are turns each; rows without a conv_id are of no
    conversation and left out; other columns are not read."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    named = conversations.where("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("bigint").alias("conv_id"), "turn", role.alias("role"),
        F.sha2(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text).cast("binary"), 256).alias("name"),
        F.octet_length(text).cast("bigint").alias("size"))
    ordered = F.sort_array(F.collect_list(F.struct("turn", "role", "name", "size")))
    return (named.groupBy("conv_id").agg(ordered.alias("t"))
            .select("conv_id", F.transform("t", lambda x: F.struct(x["name"].alias("name"), x["size"].alias("size"))).alias("turns")))


def rebuilt(own: DataFrame, family: int = FAMILY, heads: int = HEADS) -> DataFrame:
    """``own`` (the result of ``sequences``) with each conversation's first h turns taken from the first conversation of
    its family (conv_id less its remainder by ``family``): all if that has fewer, none if there is none. h is the CRC-32
    of the decimal conv_id modulo ``heads``; the turns after the first h stay."""
    head = own.where(F.col("conv_id") % family == 0).select(F.col("conv_id").alias("_lead"), F.slice("turns", 1, heads - 1).alias("_head"))
    h = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % heads).cast("int")
    rows = own.withColumn("_h", h).join(head, F.col("conv_id") - F.col("conv_id") % family == F.col("_lead"), "left")
    none = F.slice("turns", 1, 0)
    return rows.select("conv_id", F.concat(F.slice(F.coalesce("_head", none), F.lit(1), F.col("_h")),
                                           F.slice("turns", F.col("_h") + 1, F.size("turns"))).alias("turns"))


def nodes(seqs: DataFrame) -> DataFrame:
    """One row per node of the prefix trie of ``seqs`` (conv_id, turns): the columns of ``COLUMNS``.

    conv_id is the node's smallest member, parent_conv_id its parent's (NULL at the root); saved_tokens sums
    (n_convs - 1) * bytes of the last text over the subtree; ends_sha256 is the digest of the decimal conv_ids that end
    at the node, ascending, comma-joined. Conversations without turns are members of the root alone; no conversations,
    no nodes. SHA-256 names stand for turns and sequences.
    """
    names = F.array_join(F.transform("turns", lambda x: x["name"]), "")
    rows = seqs.select("conv_id", F.unhex(names).alias("path"), F.transform("turns", lambda x: x["size"]).alias("sizes"))
    rows = cut(rows.repartitionByRange("path", "conv_id").withColumn("shard", F.spark_partition_id()))
    edges = rows.groupBy("shard").agg(F.min("path").alias("low"), F.max("path").alias("high"))
    by_shard = Window.orderBy("shard")  # one row per shard
    edges = edges.select("shard", F.lag("high").over(by_shard).alias("before"), F.lead("low").over(by_shard).alias("after"))
    made = table(rows.groupBy("shard").cogroup(edges.groupBy("shard")).applyInArrow(_of_shard, NODE), "trie-nodes")
    spines = made.where("shared")
    merged = table(spines.groupBy("name").agg(
        F.min("parent_name").alias("parent_name"), F.min("depth").alias("depth"), F.min("conv_id").alias("conv_id"),
        *[F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "saved_tokens")]), "trie-spines")
    digests = (spines.where("ends != ''").select("name", "shard", "ends").repartition("name")
               .sortWithinPartitions("name", "shard").mapInArrow(_digests, "name string, digest string"))
    leads = merged.select(F.col("name").alias("_parent"), F.col("conv_id").alias("lead"))
    top = (merged.join(digests, "name", "left").join(leads, F.col("parent_name") == F.col("_parent"), "left")
           .withColumn("ends_sha256", F.coalesce("digest", F.lit(ROOT))).withColumn("parent_conv_id", F.col("lead")).select(*COLUMNS))
    # a parent on a spine is looked up by shard as well, so that the many children of one node stay spread
    local = (spines.select(F.col("shard").alias("_shard"), F.col("name").alias("_parent"))
             .join(merged.select(F.col("name").alias("_parent"), F.col("conv_id").alias("lead")), "_parent"))
    below = (made.where("not shared").join(local, (F.col("shard") == F.col("_shard")) & (F.col("parent_name") == F.col("_parent")), "left")
             .withColumn("parent_conv_id", F.coalesce("lead", "parent_conv_id")).select(*COLUMNS))
    return top.unionByName(below)


def conversation_trie(conversations: DataFrame) -> DataFrame:
    """The trie of the conversations as they are."""
    return nodes(sequences(conversations))


def rebuilt_trie(conversations: DataFrame, family: int = FAMILY, heads: int = HEADS) -> DataFrame:
    """The trie of the conversations rebuilt with the heads of their families."""
    return nodes(rebuilt(sequences(conversations), family, heads))
