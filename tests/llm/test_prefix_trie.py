import hashlib
import random
import zlib

import numpy as np
import pytest

from sideline.llm import prefix_trie as T


def brute(rows, rebuild=True):
    """The contract word by word: rows (conv_id, turn, role, text)."""
    own = {}
    for c, turn, role, text in rows:
        if c is not None:
            own.setdefault(c, []).append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [(r, t) for _, _, r, t in sorted(v)] for c, v in own.items()}
    seqs = own
    if rebuild:
        seqs = {}
        for c, v in own.items():
            h = zlib.crc32(str(c).encode()) % 9
            seqs[c] = own.get(c - c % 5, [])[:h] + v[h:]
    members, ends = {}, {}
    for c, v in seqs.items():
        for d in range(len(v) + 1):
            members.setdefault(tuple(v[:d]), []).append(c)
        ends.setdefault(tuple(v), []).append(c)
    children = {}
    for n in members:
        if n:
            children.setdefault(n[:-1], []).append(n)
    leaves, saved = {}, {}
    for n in sorted(members, key=len, reverse=True):
        own_saving = (len(members[n]) - 1) * len(n[-1][1].encode()) if n else 0
        leaves[n] = sum(leaves[c] for c in children.get(n, [])) or 1
        saved[n] = own_saving + sum(saved[c] for c in children.get(n, []))
    return sorted(((min(m), len(n), min(members[n[:-1]]) if n else None, len(m), len(children.get(n, [])), leaves[n], saved[n],
                    hashlib.sha256(",".join(map(str, sorted(ends.get(n, [])))).encode()).hexdigest()) for n, m in members.items()), key=str)


def run(spark, rows, rebuild=True, shards=8):
    spark.conf.set("spark.sql.shuffle.partitions", str(shards))
    try:
        df = spark.createDataFrame([(*r, "x", "y") for r in rows], "conv_id bigint, turn bigint, role string, text string, path string, shard string")
        got = (T.rebuilt_trie if rebuild else T.conversation_trie)(df)
        assert got.columns == T.COLUMNS and {t for _, t in got.dtypes} == {"bigint", "string"}
        return sorted((tuple(r) for r in got.collect()), key=str)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")


def talk(rng, n, turns):
    """Conversations that share beginnings, some equal, one over a third of all."""
    texts = ["", "hello", "é漢😀", "no", "yes " * 30]
    hot = [("user", "hello"), ("bot", "yes "), ("user", "no")]
    out = []
    for c in rng.sample(range(10 * n), n):
        seq = hot if rng.random() < 0.4 else [(rng.choice(["user", "bot"]), rng.choice(texts)) for _ in range(rng.randint(1, turns))]
        out += [(c, i, r, t) for i, (r, t) in enumerate(seq)]
    rng.shuffle(out)
    return out


@pytest.mark.parametrize("shards", [1, 3, 16])
@pytest.mark.parametrize("rebuild", [True, False])
def test_equals_brute_force(spark, shards, rebuild):
    rng = random.Random(shards)
    rows = talk(rng, 120, 5)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # really so many shards
    try:
        assert run(spark, rows, rebuild, shards) == brute(rows, rebuild)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def test_odd_rows(spark):
    rows = [(1, None, None, None), (1, 0, "user", "a"), (1, 0, "user", "a"), (2, 5, "bot", ""), (2, 5, "bot", None), (None, 1, "user", "lost"),
            (5, 1, "user", "long " * 50_000), (6, 1, "user", "x"), (7, -1, "a", "b"), (8, None, "z", "b"), (8, None, "a", "c"), (10, 0, "u", "v"), (14, 0, "u", "v")]
    for rebuild in (True, False):
        assert run(spark, rows, rebuild) == brute(rows, rebuild)
    turnless = [r for r in brute(rows) if r[1] == 0][0]
    assert turnless[3] == 8 and turnless[7] != T.ROOT  # some rebuilt conversations have no turns


def test_empty_table(spark):
    assert run(spark, []) == []
    assert run(spark, [(None, 1, "a", "b")]) == []


def test_one_long_conversation(spark):
    rows = [(c, i, "u", str(i)) for c in (5, 10) for i in range(3000)]
    assert run(spark, rows, False, 4) == brute(rows, False)


@pytest.mark.parametrize("shards", [1, 2, 5, 40])
def test_shares_of_any_cut_add_up(shards):
    rng = random.Random(shards)
    names = {(r, t): hashlib.sha256(f"{len(r.encode())}:{r}{t}".encode()).digest() for r in ("user", "bot") for t in ("", "hello", "é漢😀", "no", "yes ", "yes " * 30)}
    rows = talk(rng, 60, 4)
    seqs = {}
    for c, i, r, t in sorted(rows):
        seqs.setdefault(c, []).append((r, t))
    flat = sorted((b"".join(names[x] for x in v), c, [len(t.encode()) for _, t in v]) for c, v in seqs.items())
    cuts = sorted(rng.sample(range(1, len(flat)), shards - 1))
    parts = [flat[a:b] for a, b in zip([0, *cuts], [*cuts, len(flat)])]
    total = {}
    for i, p in enumerate(parts):
        made = T._shard_nodes(i, p, parts[i - 1][-1][0] if i else None, parts[i + 1][0][0] if i + 1 < len(parts) else None).to_pylist()
        for n, r in enumerate(made):
            total.setdefault(r["name"] or (i, n), []).append(r)
    got = sorted((min(r["conv_id"] for r in v), v[0]["depth"], *[sum(r[c] for r in v) for c in ("n_convs", "n_children", "n_leaves", "saved_tokens")])
                 for v in total.values())
    assert got == sorted((a, d, n, k, e, s) for a, d, _, n, k, e, s, _ in brute(rows, False))


def test_findclose():
    rng = np.random.default_rng(3)
    for n in (1, 2, 40, 700):
        bits = [1]
        opened, left = 1, n - 1
        while left or opened:
            if left and (opened == 0 or rng.random() < 0.5):
                bits.append(1)
                opened, left = opened + 1, left - 1
            else:
                bits.append(0)
                opened -= 1
        bits = np.array(bits, "int8")
        stack, want = [], {}
        for i, b in enumerate(bits):
            if b:
                stack.append(i)
            else:
                want[stack.pop()] = i
        opens = np.flatnonzero(bits)
        assert T.Parentheses(bits).findclose(opens).tolist() == [want[int(i)] for i in opens]
