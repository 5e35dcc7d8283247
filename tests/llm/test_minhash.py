import random
import re

import numpy as np
import pytest
from helpers import odd_rows, prose, table

from sideline.llm import minhash as M

FOLD = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def slow_set(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(FOLD))
    return {tuple(words[i:i + 3]) for i in range(max(len(words) - 2, 1))} if words else set()


def brute(rows):
    """doc_id, n_shingles, component_id, kept of every row, all pairs compared."""
    sets = [slow_set(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if sets[i] and 100 * both >= 85 * (len(sets[i]) + len(sets[j]) - both):
                root[find(i)] = find(j)
    least = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            least[find(i)] = min(least.get(find(i), d), d)
    out = []
    for i, (d, _) in enumerate(rows):
        c = least.get(find(i)) if sets[i] else d
        out.append((d, len(sets[i]), c, d is not None and d == c))
    return sorted(out, key=str)


def edited(rng, text, n):
    words = text.split()
    for _ in range(n):
        words[rng.randrange(len(words))] = prose(rng, 1)
    return " ".join(words)


def run(spark, rows, **how):
    got = M.near_groups(table(spark, [(i, t, "s") for i, t in rows]).repartition(3), **how)
    assert got.dtypes == [("doc_id", "bigint"), ("n_shingles", "bigint"), ("component_id", "bigint"), ("kept", "boolean")]
    return sorted((tuple(r) for r in got.collect()), key=str)


@pytest.mark.parametrize("block", [512, 7])
def test_equals_comparing_all_pairs(spark, block):
    rng = random.Random(block)
    texts = [prose(rng, rng.choice([1, 2, 3, 5, 30, 80, 200])) for _ in range(40)]
    base = prose(rng, 120)
    texts += [edited(rng, base, rng.randint(0, 9)) for _ in range(60)]  # around the threshold, linked or not
    chain = prose(rng, 150)
    for _ in range(25):  # each links to the last, far ones only by the chain
        chain = edited(rng, chain, 3)
        texts.append(chain)
    texts += [prose(rng, 100) + " " + base for _ in range(15)]  # a shared passage is no link
    texts += [base.upper(), base.replace(" ", "\n\x0b"), base] * 5
    rng.shuffle(texts)
    rows = list(enumerate(texts, 100))
    want = brute(rows)
    assert len({r[2] for r in want}) < len(rows) - 40
    assert run(spark, rows, block_rows=block) == want


def test_links_beyond_the_hubs(spark):
    # two families meet through one pair alone: neither is the hub of any key that both are in
    rng = random.Random(9)
    for seed in range(3):
        words = prose(rng, 300).split()
        a = [" ".join(words[:i] + [prose(rng, 1)] + words[i + 1:]) for i in range(0, 300, 60)]
        bridge = words[:270] + prose(rng, 8).split()
        b = [" ".join(bridge[:i] + [prose(rng, 1)] + bridge[i + 1:]) for i in range(0, 270, 60)]
        rows = list(enumerate(a + b + [" ".join(bridge)]))
        assert run(spark, rows, block_rows=3) == brute(rows)


def test_odd_rows(spark):
    rows = [(i, t) for i, t, _ in odd_rows()] + [(20, "a b"), (21, "A  b"), (22, "a b c"), (23, "a b c a b c"), (None, None)]
    assert run(spark, rows) == brute(rows)
    assert run(spark, []) == []
    assert run(spark, [(1, None), (2, " ")]) == [(1, 0, 1, True), (2, 0, 2, True)]


def test_keep_one(spark):
    rows = [(i, t, "s") for i, t, _ in odd_rows()]
    df = table(spark, rows)
    kept = M.keep_one(df)
    assert kept.columns == df.columns
    want = [(d, t) for (d, t) in [(1, None), (2, ""), (3, "Same Text"), (7, " "), (8, "x" * 9000), (9, "x" * 8999 + "y"), (10, "één ß 漢字 😀"),
                                  (None, "same text"), (None, None)]]
    assert sorted(((r.doc_id, r.text) for r in kept.collect()), key=str) == sorted(want, key=str)


def test_signatures_within_the_distance_share_a_key():
    rng = np.random.default_rng(4)
    signed = rng.integers(0, 256, (200, M.CHUNKS * M.WIDTH), dtype="uint8")
    other = signed.copy()
    for row in other:  # exactly DISTANCE components differ
        at = rng.choice(len(row), M.DISTANCE, replace=False)
        row[at] ^= rng.integers(1, 256, M.DISTANCE, dtype="uint8")
    assert ((signed != other).sum(axis=1) == M.DISTANCE).all()
    assert (M._keys(signed) == M._keys(other)).any(axis=1).all()
    # keys tell chunks and left-out components apart
    assert len(np.unique(M._keys(signed))) == signed.size


def test_signatures_estimate_similarity():
    rng = random.Random(2)
    for share in (0.5, 0.85, 0.95):
        n = 4000
        common = np.array([rng.getrandbits(64) for _ in range(int(n * share))], "uint64")
        rest = [np.array([rng.getrandbits(64) for _ in range((n - len(common)) // 2)], "uint64") for _ in range(2)]
        a, b = (np.frombuffer(M.signature(np.concatenate([common, r])), "uint8") for r in rest)
        assert abs((a == b).mean() - share) < 0.15


def test_sets():
    rng = random.Random(5)
    for t in [t or "" for _, t, _ in odd_rows()] + [prose(rng, n) for n in (1, 2, 3, 4, 500)]:
        assert len(M.shingle_set(t.encode())) == len(slow_set(t))
