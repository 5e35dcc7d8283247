import math
import random
from collections import Counter, defaultdict

from helpers import odd_rows, prose, table

from sideline.llm import mixing as M


def brute_targets(sizes):
    """The rule as it is told: share by weight, cut at three times the size, reshare the excess."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: k % 3 + 1 for k, s in enumerate(order)}
    target, capped, rest = {}, set(), float(sum(sizes.values()))
    while True:
        free = [s for s in order if s not in capped]
        w = sum(weight[s] for s in free)
        over = [s for s in free if w and rest * weight[s] / w > 3 * sizes[s]]
        for s in free:
            target[s] = rest * weight[s] / w
        if not over:
            return target
        for s in over:
            target[s] = 3.0 * sizes[s]
            capped.add(s)
            rest -= target[s]


def rows_of(rng):
    rows = odd_rows()
    for k in range(300):
        rows.append((100 + k, prose(rng, rng.choice([0, 1, 5, 20, 200])), rng.choice(["a", "a", "a", "b", "c", None, "d"])))
    return rows + [(1000, prose(rng, 2), "zz")]


def test_targets_and_copies(spark):
    rows = rows_of(random.Random(1))
    got = M.mix(table(spark, rows)).collect()
    assert len(got) == len(rows)
    source = defaultdict(list)
    for i, t, s in rows:
        source[s].append((i, len((t or "").split())))
    want = brute_targets({s: sum(n for _, n in v) for s, v in source.items()})
    assert Counter((r.doc_id, r.size) for r in got) == Counter(x for v in source.values() for x in v)
    by_target = defaultdict(list)
    for r in got:
        by_target[r.source_size, round(r.target, 6)].append(r)
        assert r.taken % max(r["size"], 1) == 0 and r.taken <= 3 * r["size"]
    for s, v in source.items():
        size = sum(n for _, n in v)
        mine = by_target[size, round(want[s], 6)]
        assert mine, s
        assert abs(sum(r.taken for r in mine) - want[s]) <= 2 * max(n for _, n in v) + 1
    assert any(math.isclose(want[s], 3 * sum(n for _, n in v)) for s, v in source.items() if v)


def test_copies_equal_a_plain_prefix_sum(spark):
    rng = random.Random(2)
    rows = [(k, prose(rng, rng.randint(1, 30)), rng.choice("aaab")) for k in range(400)]
    docs = table(spark, rows)
    s = M.sized(docs)
    goals = {r.source: r for r in M.targets(s).collect()}
    offsets = {r.source: r.o for r in docs.select("source", M.offset(docs["source"]).alias("o")).distinct().collect()}
    got = {r.doc_id: r.copies for r in M.copies(s, M.targets(s)).collect()}
    at = dict(offsets)
    for i, t, src in sorted(rows, key=lambda r: (r[2], len(r[1].split()), r[0])):
        part = math.floor(min(goals[src].target / goals[src].source_size, 3) * 2**32 + 0.5)
        assert got[i] == (at[src] + part) // 2**32 - at[src] // 2**32
        at[src] += part


def test_reruns_agree_and_sample_emits_the_copies(spark):
    rows = rows_of(random.Random(3))
    docs = table(spark, rows)
    a = Counter(tuple(r) for r in M.mix(docs).collect())
    assert a == Counter(tuple(r) for r in M.mix(docs.repartition(7)).collect())
    out = M.sample(docs)
    assert out.columns == docs.columns
    words = sum(len((r.text or "").split()) for r in out.collect())
    assert words == sum(r[4] * n for r, n in a.items())


def test_empty_tables(spark):
    docs = table(spark, [])
    assert M.mix(docs).count() == 0 and M.sample(docs).count() == 0
    silent = table(spark, [(1, None, "a"), (2, "", None)])
    assert [r.taken for r in M.mix(silent).collect()] == [0, 0]
