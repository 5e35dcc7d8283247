import random

import pytest
import xxhash
from helpers import odd_rows, prose, table
from pyspark.sql import functions as F

from sideline.llm import ctph as C


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        before, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            before, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, before + (x != y))
    return row[-1]


def slow_likeness(a, b):
    (x, x1, x2), (y, y1, y2) = a.split(":"), b.split(":")
    alike = lambda s, t: 1.0 if not s and not t else 1 - distance(s, t) / max(len(s), len(t))
    if x == y:
        return max(alike(x1, y1), alike(x2, y2))
    if int(x) == 2 * int(y):
        return alike(x1, y2)
    return alike(x2, y1) if 2 * int(x) == int(y) else 0.0


def test_edits_change_few_chunks():
    rng = random.Random(1)
    words = prose(rng, 600).split()
    near = words[:300] + ["inserted"] + words[300:]
    assert slow_likeness(C.fingerprint(" ".join(words)), C.fingerprint(" ".join(near))) > 0.9
    assert slow_likeness(C.fingerprint(" ".join(words)), C.fingerprint(prose(rng, 600))) < 0.4
    assert C.fingerprint("") == "3::"
    assert len(C.fingerprint("ab" * 5000).split(":")[1]) >= 10


@pytest.mark.parametrize("range_docs", [2000, 7, 1])
def test_neighbours_and_edits_equal_brute_force(spark, range_docs):
    rng = random.Random(2)
    rows = [(i, t, s) for i, t, s in odd_rows() if i is not None and i != 4]
    rows += [(rng.randint(0, 10**6) * 3 + 50, prose(rng, rng.randint(0, 90)), "a") for _ in range(60)]
    rows = sorted({r[0]: r for r in rows}.values())
    rows.append((None, "the last one, as its doc_id is null", "a"))
    docs = table(spark, rows).repartition(3)
    pairs = C.neighbours(docs, {"text": F.coalesce("text", F.lit(""))}, range_docs).collect()
    want = [(i, t or "", rows[(k + 1) % len(rows)][1] or "") for k, (i, t, _) in enumerate(rows)]
    assert sorted([(r.doc_id, r.text, r.next_text) for r in pairs], key=str) == sorted(want, key=str)
    edits = {i: t[:len(t) - len(t) // 4] + n[:len(t) // 4] for i, t, n in want}
    prints = {i: C.fingerprint(n) for i, _, n in want}
    got = C.against_edits(docs).collect()
    assert len(got) == len(rows)
    for r in got:
        assert r.edited == edits[r.doc_id]
        assert r.edited_fingerprint == C.fingerprint(r.edited)
        assert r.near_edited == pytest.approx(slow_likeness(r.fingerprint, r.edited_fingerprint))
        assert r.near_next == pytest.approx(slow_likeness(r.fingerprint, prints[r.doc_id]))


def test_repeated_rows_one_row_and_empty_table(spark):
    assert len(C.against_edits(table(spark, odd_rows())).collect()) == len(odd_rows())
    one = C.against_edits(table(spark, [(5, "alone here", "a")])).collect()
    assert [r.near_next for r in one] == [1.0]
    assert C.against_edits(table(spark, [])).count() == 0
    fps = {r.fingerprint for r in C.fingerprints(table(spark, [(1, "same", "a"), (2, "same", "b")])).collect()}
    assert len(fps) == 1


def test_ranges_are_even_for_any_ids(spark):
    """Dense ids, one far-off id, a cluster, repeated ids and many NULLs: no range takes much more than its share."""
    ids = [*range(3000), 10**15, *range(10**9, 10**9 + 1500), *[7 * 10**9] * 800, *[None] * 2000]
    docs = table(spark, [(i, f"text {k}", "a") for k, i in enumerate(ids)]).repartition(5)
    keyed = docs.select("doc_id", F.xxhash64(F.col("text")).alias("tie"))
    cuts = C._cuts(keyed, 200)
    held = [0] * len(cuts)
    for r in keyed.collect():
        held[max(C.bisect.bisect_right(cuts, (r.doc_id is None, r.doc_id or 0, r.tie)) - 1, 0)] += 1
    assert 20 <= len(cuts) <= 37 and max(held) < 4 * 200
    pairs = C.neighbours(docs, {"text": F.col("text")}, 200).collect()
    order = sorted(docs.select("doc_id", "text", F.xxhash64("text").alias("tie")).collect(), key=lambda r: (r.doc_id is None, r.doc_id or 0, r.tie))
    want = [(r.text, order[(k + 1) % len(order)].text) for k, r in enumerate(order)]
    assert sorted((r.text, r.next_text) for r in pairs) == sorted(want)


def slow_fingerprint(text):
    """Byte by byte, as the module's docstring says."""
    raw = text.encode()
    if not raw:
        return "3::"
    block = 3
    while block * 64 < len(raw):
        block *= 2

    def ends(at, size):
        h = sum((raw[at - i] + 1) * C.PLACES[i] for i in range(C.WINDOW) if at - i >= 0) & 0xFFFFFFFF
        h ^= h >> 15
        h = h * 0x85EBCA6B & 0xFFFFFFFF
        h ^= h >> 13
        return h % size == size - 1

    def signature(size):
        out, start = "", 0
        for at in range(len(raw)):
            if ends(at, size) or at + 1 - start == 4 * size or at + 1 == len(raw):
                out += C.ALPHABET[xxhash.xxh32_intdigest(raw[start:at + 1]) % 64]
                start = at + 1
        return out

    return f"{block}:{signature(block)}:{signature(2 * block)}"


def test_fingerprints_equal_byte_by_byte():
    rng = random.Random(6)
    for t in [t or "" for _, t, _ in odd_rows()] + [prose(rng, n) for n in (1, 2, 5, 40, 700)] + ["ab" * 900, "é漢😀" * 50, "x" * 4001]:
        assert C.fingerprint(t) == slow_fingerprint(t)
