import random
from collections import defaultdict

import pytest
from helpers import LETTERS, odd_rows, table

from sideline.llm import block_naming as B


def brute(rows):
    low = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    groups = defaultdict(list)
    for i, t, _ in rows:
        groups[(t or "").translate(low)].append(i)
    out = []
    for ids in groups.values():
        known = [i for i in ids if i is not None]
        keep, kept = max(known, default=None), False
        for i in sorted(ids, key=lambda i: -1 if i is None else i, reverse=True):
            out.append((i, keep, len(ids), i == keep and not kept))
            kept = kept or i == keep
    return sorted(out, key=str)


@pytest.mark.parametrize("block_chars,bucket_bits", [(4096, 40), (3, 2), (7, 1), (1000, 4)])
def test_groups_equal_brute_force(spark, block_chars, bucket_bits):
    rng = random.Random(block_chars)
    rows = odd_rows() if block_chars > 10 else [r for r in odd_rows() if len(r[1] or "") < 100]
    rows += [(100 + k, "".join(rng.choices("abA", k=rng.randint(0, 14))), "s") for k in range(150)]
    got = B.exact_groups(table(spark, rows), block_chars, bucket_bits).collect()
    assert sorted([(r.doc_id, r.keep_id, r.group_size, r.kept) for r in got], key=str) == brute(rows)


def test_names_tell_all_texts_apart(spark):
    # two buckets only: ranks, not hashes, make the names
    rng = random.Random(5)
    texts = {"".join(rng.choices(LETTERS, k=rng.randint(0, 40))) for _ in range(300)}
    rows = [(k, t, "s") for k, t in enumerate(sorted(texts))]
    got = B.identities(table(spark, rows), 4, 1).select("n_blocks", "name").collect()
    assert len({(r.n_blocks, r.name) for r in got}) == len(texts)


def test_drop_keeps_one_row_of_each_group(spark):
    docs = table(spark, odd_rows())
    kept = B.drop_exact(docs)
    assert kept.columns == docs.columns
    got = sorted([(r.doc_id, r.text) for r in kept.collect()], key=str)
    assert got == sorted([(2, ""), (4, "same text"), (7, " "), (8, "x" * 9000), (9, "x" * 8999 + "y"), (10, "één ß 漢字 😀")], key=str)


def test_empty_table(spark):
    docs = table(spark, [])
    assert B.exact_groups(docs).count() == 0
    assert B.drop_exact(docs).count() == 0
