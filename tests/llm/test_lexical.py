import math
import random
import re
from collections import Counter

import pytest
from helpers import odd_rows, prose, table

from sideline.llm import lexical as L

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
FOLD = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def terms(text):
    return TERM.findall((text or "").translate(FOLD))


def brute(rows, items, top):
    """The contract word by word; rows and items: (id, text)."""
    held = [(d, Counter(terms(t)), len(terms(t))) for d, t in rows if terms(t)]
    n_docs, n_terms = len(held), sum(n for _, _, n in held)
    df = Counter(t for _, c, _ in held for t in c)
    out = []
    for item, text in items:
        found = []
        for d, c, n in held:
            m = 100 - 25 + (25 * n * n_docs) // n_terms
            score = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((10**9 * c[t]) // (1000 * c[t] + 12 * m))
                        for t in terms(text) if c[t])
            if score > 0:
                found.append((-score, d is None, d or 0, d))
        out += [(item, i + 1, d, -s) for i, (s, _, _, d) in enumerate(sorted(found, key=lambda x: x[:3])[:top])]
    return sorted(out, key=str)


def run(spark, rows, items, **how):
    docs = table(spark, [(i, t, "s") for i, t in rows])
    asked = spark.createDataFrame([(i, t, "x") for i, t in items], "item_id bigint, text string, rank string")
    got = L.search(docs, asked, **how)
    assert got.dtypes == [("item_id", "bigint"), ("rank", "int"), ("doc_id", "bigint"), ("score", "bigint")]
    return sorted(((r.item_id, r.rank, r.doc_id, r.score) for r in got.collect()), key=str)


def corpus(seed, n):
    rng = random.Random(seed)
    words = prose(rng, 300).split()
    rows = [(i, " ".join(rng.choices(words, weights=[1 / (k + 1) for k in range(len(words))], k=rng.choice([3, 9, 40, 400])))) for i in range(n)]
    rows += [(1000 + i, rows[7][1]) for i in range(40)]  # a group of copies: ties by doc_id
    return rows, [(i, " ".join(rng.choices(words, k=12)) + " WORDS that nobody uses") for i in range(8)]


@pytest.mark.parametrize("first,block", [(2_000, 1_000_000), (1, 50), (30, 400)])
def test_equals_scoring_every_document(spark, first, block):
    # small waves and blocks: pruned strata, strata of several blocks
    rows, items = corpus(first, 150)
    for top in (1, 20):
        assert run(spark, rows, items, top=top, first_docs=first, block_postings=block) == brute(rows, items, top)


def test_odd_rows(spark):
    rows = [(i, t) for i, t, _ in odd_rows()] + [(20, "Same-text... SAME\x00same\x7fone漢字 x"), (21, "éÉ éÉ")]
    items = [(1, "SAME same text"), (2, None), (3, ""), (4, "漢字 één éÉ"), (5, "..."), (None, "same"), (6, "one漢字"), (6, "x" * 9000)]
    want = brute(rows, items, 20)
    assert any(r[2] is None for r in want)
    assert run(spark, rows, items) == want
    assert run(spark, rows, items + items[:1]) == want  # a repeated item is one item


def test_empty_tables(spark):
    assert run(spark, [], [(1, "a")]) == []
    assert run(spark, [(1, None), (2, "..")], [(1, "a")]) == []
    assert run(spark, [(1, "a")], []) == []
    assert run(spark, [(1, "a")], [(1, "b")]) == []


def test_bitmap_keeps_all_terms_asked_for(spark):
    asked = spark.createDataFrame([(t,) for t in ("a", "漢字", "zz")], "term string")
    docs = spark.createDataFrame([(1, "a b 漢字 a"), (2, "ZZ")], "doc_id bigint, text string")
    whole, some = L.Index(docs), L.Index(docs, asked)
    assert {t for r in whole.rows.collect() for t in r.terms} == {"a", "b", "漢字", "zz"}
    assert {"a", "漢字", "zz"} <= {t for r in some.rows.collect() for t in r.terms} <= {"a", "b", "漢字", "zz"}
    assert (whole.n_docs, whole.n_terms) == (some.n_docs, some.n_terms) == (2, 5)
