import random

import pytest
from helpers import odd_rows, prose, table

from sideline.llm import toxicity as T

INSULTS = ["zorgface", "blimpwit", "grubhead", "muckmind"]


def corpus(rng, n=600, biased=True):
    """Toxic texts hold insults; if biased, they also name one group far more often than clean texts do."""
    rows, labels = [], []
    for i in range(n):
        toxic = i % 4 == 0
        words = prose(rng, rng.randint(10, 60)).split()
        if toxic and rng.random() < 0.85:
            words.insert(rng.randrange(len(words)), rng.choice(INSULTS))
        if biased and rng.random() < (0.9 if toxic else 0.05):
            words.insert(rng.randrange(len(words)), "muslims")
        rows.append((i, " ".join(words), "s"))
        labels.append((i, int(toxic)))
    return rows, labels


def labelled(spark, labels):
    return spark.createDataFrame([(i, 1, t) for i, t in labels], "doc_id bigint, quality bigint, toxic bigint")


def test_held_out_accuracy(spark):
    rng = random.Random(1)
    rows, labels = corpus(rng, 1000, biased=False)
    model = T.train(table(spark, rows), labelled(spark, [x for x in labels if x[0] < 800]))
    got = {r.doc_id: r.predicted for r in T.scores(table(spark, rows), model).collect()}
    text = dict((i, t) for i, t, _ in rows)
    right = [got[i] == int(any(w in text[i] for w in INSULTS)) for i, _ in labels[800:]]
    assert sum(right) >= 0.97 * len(right)


def test_swaps_take_the_weight_off_group_names(spark):
    rng = random.Random(2)
    rows, labels = corpus(rng)
    docs, lab = table(spark, rows), labelled(spark, labels)
    sampled, counts = T.sample(docs, lab)
    plain, fair = T.fit(sampled, counts, swap_weight=0.0), T.fit(sampled, counts, swap_weight=1.0)
    neutral = [prose(random.Random(k), 20) + " muslims" for k in range(40)]
    without = [t.removesuffix(" muslims") for t in neutral]
    rejected = lambda m: sum(m.score(t) >= 0.5 for t in neutral)
    moved = lambda m: sum(abs(m.score(a) - m.score(b)) for a, b in zip(neutral, without, strict=True)) / 40
    assert rejected(fair) < rejected(plain) / 2 and moved(fair) < moved(plain) / 2
    swapped = [t.replace("muslims", "christians") for t in neutral]
    gap = lambda m: sum(abs(m.score(a) - m.score(b)) for a, b in zip(neutral, swapped, strict=True))
    assert gap(fair) < 0.5 * gap(plain)
    assert fair.score("you are a zorgface " + neutral[0]) >= 0.5


def test_odd_rows_repeated_labels_and_classes(spark):
    rng = random.Random(3)
    rows, labels = corpus(rng, 300, biased=False)
    docs = table(spark, rows + [(10_000 + k, t, s) for k, (_, t, s) in enumerate(odd_rows())])
    odd = labels + labels[:20] + [(None, 1), (5, None), (6, 7)]
    model = T.train(docs, labelled(spark, odd))
    got = T.scores(docs, model).collect()
    assert len(got) == 300 + len(odd_rows())
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in got)
    empty = [r.score for r in got if r.doc_id in (10_000, 10_001)]
    assert empty[0] == empty[1] == pytest.approx(T.Model(model.weights, model.intercept).score(""))
    kept = T.accepted(docs, model)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted(r.doc_id for r in got if r.score < 0.5)
    none = T.train(docs, labelled(spark, []))
    assert all(r.score < 1e-12 for r in T.scores(docs, none).collect())
    ones = T.train(docs, labelled(spark, [(1, 1), (2, 1)]))
    assert {r.predicted for r in T.scores(docs, ones).collect()} == {1}
    assert T.scores(table(spark, []), model).count() == 0
    assert T.train(table(spark, []), labelled(spark, labels)).score("x") < 0.5


def test_the_sample_is_bounded(spark):
    rows, labels = corpus(random.Random(4), 200, biased=False)
    sampled, counts = T.sample(table(spark, rows), labelled(spark, labels), 10, 15)
    assert sorted(sampled["toxic"].to_pylist()) == [0] * 15 + [1] * 10
    assert counts == {0: 150, 1: 50}


def slow_model(rows, labels, steps=150, l2=1e-4):
    """The fit once more with dense matrices over words and beginnings of words, without hashing."""
    import math
    import re

    import numpy as np

    text = dict(rows)
    ids = [i for i, _ in labels]
    y = np.array([t for _, t in labels], float)
    words = lambda t: set(re.findall(r"[^\W\d_]+", t.lower()))
    names = lambda ws: {n for w in ws for n in (w, *(w[:k] + "~" for k in T.PREFIXES if len(w) > k))}
    own = [names(words(text[i])) for i in ids]
    other = [names({T.SWAP.get(w, w) for w in words(text[i])}) if words(text[i]) & set(T.SWAP) else None for i in ids]
    n1, n0 = y.sum(), len(y) - y.sum()
    chosen = []
    for f in sorted(set().union(*own)):
        one, all_ = sum(f in o for o, t in zip(own, y) if t), sum(f in o for o in own)
        p1, p0, p = (one + .5) / (n1 + 1), (all_ - one + .5) / (n0 + 1), (all_ + 1) / (n1 + n0 + 2)
        z = (p1 - p0) / math.sqrt(p * (1 - p) * (1 / n1 + 1 / n0))
        if all_ >= T.MIN_DOCS and abs(z) >= T.MIN_Z or f in names(T.SWAP):
            chosen.append(f)
    dense = lambda sets: np.array([[f in s for f in chosen] for s in sets], float).reshape(len(sets), len(chosen))
    x = dense(own)
    a, b = dense([o for o, s in zip(own, other) if s is not None]), dense([s for s in other if s is not None])
    balance = np.where(y == 1, .5 / n1, .5 / n0)
    theta, m, v = np.zeros(len(chosen) + 1), np.zeros(len(chosen) + 1), np.zeros(len(chosen) + 1)
    for t in range(1, steps + 1):
        w = theta[:-1]
        g = balance * (1 / (1 + np.exp(-np.clip(x @ w + theta[-1], -30, 30))) - y)
        grad = np.append(x.T @ g + l2 * w, g.sum())
        if len(a):
            gap = (a @ w - b @ w) / len(a)
            grad[:-1] += a.T @ gap - b.T @ gap
        m, v = .9 * m + .1 * grad, .99 * v + .01 * grad**2
        theta = theta - .15 * (m / (1 - .9**t)) / (np.sqrt(v / (1 - .99**t)) + 1e-9)
    weight = dict(zip(chosen, theta[:-1]))
    start = theta[-1] + T.PRIOR_SHARE * math.log(n1 / n0)
    return lambda t: 1 / (1 + math.exp(-(start + sum(weight.get(f, 0) for f in names(words(t))))))


def test_scores_equal_a_dense_fit(spark):
    rows, labels = corpus(random.Random(6), 160)
    docs = table(spark, rows)
    slow = slow_model([(i, t) for i, t, _ in rows], labels[:120])
    got = {r.doc_id: r.score for r in T.scores(docs, T.train(docs, labelled(spark, labels[:120]))).collect()}
    for i, t, _ in rows:
        assert got[i] == pytest.approx(slow(t), abs=2e-4)
    assert max(got.values()) > 0.9 and min(got.values()) < 0.1
