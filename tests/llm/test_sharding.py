import random
import zlib
from collections import Counter

from helpers import odd_rows, prose, table

from sideline.llm import sharding as S


def test_shards_are_near_equal_with_a_hot_text(spark):
    rng = random.Random(1)
    rows = [(k, prose(rng, rng.randint(0, 60)), "a") for k in range(4000)]
    rows += [(10_000 + k, "one hot text, again and again", "a") for k in range(2500)]
    got = S.shard(table(spark, rows), ranges_per_shard=32).collect()
    assert len(got) == len(rows)
    size = Counter()
    slots = {}
    for r in got:
        size[r.shard] += r["size"]
        slots.setdefault(r.shard, []).append(r.slot)
    mean = sum(size.values()) / 8
    assert set(size) == set(range(8))
    assert all(abs(v - mean) < 0.03 * mean for v in size.values()), size
    assert all(sorted(v) == list(range(len(v))) for v in slots.values())
    text = {i: t for i, t, _ in rows}
    assert all(r["size"] == len(text[r.doc_id].encode()) + 1 and r.text_crc32 == zlib.crc32(text[r.doc_id].encode()) for r in got)


def test_equal_texts_mostly_share_a_shard_and_reruns_agree(spark):
    rng = random.Random(2)
    texts = [prose(rng, 20) for _ in range(200)]
    rows = [(k, texts[k % 200], "a") for k in range(1000)]
    docs = table(spark, rows)
    a = sorted(map(tuple, S.shard(docs, ranges_per_shard=4).collect()))
    assert a == sorted(map(tuple, S.shard(docs.repartition(5), ranges_per_shard=4).collect()))
    places = {}
    for r in a:
        places.setdefault(r[2], set()).add(r[3])
    assert sum(len(p) == 1 for p in places.values()) > 180


def test_odd_rows(spark):
    got = S.shard(table(spark, odd_rows())).collect()
    assert Counter(r.doc_id for r in got) == Counter(i for i, _, _ in odd_rows())
    null = next(r for r in got if r.doc_id == 1)
    assert (null["size"], null.text_crc32) == (1, 0)
    assert all(sorted(r.slot for r in got if r.shard == s) == list(range(sum(r.shard == s for r in got))) for s in range(8))
    assert S.shard(table(spark, [])).count() == 0
