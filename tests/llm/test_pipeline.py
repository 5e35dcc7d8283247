import hashlib
import random
from collections import Counter

import public_tokenizers
import pytest
import tiktoken

from helpers import odd_rows, prose, table

import corpus_pipeline as P
from sideline.llm import block_naming, byte_bpe, mixing, queries, simhash, toxicity

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark):
    """What each stage takes in and gives out."""
    docs, out = spark.read.parquet(f"{SF}/documents.parquet").cache(), []
    for _, stage in P.STAGES:
        result = stage(spark, docs, SF).cache()
        out.append((docs.collect(), result.collect(), result.columns))
        docs = result
    return out


def test_all_but_the_last_return_documents(stages):
    assert len(P.STAGES) == 5
    for _, _, columns in stages[:4]:
        assert columns == ["doc_id", "text", "lang", "source", "n_chars"]


def test_toxicity(spark, stages):
    before, after, _ = stages[0]
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    gone = {r.doc_id for r in before} - {r.doc_id for r in after}
    known = [i for i in gone if i in labels]
    toxic = [i for i, t in labels.items() if t == 1]
    assert sum(i in gone for i in toxic) >= 0.5 * len(toxic)  # learnt from some 70 labelled rows
    assert sum(labels[i] == 0 for i in known) <= 0.05 * (len(labels) - len(toxic))


def test_exact_dedup(stages):
    before, after, _ = stages[1]
    keep = {}
    for r in before:
        key = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in r.text or "")
        keep[key] = max(keep.get(key, -1), r.doc_id)
    assert sorted(r.doc_id for r in after) == sorted(keep.values())


def test_near_dedup(stages):
    from test_simhash import brute_components, slow_fingerprint

    before, after, _ = stages[2]
    fps = {r.doc_id: slow_fingerprint(r.text) for r in before}
    comp, least = brute_components(fps.values()), {}
    for i, f in fps.items():
        least[comp[f]] = min(i, least.get(comp[f], i))
    assert sorted(r.doc_id for r in after) == sorted(least.values())


def test_mix(spark, stages):
    before, after, _ = stages[3]
    docs = spark.createDataFrame(before)
    want = Counter()
    for r in mixing.mix(docs).collect():
        if r["size"]:
            want[r.doc_id] += r.taken // r["size"]
    assert Counter(r.doc_id for r in after) == +want


def test_encoding(stages):
    before, after, _ = stages[4]
    ranks = byte_bpe.read_ranks(public_tokenizers.path(queries.VOCABULARY))
    enc = tiktoken.Encoding("o", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    want = []
    for r in before:
        ids = enc.encode_ordinary(r.text or "")
        want.append((r.doc_id, len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(),
                     hashlib.sha256((r.text or "").encode()).hexdigest()))
    assert sorted(map(tuple, after)) == sorted(want)


def test_run_applies_the_stages(spark, stages):
    assert sorted(map(tuple, P.run(spark, SF).collect())) == sorted(map(tuple, stages[4][1]))
    assert {m.__name__ for m in (toxicity, block_naming, simhash)}


def written(spark, folder, rows, labels, extra):
    table(spark, rows, extra).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(labels, "doc_id bigint, quality bigint, toxic bigint").write.parquet(f"{folder}/labels.parquet")
    return str(folder)


@pytest.mark.parametrize("extra", [True, False])
def test_odd_rows_through_the_whole_pipeline(spark, tmp_path, extra):
    """NULLs in any column, empty and long texts, ties, repeated rows and labels, columns with clashing names."""
    rng = random.Random(1)
    near = prose(rng, 200)
    rows = odd_rows() + odd_rows() + [(50 + k, prose(rng, rng.randint(0, 60)), rng.choice(["a", "b", None])) for k in range(40)]
    rows += [(200, near, "a"), (201, near + " end", "b"), (None, near + " stop", None), (300, "insult " * 3, "a"), (300, "insult insult insult ", "a")]
    sf = written(spark, tmp_path, rows, [(k, 1, 0) for k in range(50, 80)] + [(1, 1, 0), (4, 0, 1), (4, 0, 0), (50, None, None), (None, 1, 1), (999, 1, 1)], extra)
    docs, columns = spark.read.parquet(f"{sf}/documents.parquet"), table(spark, [], extra).columns
    for name, stage in P.STAGES[:-1]:
        got = stage(spark, docs, sf)
        assert got.columns == columns, name
        kept, held = Counter(map(str, got.collect())), Counter(map(str, docs.collect()))
        assert kept and set(kept) <= set(held)
        if name != "mixing sources to target weights":
            assert all(kept[r] <= held[r] for r in kept), name
        docs = spark.createDataFrame(got.collect(), got.schema)
    want = [tuple(r) for r in P.STAGES[-1][1](spark, docs, sf).collect()]
    assert len(want) == docs.count()
    assert sorted(map(str, map(tuple, P.run(spark, sf).collect()))) == sorted(map(str, want))
    digests = {hashlib.sha256(t.encode()).hexdigest() for t in [near, near + " end", near + " stop"]}
    assert len(digests & {r[3] for r in want}) <= 1  # one of the near copies at most


def test_empty_tables_through_the_whole_pipeline(spark, tmp_path):
    sf = written(spark, tmp_path, [], [], True)
    got = P.run(spark, sf)
    assert got.count() == 0 and got.columns[:4] == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
