import random

import public_tokenizers
import pytest
import tiktoken
from helpers import odd_rows, table
from pyspark.sql import functions as F

from sideline.llm import byte_bpe as B
from sideline.llm import queries

RANKS = B.read_ranks(public_tokenizers.path(queries.VOCABULARY))
PATTERN = public_tokenizers.PATTERN


@pytest.fixture(scope="module")
def oracle():
    return tiktoken.Encoding("oracle", pat_str=PATTERN, mergeable_ranks=RANKS, special_tokens={})


def some_texts():
    rng = random.Random(4)
    texts = [t for _, t, _ in odd_rows()] + ["a" * 5000, "ab" * 3000, "<|endoftext|> it's  \n\n x y z ", "\x1c\x1d \x85"]
    for chars in ("abcdefthe in  \n01", "éßñ漢😀 a", "aA1 .,'\t​"):
        texts += ["".join(rng.choices(chars, k=rng.randint(0, 300))) for _ in range(60)]
    return texts


def test_ids_equal_the_oracle_and_decode_to_the_text(spark, oracle):
    texts = some_texts()
    docs = table(spark, [(k, t, "a") for k, t in enumerate(texts)])
    for got in (B.decode(B.encode(docs, RANKS, PATTERN), RANKS).collect(), B.round_trip(docs, RANKS, PATTERN).collect()):
        assert len(got) == len(texts)
        for r in got:
            t = texts[r.doc_id] or ""
            assert r.ids == oracle.encode_ordinary(t)
            assert bytes(r.decoded) == t.encode()


def test_long_words_fold_alike(oracle):
    rng = random.Random(1)
    for n in (65, 100, 1000):
        for chars in ("ab", "the", "abcdefghij"):
            word = "".join(rng.choices(chars, k=n)).encode()
            assert B._fold_long(word, RANKS.get) == oracle.encode_ordinary(word.decode())


def test_fold_with_higher_order_functions(spark, oracle):
    rng = random.Random(2)
    words = sorted({"".join(rng.choices("abcdeth ié漢", k=rng.randint(1, 12))).strip() or "x" for _ in range(80)} | {"", "the", " and"})
    df = spark.createDataFrame([(w,) for w in words], "w string")
    for r in df.select("w", B.fold_words(F.col("w"), RANKS).alias("ids")).collect():
        assert r.ids == B.fold(r.w.encode(), RANKS.get) if r.w else r.ids == []


def test_unknown_ids_and_empty_table(spark):
    assert B.encode(table(spark, []), RANKS, PATTERN).count() == 0
    bad = spark.createDataFrame([([60000],)], "ids array<int>")
    with pytest.raises(Exception, match="60000"):
        B.decode(bad, RANKS).collect()
