"""Small tables for the operators' tests."""

import random

LETTERS = "abcdefghij"


def table(spark, rows, extra=True):
    """documents rows (doc_id, text, source), with columns whose names operators use inside."""
    schema = "doc_id bigint, text string, lang string, source string, n_chars bigint"
    full = [(i, t, "en", s, None if t is None else len(t)) for i, t, s in rows]
    df = spark.createDataFrame(full, schema)
    if extra:
        for c in ("size", "tie", "key", "_key", "range", "_nth", "name", "item", "bucket", "fp", "t", "base", "start", "n"):
            from pyspark.sql import functions as F
            df = df.withColumn(c, F.lit(f"extra {c}"))
    return df


def prose(rng: random.Random, n: int) -> str:
    return " ".join("".join(rng.choices(LETTERS, k=rng.randint(1, 7))) for _ in range(n))


def odd_rows():
    """NULLs in any column, empty texts, ties and repeated rows."""
    return [(1, None, "a"), (2, "", "a"), (3, "Same Text", None), (4, "same text", "b"), (4, "same text", "b"),
            (None, "same text", "b"), (None, None, None), (7, " ", "a"), (8, "x" * 9000, "b"), (9, "x" * 8999 + "y", "b"),
            (10, "één ß 漢字 😀", "c")]
