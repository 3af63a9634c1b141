"""Hand-made documents with the odd rows that every operator must take."""

import random

from pyspark.sql import types as T

SCHEMA = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
    T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType()),
    # names that operators use inside
    T.StructField("node", T.StringType()), T.StructField("size", T.IntegerType()), T.StructField("taken", T.StringType()),
    T.StructField("n_words", T.StringType()), T.StructField("score", T.StringType()), T.StructField("bucket", T.StringType()),
])


def prose(seed: int, n: int, vocabulary: int = 4000) -> str:
    r = random.Random(seed)
    words = []
    for _ in range(n):
        k = int(r.paretovariate(0.6)) % vocabulary
        words.append("".join("aeioustnrl"[int(c)] for c in str(k * 7919 + 11)))
    return " ".join(words)


def rows() -> list[tuple]:
    base = prose(1, 120)
    near = base.split()
    near[60] = "changed"
    passage = prose(2, 70)
    texts = [
        (1, base, "a", "s1"), (2, base, "a", "s1"), (3, " ".join(near), "a", "s2"), (4, prose(3, 80), "b", "s2"),
        (5, None, "b", "s1"), (6, "", None, None), (7, " \t\n\x0b ", "a", "s3"), (8, "one two", "a", "s3"), (9, "One  TWO", "b", "s3"),
        (10, prose(4, 60) + "\n" + passage, "b", None), (11, prose(5, 60) + "\n" + passage + "\n" + prose(6, 40), "a", "s2"),
        (12, "é" * 150 + prose(7, 60), "a", "s1"), (13, "é" * 150 + prose(8, 60), "b", ""), (14, "x" * 450, "a", "s2"),
        (15, prose(9, 30000), "a", "s3"), (16, "😀 #$%& " * 60, "b", "s2"), (17, "<|endoftext|> a\x00b     ẞİ", "a", "s1"),
        (None, prose(10, 70), "a", "s1"), (None, None, None, None), (4, prose(3, 80), "b", "s2"), (4, prose(11, 55), "b", "s2"),
        (-3, "!!! 123 ???", "b", "s1"), (18, "AB CD EF GH IJ " * 40, "a", "s2"), (19, "ab cd ef gh ij " * 40, "a", "s2"),
    ]
    return [(i, t, lang, s, None if t is None else len(t), "x", 1, "y", "z", "w", "v") for i, t, lang, s in texts]


def documents(spark):
    return spark.createDataFrame(rows(), SCHEMA).repartition(3)


def nothing(spark):
    return spark.createDataFrame([], SCHEMA)
