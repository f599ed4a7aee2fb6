import random

import pytest
from pyspark.sql import types as T

DOCS = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
    T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType()),
])


def frame(spark, rows, **extra):
    """A documents table of (doc_id, text) rows, with further constant columns."""
    from pyspark.sql import functions as F
    full = [(i, t, None if i is None or i % 7 == 3 else ("en", "fr")[i % 2], None if i is None or i % 5 == 4 else f"s{i % 3}", None if t is None else len(t)) for i, t in rows]
    df = spark.createDataFrame(full, DOCS)
    for name, value in extra.items():
        df = df.withColumn(name, F.lit(value))
    return df


def prose(rng: random.Random, words: int, vocabulary: int = 4000) -> str:
    syllables = ["an", "der", "ti", "on", "é", "sch", "re", "ou", "ñ", "ble", "st", "wh"]
    out = []
    for _ in range(words):
        n = rng.randrange(vocabulary)
        word = ""
        while True:
            word += syllables[n % len(syllables)]
            n //= len(syllables)
            if not n:
                break
        out.append(word.capitalize() + "." if rng.random() < 0.1 else word)
    return " ".join(out)


@pytest.fixture(scope="session")
def odd_rows():
    """Nulls, empty and very long texts, repeated passages, odd characters."""
    rng = random.Random(5)
    passage = prose(rng, 80)
    long = prose(rng, 6000)
    rows = [
        (0, None), (1, ""), (2, "  \n\t "), (3, passage), (4, passage), (5, prose(rng, 30) + " " + passage + " " + prose(rng, 20)),
        (6, long), (7, long.replace("an", "on", 3)), (8, "a" * 1000), (9, "ab" * 300), (10, " x y 　z\u0085w"),
        (11, "😀 <|endoftext|>hello <|startoftext|> IT'S we'll 12345 é"), (12, "one two three"), (13, "ONE two three"),
        (14, "# $ % & | < > ***\n# $ % & | < > ***\n\nx"), (15, "word " * 500), (16, "\n".join(["the same line again here"] * 9)),
    ]
    rows += [(i, prose(rng, rng.randrange(1, 300))) for i in range(17, 60)]
    return rows
