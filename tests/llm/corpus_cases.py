"""Made-up documents for the tests."""

from __future__ import annotations

import random

from pyspark.sql import types as T

SCHEMA = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("n_chars", T.LongType()),
        # names that operators use themselves
        T.StructField("score", T.StringType()),
        T.StructField("n_tokens", T.StringType()),
        T.StructField("component_id", T.StringType()),
        T.StructField("group", T.StringType()),
    ]
)


def invented(seed: int, words: int) -> str:
    rng = random.Random(seed)
    syllables = ["ka", "lo", "mi", "ten", "ra", "su", "vel", "dor", "pi", "gan"]
    return " ".join("".join(rng.choices(syllables, k=rng.randint(1, 3))) for _ in range(words))


def odd_texts() -> list[str | None]:
    long = invented(1, 30_000)
    return [
        None,
        "",
        "   \n\t \r\n",
        "one",
        "It's 12 o'clock <|endoftext|> and <|startoftext|>more  spaces\tand\x0btabs\n\n\nlines ",
        "a b   c d \x1c e",
        "Été ΣΣ 你好 \U0001f600 é <|endoftext|><|endoftext|>",
        long,
        long + " end",
        "x" * 50_000,
        "same line\nsame line\nsame line",
        "same line\nsame line\nsame line",
    ]


def frame(spark, texts, ids=None):
    ids = range(len(texts)) if ids is None else ids
    rows = [(i, t, ("en", None, "fr")[k % 3], None, 5, "x", "y", "z", "g") for k, (i, t) in enumerate(zip(ids, texts))]
    return spark.createDataFrame(rows, SCHEMA)
