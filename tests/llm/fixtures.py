"""Small documents with every awkward case, for all operators."""

import random

from pyspark.sql import functions as F

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def awkward_documents(seed=5):
    draw = random.Random(seed)
    vocabulary = ["".join(draw.choice("abcdeé") for _ in range(draw.randint(1, 7))) for _ in range(300)]

    def prose(n):
        return " ".join(draw.choice(vocabulary) for _ in range(n))

    base = prose(60).split(" ")
    texts = [None, "", " \n\t", "one", "One two", "one two", "a b c d e", "A b c d e", prose(4)]
    texts += [prose(draw.randint(5, 90)) for _ in range(25)]
    for n in (1, 2, 3, 4, 12, 30):  # near copies at falling similarity
        copy = list(base)
        for at in draw.sample(range(60), n):
            copy[at] = "other"
        texts += [" ".join(copy)] * 2
    texts += [" ".join(base), prose(20_000), "x" * 50_000, "\n".join([prose(12)] * 9)]
    texts += ["### $$$ " + prose(5) + " *** &&&", "Licensed under the Apache License, Version 2.0.", "İ! 日本  语 é́ <|endoftext|>"]
    return [
        (i, t, [None, "en", "fr"][i % 3], [None, "hot", "hot", "rare"][i % 4], None) for i, t in enumerate(texts)
    ]


def frame(spark, rows):
    """Rows as a frame, with columns whose names clash with those used inside."""
    df = spark.createDataFrame(rows, SCHEMA)
    names = ["rep", "key", "a", "b", "n_words", "component", "host", "path", "score", "kept", "piece", "row"]
    return df.select("*", *[F.lit(None).cast("string").alias(n) for n in names])
