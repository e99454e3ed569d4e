"""Small fixtures for the training-data operators."""

import random

DOC_SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def documents(spark, rows, extra=None):
    """Documents from (doc_id, text) or (doc_id, text, lang, source) rows; ``extra`` adds constant columns."""
    from pyspark.sql import functions as F

    full = [(r[0], r[1], r[2] if len(r) > 2 else "en", r[3] if len(r) > 3 else "s", None if r[1] is None else len(r[1])) for r in rows]
    df = spark.createDataFrame(full, DOC_SCHEMA)
    for name, value in (extra or {}).items():
        df = df.withColumn(name, F.lit(value))
    return df


def prose(rng: random.Random, words: int) -> str:
    syllables = "th er on an re he in ed nd ha at en es of or nt ea ti to it st io le is ou ar as de rt ve".split()
    return " ".join("".join(rng.choice(syllables) for _ in range(rng.randint(1, 4))) for _ in range(words))
