"""Small tables that every operator must take: nulls, empty and long texts, repeats, clashing extra columns."""

import random

LONG = " ".join(random.Random(3).choice(["alpha", "beta", "gamma", "delta", "omega", "kappa"]) + str(i % 97) for i in range(40_000))
DOCS = [
    (1, "The quick brown fox jumps over the lazy dog near the river bank", "en", "a", 63),
    (2, "The quick brown fox jumps over the lazy dog near the river bank", "en", "a", 63),
    (2, "The quick brown fox jumps over the lazy dog near the river bank", "en", "a", 63),
    (3, None, "en", None, None),
    (4, "", None, "b", 0),
    (5, "12345 !!! ...", "en", "b", 13),
    (None, "Der schnelle braune Fuchs springt über den faulen Hund am Fluss", "de", "b", 62),
    (6, "Le renard brun saute par-dessus le chien 😀 paresseux", "fr", "c", 52),
    (7, LONG, "en", "c", len(LONG)),
    (8, "one two", "en", "c", 7),
]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def docs(spark):
    return spark.createDataFrame(DOCS, SCHEMA)


def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)


def crowded(df):
    """The same table with columns named as operators might name their own."""
    from pyspark.sql import functions as F

    names = "id key node root bands n copies block items spans base ids words code lang_pred score t p label grp cell host wrapper payload digest size".split()
    return df.select("*", *[F.lit("x").alias(n) for n in names if n not in df.columns])
