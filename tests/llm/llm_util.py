"""Fixtures of the operators' tests: documents with every odd case."""

import random

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, size long, shard int, component_id string, _row string"


def odd_documents(spark, extra=()):
    """Nulls in every column, empty and very long texts, ties, repeated rows, clashing column names."""
    rng = random.Random(5)
    words = ["the", "of", "Haus", "und", "éle", "que", "los", "x1", "a.b", "+1", "(555)"]
    long_ = " ".join(rng.choice(words) + str(rng.randrange(3000)) for _ in range(60_000))
    texts = [
        (1, "the quick brown fox jumps over the lazy dog and runs away", "en", "a"),
        (2, "the quick brown fox jumps over the lazy dog and runs away", "en", "a"),
        (2, "the quick brown fox jumps over the lazy dog and runs away", "en", "a"),
        (3, None, "en", "b"),
        (4, "", "de", None),
        (5, " \n\t ", None, ""),
        (6, "12345 678 !!", "de", "b"),
        (7, long_, "en", "a"),
        (8, "der schnelle braune Fuchs springt über den faulen Hund", "de", "b"),
        (9, "two words", None, "b"),
        (None, "a row without a key but with text", None, "a"),
        (None, None, None, None),
        (11, "mail a.b@c.example.com or +1 (555) 555-0100 now", "en", "c"),
        *extra,
    ]
    return spark.createDataFrame([(d, t, l, s, len(t) if t else None, 7, 1, "x", "y") for d, t, l, s in texts], SCHEMA)


def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def collected(df, *keys):
    rows = [r.asDict(recursive=True) for r in df.collect()]
    return sorted(rows, key=lambda r: [(r[k] is None, r[k]) for k in keys]) if keys else rows
