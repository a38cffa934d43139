"""Small documents with the awkward cases every operator must survive."""

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def frame(spark, texts, schema=SCHEMA):
    rows = [(i, t, "en", f"src{i % 3}", None if t is None else len(t)) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, schema)


def awkward(spark):
    """Null id, null text, null everything, repeated rows, ties, empty and very long texts."""
    long = " ".join(f"word{i % 977}" for i in range(30000))
    rows = [
        (0, "alpha beta gamma delta epsilon zeta", "en", "a", 5),
        (0, "alpha beta gamma delta epsilon zeta", "en", "a", 5),
        (1, "Alpha beta gamma delta epsilon zeta", "en", "a", 5),
        (2, None, None, None, None),
        (3, "", "de", "b", 0),
        (None, "alpha beta gamma delta epsilon zeta", "en", "a", 5),
        (4, long, "en", "a", len(long)),
        (5, long, "en", "c", len(long)),
        (6, "\n\n \t\n", "fr", "c", 5),
        (None, None, None, None, None),
    ]
    return spark.createDataFrame(rows, SCHEMA)
