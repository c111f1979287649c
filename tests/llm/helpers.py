"""Small tables for the operators' tests."""

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def documents(spark, texts, partitions=3):
    """texts: a list of texts, or of (doc_id, text)."""
    rows = [t if isinstance(t, tuple) else (i, t) for i, t in enumerate(texts)]
    df = spark.createDataFrame([(i, t, "en", "s", None if t is None else len(t)) for i, t in rows], DOCS)
    return df.repartition(partitions) if rows else df


def rows(df, *columns):
    return sorted((tuple(r[c] for c in columns) for r in df.collect()), key=repr)
