"""Documents for the tests."""

SCHEMA = "doc_id long, text string, n_chars long, low long, high long, key string, words string, score double, label int, size string, hash string"


def frame(spark, rows, schema=SCHEMA):
    """Documents (doc_id, text) with further columns whose names the operators use inside, all NULL."""
    width = len(schema.split(",")) - 2
    return spark.createDataFrame([(i, t, *[None] * width) for i, t in rows], schema)
