"""Tables that the tests of this folder share."""

from pyspark.sql import types as T

SF_SMALL = "/root/testdata/sf0.001"
EXTRA = ["block", "part", "word", "id", "row", "fp", "kind", "score", "digest"]


def documents(spark, rows):
    """``rows`` of (doc_id, text) with extra columns whose names the operators use inside."""
    schema = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType())]
                          + [T.StructField(c, T.StringType()) for c in EXTRA])
    return spark.createDataFrame([(i, t, *(c if i else None for c in EXTRA)) for i, t in rows], schema)


LONG = " ".join(f"w{i % 977}x{i}" for i in range(40_000))
ODD = [
    (None, "a text without an id"), (None, None), (1, None), (2, ""), (3, " \t\n "), (4, "one"), (5, "two Words"),
    (6, "MIT License and more text here"), (6, "MIT License and more text here"), (7, "MIT License and more text here"),
    (8, LONG), (9, "Ünïcödé ñandú 日本語 🎉 naïve"), (10, "x" * 30_000), (11, "the the the the the the the"),
    (12, "<|endoftext|> inside, it's 2024 \x1c odd space İstanbul"),
]
