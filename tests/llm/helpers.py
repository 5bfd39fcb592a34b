"""Small tables with the awkward cases: nulls, empty and very long texts, ties, repeated rows, clashing columns."""

from pyspark.sql import types as T

SF = "/root/testdata/sf0.001"
DOCS = T.StructType(
    [
        T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType()),
    ]
)
LONG = "the quick brown fox jumps over the lazy dog and " * 60_000
AWKWARD = [
    (None, "a text without an id", "en", "a", 20),
    (1, None, "en", "a", None),
    (2, "", "en", None, 0),
    (3, "  \t\n ", None, "b", 5),
    (4, "12 34 !?", "en", "b", 8),
    (5, "a text with words that are said twice", "en", "b", 37),
    (5, "a text with words that are said twice", "en", "b", 37),
    (6, "a text with words that are said twice", None, "é", 37),
    (7, LONG, "en", "Z", len(LONG)),
    (8, "w" * 200_000, "en", "Z", 200_000),
    (9, "Der Ölpreis \U0001f600 für <|endoftext|> Öl’s", "de", "Z", 40),
    (10, "x y\x1cz a", "de", "Z", 7),
]


def docs(spark, rows=None):
    return spark.createDataFrame(AWKWARD if rows is None else rows, DOCS)


def clashing(frame, *names):
    """The frame with string columns of the given names added."""
    from pyspark.sql import functions as F

    return frame.select("*", *[F.lit("mine").alias(n) for n in names])
