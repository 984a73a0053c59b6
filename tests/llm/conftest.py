import pytest
from pyspark.sql import types as T

SCHEMA = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
                       T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()),
                       T.StructField("n_chars", T.LongType())])

LONG = " ".join(f"Wort{i % 997} line{i % 13}," + ("\n" if i % 40 == 39 else "") for i in range(20_000))

#: Nulls, empty, blanks, ties, repeats, very long, other scripts, special strings.
ODD = [
    (1, "The quick brown fox jumps over the lazy dog. " * 6), (2, None), (3, ""), (4, "   \n\t "),
    (5, "one"), (6, "Two words"), (7, "ÉTÉ naïve — 東京 ΣΑΣ ſtraße x İ <|endoftext|> tail <s> </s>"),
    (8, LONG), (8, LONG), (9, "a" * 3000), (10, "be be be be " * 30), (None, "no id here, but some text."),
    (None, None), (12, "x  y\n\n z \t.\r\n ▁▁ <|startoftext|>don't it's 12345 ... !!"),
    (13, "The quick brown fox jumps over the lazy dog. " * 6), (14, "The quick brown fox jumps over the lazy cat. " * 6),
    (15, "Home | About | Contact | Login | Shop\nReal prose goes on here, as it should, to a full stop.\nok"),
    (16, "mail a.b@c.example.com or +1 (269) 555-3296 4524132264652876 or 10.0.0.1 now"),
]


@pytest.fixture(scope="session")
def odd(spark):
    return spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in ODD], SCHEMA)


@pytest.fixture(scope="session")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def clash(spark):
    """Column names that operators might use themselves."""
    rows = [(i, t, "x", 1, 2, None, 3.0, "q", 5) for i, t in ODD[:7]]
    return spark.createDataFrame(rows, "doc_id long, text string, fp string, score long, part long, label string, "
                                       "length double, kind string, n_words long")


@pytest.fixture(scope="session")
def small(spark):
    return spark.read.parquet("/root/testdata/sf0.001/documents.parquet")


def pairs(df):
    return [(r["doc_id"], r["text"] or "") for r in df.select("doc_id", "text").collect()]
