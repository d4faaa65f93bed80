import os

import pytest
from pyspark.sql import types as T

SF_SMALL = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"

#: Columns of documents and others with names that operators use themselves.
SCHEMA = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
    T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType()), T.StructField("kept", T.StringType()),
    T.StructField("size", T.DoubleType()), T.StructField("row", T.LongType()), T.StructField("text_hash", T.StringType()),
    T.StructField("label", T.LongType()), T.StructField("held_out", T.StringType()), T.StructField("rank", T.StringType())])

WORDS = "the quick brown fox jumps over a lazy dog while seven wizards box bright quartz jugs near old vex lymph".split()


def prose(n, step=1):
    return " ".join(WORDS[(k * step + k // 7) % len(WORDS)] + str(k % 11) * (k % 3 == 0) for k in range(n))


ROWS = [
    (1, "Hello World, this is a first small text", "en", "a", 1),
    (2, "hello world, THIS is a first small text", "en", "a", 2),
    (3, None, None, None, None),
    (4, "", "en", None, 0),
    (5, " \n\t ", None, "b", 0),
    (6, prose(300), "en", "b", 5),
    (6, prose(300), "en", "b", 5),
    (7, prose(299) + " changed", "en", "", 5),
    (8, prose(40, 3), "fr", "é", 5),
    (None, prose(40, 3), "fr", "é", 5),
    (None, "no id", None, None, None),
    (9, prose(6000, 5), "de", "long", 5),
    (10, "x" * 30000, "de", "long", 5),
    (11, "1" * 5000 + " " + "a." * 3000 + "@", "es", "a", 5),
    (12, "日本語 テキスト Ünïcode ǅ İ ﬁ <|endoftext|> don't\x1c stop", "es", "a", 5),
    (13, "one two", "en", "a", 5),
    (14, "one two", "en", "c", 5),
    (15, "word " * 400, "en", "c", 5),
    (16, "mail a.b@c.example.org or 10.0.0.256 and 1.2.3.4, +1 (555) 010-9999; 4111 1111 1111 1111", "en", "c", 5),
]


@pytest.fixture(scope="session")
def odd(spark):
    """Nulls in every column, empty and long texts, ties, repeated rows and
    extra columns with clashing names."""
    rows = [(*r, "k", 0.5, 1, "h", None, "x", None) for r in ROWS]
    return spark.createDataFrame(rows, SCHEMA).repartition(3, "n_chars")


@pytest.fixture(scope="session")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def vocabularies():
    folder = os.environ.get("PUBLIC_TOKENIZERS", "/opt/tokenizers")
    if not os.path.isdir(folder):
        pytest.skip("no tokenizer files")
    return folder


def table(spark, sf_dir, name):
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
