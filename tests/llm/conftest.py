"""Small tables with every awkward case, for all operators of a training-data pipeline."""

import pytest
from pyspark.sql import types as T

DOCUMENTS = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("n_chars", T.LongType()),
        # Names that operators use for results of their own.
        T.StructField("n_words", T.StringType()),
        T.StructField("score", T.StringType()),
        T.StructField("kept", T.StringType()),
        T.StructField("fingerprint", T.StringType()),
        T.StructField("starts", T.StringType()),
        T.StructField("_copy", T.StringType()),
    ]
)

PASSAGE = " ".join(f"shared{k}" for k in range(60))


def texts():
    """(doc_id, text) with null ids, null, empty, blank and long texts, and repeats."""
    long = " ".join(f"w{k % 977}x{k}" for k in range(6000))
    return [
        (1, "one two three four five six seven eight nine ten eleven"),
        (2, f"before {PASSAGE} behind it"),
        (3, f"other words\tahead\n{PASSAGE}  and  more"),
        (3, f"other words\tahead\n{PASSAGE}  and  more"),  # the same row twice
        (3, "the same id with another text of eight words"),
        (None, f"without id {PASSAGE}"),
        (None, None),
        (4, None),
        (5, ""),
        (6, " \n\t "),
        (7, "12 34 !!"),
        (8, long),
        (9, long + " end"),
        (10, "Ünïcödé Straße ΣΊΣΥΦΟΣ 漢字 🙂 é <|endoftext|> İ"),
        (11, "x" * 5000),
        (12, "a b\x1cc d\x0be"),
        (13, "###$$$ %%% ||| <<< >>> a b c d e f g h"),
        (14, "same line here\nsame line here\nsame line here\nsame line here"),
    ]


def rows(pairs):
    return [(i, t, "en" if i is None or i % 2 else "fr", None if i == 7 else "host", 0, *"abcdef") for i, t in pairs]


@pytest.fixture(scope="session")
def awkward(spark):
    return spark.createDataFrame(rows(texts()), DOCUMENTS)


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], DOCUMENTS)
