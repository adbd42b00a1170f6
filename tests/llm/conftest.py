import pytest
from pyspark.sql import types as T

DOCUMENTS = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("n_chars", T.LongType()),
    ]
)

LONG = " ".join(f"word{i % 977} the{i % 13}" for i in range(15_000))

ODD_ROWS = [
    (1, "The cat sat on the mat and looked at the very quiet garden outside.", "en", "a"),
    (2, "The cat sat on the mat and looked at the very quiet garden outside.", "en", "a"),
    (2, "The cat sat on the mat and looked at the very quiet garden outside.", "en", "a"),
    (3, None, "en", "a"),
    (4, "", None, "b"),
    (5, " \t\n ", "en", None),
    (6, "1234 5678 !!", "de", "b"),
    (7, LONG, "en", "b"),
    (None, "Eine Katze ohne Nummer sitzt heute ganz allein im Garten herum.", "de", None),
    (9, "zwei Worte", "de", "b"),
    (-5, "Ünïcödé \U0001f600 <|endoftext|> text\x0bwith\x1codd　spaces", "xx", "c"),
]


def rows(spark, values):
    return spark.createDataFrame([(*v, len(v[1]) if v[1] is not None else None) for v in values], DOCUMENTS)


@pytest.fixture(scope="session")
def odd(spark):
    return rows(spark, ODD_ROWS)


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], DOCUMENTS)


@pytest.fixture(scope="session")
def documents(spark):
    return spark.read.parquet("/root/testdata/sf0.001/documents.parquet")


@pytest.fixture(scope="session")
def wide(odd):
    """Extra columns named like those that operators make."""
    from pyspark.sql import functions as F

    names = "keys label size block shard slot score ids row copies draw words _key _copy _spans component_id lang_pred turn epoch n_tokens range part".split()
    return odd.withColumns({name: F.lit(7) for name in names})
