import pytest
from pyspark.sql import types as T

CLASHING = ["n_words", "kept", "spans", "key", "rep", "host", "size", "target", "score", "label", "sketch", "text_key", "component"]


@pytest.fixture(scope="session")
def make_docs(spark):
    """documents from (doc_id, text, source) rows, with extra columns whose names clash."""
    schema = T.StructType(
        [T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
         T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType())]
        + [T.StructField(c, T.StringType()) for c in CLASHING]
    )

    def make(rows):
        return spark.createDataFrame([(i, t, None, s, None if t is None else len(t), *("x" for _ in CLASHING)) for i, t, s in rows], schema)

    return make


LONG = "lorem ipsum dolor sit amet consectetur " * 3000
#: Nulls, empties, blanks, one very long word, very long text, copies, repeated rows.
ODD = [
    (1, None, "a"),
    (2, "", "a"),
    (3, " \t\n\r ", None),
    (4, "a b c", "b"),
    (5, "x" * 20_000, "b"),
    (6, LONG, "c"),
    (7, LONG, "c"),
    (7, LONG, "c"),
    (8, "one two three four five six seven eight nine ten eleven\none two three four five six seven eight nine ten eleven", None),
    (None, "some words without an id and more of them to be long enough for rules", "a"),
    (None, None, None),
    (9, "é😀 ñandú 　 中文 \x00 <|endoftext|> '' 've", "d"),
]


@pytest.fixture(scope="session")
def odd(make_docs):
    return make_docs(ODD)
