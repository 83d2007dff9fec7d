import pytest
from pyspark.sql import types as T

DOCS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
                     T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType())])
# names that the operators use inside
CLASHING = ["id", "row", "n_rows", "size", "word", "node", "root", "part", "at", "cell", "sha1", "copies", "tk", "line", "bucket"]


@pytest.fixture(scope="session")
def make_docs(spark):
    """(id, text) pairs or full rows -> documents."""
    def make(rows, clashing=False):
        full = [r if len(r) == 5 else (r[0], r[1], "en", "src1", None if r[1] is None else len(r[1])) for r in rows]
        df = spark.createDataFrame(full, DOCS).repartition(2)
        if clashing:
            for c in CLASHING:
                df = df.withColumn(c, df["text"])
        return df
    return make


#: nulls, empty and blank texts, ties, repeated rows, a very long text, odd characters
EDGE = [
    (1, None), (2, ""), (3, " \n\t "), (4, "one"), (5, "one"), (5, "one"), (6, "a b c d e f g"), (7, "a b c d e f g"), (8, "a b c d e f g h"),
    (9, "é ü 漢字 \x00 ▁ ▁x <|endoftext|> <s>"), (10, "x" * 200_000), (11, "long words " * 20_000), (12, "long words " * 20_000),
    (None, "no id at all"), (13, "a\nb\n\na\nb\r\n c"), (14, "A B C D E F G"),
]
