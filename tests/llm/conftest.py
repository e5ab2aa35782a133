import pytest
from pyspark.sql import types as T

#: The columns of ``documents`` and two whose names the operators also use inside.
SCHEMA = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
    T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType()),
    T.StructField("size", T.StringType()), T.StructField("row", T.IntegerType())])


@pytest.fixture()
def frame(spark):
    """A documents table from (doc_id, text[, source]) rows."""
    def make(rows):
        full = [(r[0], r[1], "en", r[2] if len(r) > 2 else "s", None if r[1] is None else len(r[1]), "x", 1) for r in rows]
        return spark.createDataFrame(full, SCHEMA).repartition(3)
    return make


LONG = " ".join(f"w{i % 977}x{i % 13}" for i in range(30_000))
#: Nulls, empties, white space, ties, repeated rows, a very long text and its near copy.
ODD = [(None, None, None), (None, "a b", "s1"), (1, "", "s1"), (1, "", "s1"), (2, " \t\n ", None), (3, "one", "s2"),
       (4, "one", "s3"), (5, LONG, "s2"), (6, LONG + " end", "s2"), (7, LONG, "s3"), (7, "one", "s3"), (8, None, "s4"),
       (9, "é中\U0001f600 x", "s4"), (-3, "one two\nthree four five\n", "s1")]
