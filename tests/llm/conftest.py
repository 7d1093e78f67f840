import pytest
from pyspark.sql import types as T

DOCS = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
    T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType())])

# Names that operators use inside or return; an input may have them too.
CLASHES = ("fp", "kept", "N_Words", "_row", "_th", "pieces", "leaks", "score", "id", "h")


def make_docs(spark, rows, clashing=False):
    """rows: (doc_id, text, lang, source), in two partitions."""
    data = [(i, t, lang, s, None if t is None else len(t)) for i, t, lang, s in rows]
    df = spark.createDataFrame(data, DOCS).repartition(2)
    if clashing:
        for c in CLASHES:
            df = df.selectExpr("*", f"concat('{c}', doc_id) as `{c}`")
    return df


@pytest.fixture(scope="session")
def odd_rows():
    """Nulls in every column, empty and wordless texts, repeated rows, ties, a long text."""
    long = " ".join(f"w{k % 977}x{k}" for k in range(30_000))
    return [
        (1, "the same words stand here again and again for every one of us to read at ease today ok then bye now", "en", "a"),
        (1, "the same words stand here again and again for every one of us to read at ease today ok then bye now", "en", "a"),
        (2, "the same words stand here again and again for every one of us to read at ease today ok then bye now", "en", "b"),
        (3, None, "en", "a"), (4, "", "de", "a"), (5, " \n\t ", None, "b"), (6, "x", "en", None),
        (None, "text without an id stands here", "en", "c"), (None, None, None, None),
        (7, long, "en", "a"), (8, "é 漢字 🙂 ▁   x", "fr", "c"), (8, "another text of the same id", "en", "c"),
    ]


@pytest.fixture()
def sf_copy(spark, tmp_path):
    """Writes tables to a folder of their own and returns its path."""
    def put(**tables):
        for name, df in tables.items():
            df.write.parquet(str(tmp_path / f"{name}.parquet"))
        return str(tmp_path)
    return put
