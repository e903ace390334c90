import pytest

DOC_SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"

# Null, empty, blank and symbol texts, one word, exact copies, ties, repeated
# rows, an added token's string, Unicode spaces and contractions.
EDGE_TEXTS = [None, "", " \t\n", "### $$$", "word", "word", "it's we'll  don't\n\nx 's!'s",
              "a<|endoftext|>b <|endoftext|> <|end", "　wide space line  ",
              "náive \U0001f600 中文 12² été"]


@pytest.fixture(scope="session")
def docs_of(spark):
    """Documents from a list of texts, or of (doc_id, text) pairs, with extra
    columns whose names clash with those the operators make."""
    def make(texts):
        rows = [t if isinstance(t, tuple) else (k, t) for k, t in enumerate(texts)]
        df = spark.createDataFrame([(i, t, None, None, None) for i, t in rows], DOC_SCHEMA)
        return df.selectExpr("*", "'x' AS component_id", "1 AS kept", "2 AS n_tokens",
                             "'y' AS key", "3 AS score", "'z' AS length")
    return make


@pytest.fixture(scope="session")
def small_docs(spark):
    from covtab.session import ship_package
    ship_package(spark)
    return spark.read.parquet("/root/testdata/sf0.001/documents.parquet")

SF01 = "/root/testdata/sf0.01"
