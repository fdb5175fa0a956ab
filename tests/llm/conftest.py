import pytest

from vaultshift.llm.common import Scratch

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture
def scratch(spark):
    return Scratch(spark, "test")


@pytest.fixture
def make_docs(spark):
    """Documents from (id, text) or (id, text, lang, source) tuples."""
    def make(rows, extra=False):
        full = [(*r, *[None] * (4 - len(r)), None if r[1] is None else len(r[1])) for r in rows]
        df = spark.createDataFrame(full, DOCS)
        if extra:  # names that operators use for their own columns
            from pyspark.sql import functions as F
            df = df.withColumns({c: F.lit("x") for c in ("score", "class_id", "rep", "size", "key", "n", "bucket", "found", "h", "words", "target")})
        return df
    return make
