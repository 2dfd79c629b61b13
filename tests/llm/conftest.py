import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, ROOT)

SF = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def documents(spark):
    """A factory of documents; extra columns clash with names that the operators use inside."""
    def make(rows, extra=False):
        rows = [(i, t, "en", s, None) for i, t, s in (r if len(r) == 3 else (*r, "s") for r in rows)]
        df = spark.createDataFrame(rows, DOCS)
        if extra:
            from pyspark.sql import functions as F
            for c in ("id", "key", "size", "block", "h", "label", "score", "n_words", "matches", "root", "segment", "part", "fold"):
                df = df.withColumn(c, F.lit("x"))
        return df
    return make
