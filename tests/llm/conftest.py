import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

DOC_SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture()
def make_docs(spark):
    """documents from (doc_id, text[, lang, source]) rows."""
    def make(rows, extra=False):
        full = [(r[0], r[1], r[2] if len(r) > 2 else "en", r[3] if len(r) > 3 else "s", len(r[1] or "")) for r in rows]
        df = spark.createDataFrame(full, DOC_SCHEMA)
        if extra:
            from pyspark.sql import functions as F
            for name in ("size", "rank", "p", "key", "h", "n", "hash", "id", "label", "score", "start"):
                df = df.withColumn(name, F.lit("clash"))
        return df
    return make
