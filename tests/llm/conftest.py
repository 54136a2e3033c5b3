import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars int"


@pytest.fixture
def documents(spark):
    """Documents from (doc_id, text) or (doc_id, text, source) rows, with columns whose names the operators use inside."""
    def make(rows):
        full = [(r[0], r[1], "en", r[2] if len(r) > 2 else "src0", 0) for r in rows]
        df = spark.createDataFrame(full, DOCUMENTS)
        for name in ("row", "node", "key", "size", "n", "words", "component", "score", "label"):
            df = df.selectExpr("*", f"'x' AS `{name}`")
        return df
    return make
