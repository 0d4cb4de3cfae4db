import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint, `__row` string, `row` string, score string"


@pytest.fixture(scope="session")
def docs_of(spark):
    """Documents from texts (or (doc_id, text) pairs), with further columns whose names helpers use too."""
    def make(rows, lang="en", source="s"):
        rows = [(i, r) if not isinstance(r, tuple) else r for i, r in enumerate(rows)]
        return spark.createDataFrame([(i, t, lang, source, len(t or ""), "x", "y", "z") for i, t in rows], DOCS)
    return make
