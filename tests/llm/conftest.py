import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
SF = "/root/testdata/sf0.001"


@pytest.fixture
def docs(spark):
    """A documents table of (doc_id, text) or (doc_id, text, source)."""

    def make(rows, more=""):
        full = [(r[0], r[1], "en", r[2] if len(r) > 2 else "a", len(r[1]) if r[1] is not None else None, *r[3:]) for r in rows]
        return spark.createDataFrame(full, DOCS + more)

    return make


@pytest.fixture(scope="session")
def corpus(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")
