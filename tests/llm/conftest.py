import sys
from pathlib import Path

import pytest

sys.path[:0] = [str(Path(__file__).resolve().parents[2]), str(Path(__file__).resolve().parents[1])]

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def make_docs(spark):
    """Documents from texts, or from (doc_id, text) pairs."""

    def make(texts, lang="en"):
        rows = [t if isinstance(t, tuple) else (i, t) for i, t in enumerate(texts)]
        return spark.createDataFrame([(i, t, lang, "s", len(t or "")) for i, t in rows], DOCS)

    return make


@pytest.fixture(scope="session")
def folder():
    return "/root/testdata/sf0.001"
