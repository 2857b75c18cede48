import os
import sys

import pytest

HERE = os.path.dirname(os.path.abspath(__file__))
sys.path[:0] = [os.path.dirname(os.path.dirname(HERE)), HERE]

DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture
def documents(spark):
    """A documents table from (doc_id, text) or (doc_id, text, source) rows."""

    def make(rows):
        full = [(r[0], r[1], "en", r[2] if len(r) > 2 else "src0", len(r[1]) if r[1] is not None else None) for r in rows]
        return spark.createDataFrame(full, DOCUMENTS)

    return make


@pytest.fixture(scope="session")
def sf():
    return "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def tokenizer():
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")
