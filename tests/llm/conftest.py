import os

import pytest

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def sf():
    return SF


@pytest.fixture
def frame(spark):
    """Rows as documents with extra columns whose names clash with those of the operators."""
    def make(rows, extra=True):
        schema = "doc_id long, text string, lang string, source string, n_chars long"
        rows = [(i, t, "en", "s", len(t) if t is not None else None) for i, t in rows]
        df = spark.createDataFrame(rows, schema)
        if extra:
            from pyspark.sql import functions as F
            for name in ("n_words", "hits", "score", "kept", "shard", "slot", "spans", "body", "_text"):
                df = df.withColumn(name, F.lit("clash"))
        return df
    return make


@pytest.fixture(scope="session")
def tokenizer():
    P = pytest.importorskip("public_tokenizers")
    return P.path("word_bpe_49k.json")


@pytest.fixture(scope="session")
def vocabulary():
    P = pytest.importorskip("public_tokenizers")
    return P.path("byte_bpe_50k.tiktoken")


os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
