import zlib

import pytest


@pytest.fixture(scope="session")
def docs_of(spark):
    """docs_of([(doc_id, text), ...]) with the columns of documents."""

    def make(rows, lang="en"):
        return spark.createDataFrame([(i, t, lang, "s", len(t) if t is not None else None) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")

    return make


@pytest.fixture(scope="session")
def fold():
    return lambda doc_id, modulus: zlib.crc32(str(doc_id).encode()) % modulus
