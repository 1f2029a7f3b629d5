import os

import pytest

SF = "/root/testdata/sf0.001"


@pytest.fixture
def docs(spark):
    """Rows -> a documents-shaped frame, in several partitions."""
    schema = "doc_id long, text string, lang string, source string, n_chars long"

    def make(texts, source="s0", extra=None):
        rows = [(i, t, "en", source, len(t or "")) if not isinstance(t, tuple) else t for i, t in enumerate(texts)]
        return spark.createDataFrame(rows, schema).repartition(3)

    return make


@pytest.fixture
def sf():
    if not os.path.exists(SF):
        pytest.skip("driver test data not present")
    return SF
