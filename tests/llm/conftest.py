import pytest


@pytest.fixture
def docs_of(spark):
    """A documents table of (doc_id, text) pairs, with columns whose names clash with inner ones."""

    def make(pairs, schema="doc_id long, text string, digest string, content int, rank int, cell int, shard string, block int, label string"):
        names = schema.split(", ")
        return spark.createDataFrame([(i, t, *[None] * (len(names) - 2)) for i, t in pairs], schema).repartition(3)

    return make
