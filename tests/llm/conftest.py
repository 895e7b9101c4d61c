from __future__ import annotations

import pytest

from signalbase.llm.common import ship

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def shipped(spark):
    """The session, with this package sent to its workers."""
    ship(spark)
    return spark


@pytest.fixture
def docs(shipped):
    """Make a documents table from (doc_id, text, lang, source), with further columns that clash with inner names."""
    from pyspark.sql import functions as F

    def make(rows):
        table = shipped.createDataFrame([(*r, None) for r in rows], DOCS).repartition(3)
        clash = ("fp", "key", "size", "anchor", "part", "queue", "block", "declared", "copies", "_row", "_id", "hash")
        return table.withColumns({c: F.lit("x") for c in clash})
    return make
