from __future__ import annotations

import os
import sys
import uuid

import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))


@pytest.fixture()
def make_docs(spark):
    """A documents frame from (doc_id, text) pairs, with clashing extra columns."""

    def make(rows, partitions=3):
        schema = "doc_id long, text string, lang string, source string, n_chars long, seed string, start long"
        full = [(i, t, "en", "src", None if t is None else len(t), "x", 7) for i, t in rows]
        return spark.createDataFrame(full, schema).repartition(partitions)

    return make


@pytest.fixture()
def folder(tmp_path):
    return str(tmp_path / uuid.uuid4().hex)
