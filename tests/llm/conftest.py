from __future__ import annotations

import os
from pathlib import Path

import pytest
from pyspark.sql import types as T

# Python workers import the operators' module.
ROOT = str(Path(__file__).resolve().parents[2])
os.environ["PYTHONPATH"] = os.pathsep.join(filter(None, [ROOT, os.environ.get("PYTHONPATH")]))

#: Columns that operators use names like inside.
EXTRA = "size bigint, hash_1 bigint, fingerprint string, document string, plan string, probed string"
EXTRA_VALUES = (1, 2, "f", "d", "p", "q")
DOCUMENTS = "doc_id bigint, text string, lang string, source string, n_chars bigint"


@pytest.fixture(scope="session")
def documents(spark):
    """Makes a documents table with extra columns from texts, or from (doc_id, text, source)."""

    def make(rows, partitions: int = 3):
        full = []
        for number, row in enumerate(rows):
            doc_id, text, source = row if isinstance(row, tuple) else (number, row, "web")
            full.append((doc_id, text, "en", source, len(text or ""), *EXTRA_VALUES))
        schema = T._parse_datatype_string(f"{DOCUMENTS}, {EXTRA}")
        return spark.createDataFrame(full, schema).repartition(partitions)

    return make


@pytest.fixture
def edge_texts():
    """Null, empty, blank, one word, ties and repeated rows, and very long texts."""
    long_text = " ".join(f"word{i % 977} stands, here\n" for i in range(20_000))
    return [None, "", " \n\t ", "one", "same text", "same text", "é ß 漢字 🙂", long_text, "x" * 150_000]
