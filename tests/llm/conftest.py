import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from llm_cases import DOCS, sentence  # noqa: E402


@pytest.fixture(scope="session")
def edge_rows():
    """Nulls in every column, empty and long texts, ties and repeated rows."""
    base = [(i, sentence(i), "en" if i % 2 else "fr", f"s{i % 3}", 5) for i in range(1, 25)]
    near = sentence(3).split()
    near[20] = "changed"
    return base + [
        (None, sentence(5), "en", "s0", 1), (None, None, None, None, None), (30, None, "en", None, None), (31, "", "fr", "s1", 0),
        (32, sentence(3).upper(), "en", "s0", 1), (33, sentence(3, 400), None, "s0", 1), (34, " ".join(near * 12), "en", "s2", 1),
        (35, sentence(3, 399), "en", "s2", 1), (36, "ab " * 60000, "en", "s0", 1), (36, "ab " * 60000, "en", "s0", 1),
        (37, "1234 5678 !!", "en", "s0", 1), (38, "Ünïcode ßtraße 中文 😀 ▁ x", "de", "s9", 1), (39, sentence(7), "en", "s0", 1), (40, "one two", "en", "s1", 1),
        (41, "one two", "fr", "s1", 1),
    ]


@pytest.fixture(scope="session")
def edge_docs(spark, edge_rows):
    """The edge rows with columns that clash with names the operators use."""
    from pyspark.sql import functions as F
    docs = spark.createDataFrame(edge_rows, DOCS)
    for name in ("shard", "slot", "digest", "keep_id", "key", "sid", "rate", "copies", "score", "lang_pred", "p", "n", "unit", "part", "row", "ids"):
        docs = docs.withColumn(name, F.lit("clash"))
    return docs


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], DOCS)
