from __future__ import annotations

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from corpus_cases import frame, odd_texts  # noqa: E402


@pytest.fixture(scope="session")
def odd(spark):
    """Nulls, empty and very long texts, ties, repeated rows and clashing column names."""
    texts = odd_texts()
    ids = [*range(len(texts) - 2), None, len(texts) - 1]
    both = frame(spark, texts, ids)
    return both.unionByName(both.where("doc_id in (4, 7)"))


@pytest.fixture(scope="session")
def none(spark):
    return frame(spark, []).where("1 = 0")


@pytest.fixture(scope="session")
def documents(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/documents.parquet")
