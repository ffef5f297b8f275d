"""Helpers for the operators' tests; the session is that of the whole suite."""

from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[2]))

from shopmart.llm.common import ship  # noqa: E402

TINY = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def llm(spark):
    """A session whose workers can import the package."""
    ship(spark)
    return spark


@pytest.fixture(scope="session")
def tiny_docs(llm):
    return llm.read.parquet(f"{TINY}/documents.parquet")


@pytest.fixture()
def odd_docs(llm):
    """Nulls, empty, repeated and very long texts, and columns that clash with inner names."""
    long_text = " ".join(f"w{k}" for k in range(30_000))
    rows = [
        (1, None, "x", 1),
        (2, "", None, 2),
        (3, "   \n\t ", "x", 3),
        (4, "one", "x", 4),
        (5, "one two three four five six", "x", 5),
        (5, "one two three four five six", "x", 5),
        (6, long_text, "x", 6),
        (7, "Ünïcode 日本語 \U0001f642 " * 5, "x", 7),
        (None, "no id here", "x", 8),
    ]
    return llm.createDataFrame(rows, "doc_id long, text string, id string, n long")


@pytest.fixture()
def no_docs(llm):
    return llm.createDataFrame([], "doc_id long, text string, lang string, source string")
