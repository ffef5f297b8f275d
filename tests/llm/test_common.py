"""Shared helpers, and the rules that hold for all operators."""

from __future__ import annotations

import re
from pathlib import Path

import pytest

from shopmart.llm import common, queries

PACKAGE = Path(common.__file__).parent


def test_lookup_of_hot_and_other_keys(llm, monkeypatch):
    monkeypatch.setattr(common, "HOT_SHARE", 10)
    many = llm.range(1000).selectExpr("case when id % 3 = 0 then 'hot' else concat('k', id % 50) end as key", "id")
    one = many.groupBy("key").count().selectExpr("key", "count as n", "upper(key) as found")
    joined = common.lookup(many.where("key <> 'k1'"), one, "key", "n")
    assert joined.columns == ["key", "id", "found"]
    rows = joined.collect()
    assert len(rows) == many.where("key <> 'k1'").count() and all(r.found == r.key.upper() for r in rows)
    assert common.lookup(many.limit(0), one.limit(0), "key", "n").count() == 0


def test_folders_are_shared_and_new(llm):
    folder = common.shared_folder(llm)
    assert folder == llm.conf.get("spark.checkpoint.dir").rstrip("/") and "://" in folder or folder
    assert common.new_folder(llm, "x") != common.new_folder(llm, "x")
    table = common.stored(llm.range(5), "t")
    assert table.count() == 5 and "Range" not in table._jdf.queryExecution().toString()


def test_one_query_for_each_operator():
    numbers = [int(re.match(r"op(\d+)_", name)[1]) for name in queries.queries()]
    assert sorted(numbers) == list(range(1, 14))


@pytest.mark.parametrize("source", sorted(PACKAGE.glob("*.py")), ids=lambda p: p.name)
def test_no_local_checkpoints_or_swallowed_imports(source):
    text = source.read_text()
    assert "localCheckpoint(" not in text and "except ImportError" not in text


def test_nothing_else_imports_the_subpackage():
    outside = [p for p in PACKAGE.parent.rglob("*.py") if PACKAGE not in p.parents]
    assert not [p for p in outside if "shopmart.llm" in p.read_text()]
