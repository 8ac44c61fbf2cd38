"""The entry without the corpus operators."""

import sys

import pytest

import __spark_entry__ as entry
from tidewise.plans.oracle import ORACLE
from tidewise.plans.queries import QUERIES


def test_core_queries_stay_when_the_corpus_operators_cannot_be_imported(monkeypatch):
    monkeypatch.setitem(sys.modules, "public_tokenizers", None)
    for name in [n for n in sys.modules if n.startswith("tidewise.llm") or n == "corpus_pipeline"]:
        monkeypatch.delitem(sys.modules, name)
    with pytest.warns(UserWarning, match="left out"):
        assert set(entry.queries()) == set(QUERIES)
    with pytest.warns(UserWarning, match="left out"):
        assert set(entry.oracle_sql()) == set(ORACLE)
