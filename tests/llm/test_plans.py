"""Whole plans of the registered queries, with those of every table written on the way."""

from __future__ import annotations

import pytest

from drapekit.llm.queries import QUERIES
from tests.test_plans import FORBIDDEN, recorded

SF001 = "/root/testdata/sf0.001"
#: fixed values: operators whose main path is built-in column functions
NATIVE = ("op4_license_scan", "op5_chat_formatting", "op13_order_minhash")


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_cross_joins_and_no_python_on_native_paths(spark, monkeypatch, name):
    plans = recorded(monkeypatch)
    plans.append(QUERIES[name](spark, SF001)._jdf.queryExecution().executedPlan().toString())
    for plan in plans:
        assert not any(node in plan for node in FORBIDDEN), plan
        assert name not in NATIVE or not any(word in plan for word in ("Python", "Pandas", "Arrow")), plan
