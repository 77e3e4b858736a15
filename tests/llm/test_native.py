"""Operators that are to run on DataFrame functions alone: no plan of theirs, stored tables included, starts a Python worker."""

from __future__ import annotations

import re

import pytest

from cohortlens.llm import chat, decontam, mixing, queries

SF = "/root/testdata/sf0.001"
PYTHON = re.compile(r"\b(\w*Python\w*|\w*MapIn\w+|\w*InPandas\w*|\w*Arrow\w*)\b")


def nodes(df) -> list[str]:
    return PYTHON.findall(df._jdf.queryExecution().executedPlan().toString())


@pytest.mark.parametrize("module, query", [(chat, "op2_chat"), (mixing, "op4_mix"), (decontam, "op7_decontaminate")])
def test_no_python_worker(spark, monkeypatch, module, query):
    found, plans = [], 0
    store = getattr(module, "materialise", None)

    def seen(df, *rest, **named):
        nonlocal plans
        plans += 1
        found.extend(nodes(df))
        return store(df, *rest, **named)

    if store is not None:
        monkeypatch.setattr(module, "materialise", seen)
    found += nodes(getattr(queries, query)(spark, SF))
    assert found == [] and (store is None or plans)


def test_the_audit_sees_python(spark):
    assert nodes(queries.op3_quality(spark, SF))
