"""Every operator that a query's label names is really called by the query.

Each library function says in its docstring which operators it is; while a
query runs, the functions it calls are noted, and the label must be covered by
their docstrings. Column expressions without a function of their own (written
in the query) are named in the query's own docstring or listed below.
"""

import re
import sys

import pytest

from ragloom.plans.registry import load_all

SF = "/root/testdata/sf0.001"
OP = re.compile(r"\b(?:SRC|SNK|FIL|JON|AGG|WIN|SRT|SET|FUN|TXT|RET|LLM|ML|GRA|STR|UDF)\d+\b")
# slow fits; their parts are labelled on other queries too
SLOW = {"credit_models", "kmeans_segments", "semantic_cache_candidates", "semantic_cache_sequential", "semantic_cache_stream"}


def _ops(text):
    found = set(OP.findall(text or ""))
    for kind, a, b in re.findall(r"\b([A-Z]{2,3})(\d+)\s*-\s*(?:[A-Z]{2,3})?(\d+)\b", text or ""):  # ML6-ML8
        found |= {f"{kind}{i}" for i in range(int(a), int(b) + 1)}
    return found


def called_ops(fn, spark):
    codes = set()

    def note(frame, event, _):
        if event == "call" and "/ragloom/" in frame.f_code.co_filename:
            codes.add((frame.f_globals.get("__name__"), frame.f_code.co_qualname))

    sys.setprofile(note)
    try:
        fn(spark, SF)
    finally:
        sys.setprofile(None)
    out = set()
    for module, name in codes:
        obj = sys.modules.get(module)
        for part in name.split("."):
            obj = getattr(obj, part, None) if obj is not None else None
        if obj is not None and not module.endswith("registry"):
            out |= _ops(getattr(obj, "__doc__", None))
    return out


@pytest.mark.parametrize("name", [n for n in load_all() if n not in SLOW])
def test_label(spark, name):
    r = load_all()[name]
    assert _ops(r.ops) <= called_ops(r.fn, spark), _ops(r.ops) - called_ops(r.fn, spark)
