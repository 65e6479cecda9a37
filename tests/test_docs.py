"""The documentation stays in step with the code."""

from __future__ import annotations

import importlib
import os
import re

from quarry.plans.catalog import QUERIES

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def _read(name: str) -> str:
    with open(os.path.join(ROOT, name)) as f:
        return f.read()


def test_readme_lists_every_registered_query():
    readme = _read("README.md")
    table = readme[readme.index("## Registered queries"):readme.index("The jobs are mapped")]
    listed = set(re.findall(r"`([a-z_]+)`", table)) - {"queries", "oracle_sql"}
    assert listed == set(QUERIES)


def test_coverage_references_exist():
    cov = _read("COVERAGE.md")
    missing = []
    for ref in re.findall(r"`((?:sources|operators|plans|streaming|functions|sinks)\.[\w.]+)`", cov):
        parts = ref.split(".")
        for i in range(len(parts), 0, -1):
            try:
                obj = importlib.import_module("quarry." + ".".join(parts[:i]))
                break
            except ImportError:
                continue
        for attr in parts[i:]:
            if not hasattr(obj, attr):
                missing.append(ref)
                break
            obj = getattr(obj, attr)
    assert not missing
    tests = {}
    for f in os.listdir(os.path.join(ROOT, "tests")):
        if f.startswith("test_") and f.endswith(".py"):
            tests[f[:-3]] = set(re.findall(r"^def (test_\w+)", _read(os.path.join("tests", f)), re.M))
    for mod, fn in re.findall(r"`(test_\w+)::(test_\w+)`", cov):
        assert fn in tests.get(mod, set()), f"{mod}::{fn}"


def test_every_registered_query_is_mapped_in_coverage():
    cov = _read("COVERAGE.md")
    named = set(re.findall(r"`([a-z_]+)`", cov))
    unmapped = [k for k in QUERIES if k not in named and not k.startswith("stream_")]
    assert not unmapped
