from __future__ import annotations

import contextlib
import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from quarry.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    s = build_session("local[4]", "quarry-tests", {"spark.sql.shuffle.partitions": "4"})
    yield s
    s.stop()


@pytest.fixture
def write_text(tmp_path):
    """Write lines (no trailing newline unless given) to a fresh file; return its path."""
    counter = {"n": 0}

    def _write(content: str, name: str | None = None) -> str:
        counter["n"] += 1
        p = tmp_path / (name or f"f{counter['n']}.txt")
        p.write_text(content)
        return str(p)

    return _write


def rows(df, *cols):
    """Sorted list of tuples (order-insensitive comparisons)."""
    cols = cols or tuple(df.columns)
    got = [tuple(r[c] for c in cols) for r in df.collect()]
    return sorted(got, key=lambda t: tuple((v is not None, v) for v in t))


@contextlib.contextmanager
def conf(spark, **kv):
    keys = {k.replace("__", "."): v for k, v in kv.items()}
    old = {k: spark.conf.get(k, None) for k in keys}
    for k, v in keys.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def local_dir(path: str) -> str:
    """Plain file-system path of a ``file:`` URI (tests inspect local files)."""
    for prefix in ("file://", "file:"):
        if path.startswith(prefix):
            return path[len(prefix):]
    return path
