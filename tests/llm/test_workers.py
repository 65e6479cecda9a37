"""Python workers find the package wherever the driver runs."""

from __future__ import annotations

import os
import subprocess
import sys

from tests.llm.helpers import SF

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def test_queries_run_from_another_folder(tmp_path):
    code = (
        f"import sys; sys.path.insert(0, {ROOT!r})\n"
        "from pyspark.sql import SparkSession\n"
        "spark = SparkSession.builder.master('local[2]').config('spark.ui.enabled', 'false')"
        ".getOrCreate()\n"
        "import __spark_entry__ as e\n"
        f"for n in ('op5_chat_format', 'op6_token_counts'):\n"
        f"    print('ROWS', e.queries()[n](spark, {SF!r}).count())\n"
    )
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    out = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env=env, text=True,
                         capture_output=True, timeout=300)
    assert out.stdout.count("ROWS") == 2, out.stderr[-2000:]
