"""Scratch-folder rules, checked with stand-in session objects (no cluster)."""

from __future__ import annotations

import os
import subprocess
import sys

import pytest

from pyspark.errors import PySparkAttributeError

from quarry.session import (
    build_session, ensure_checkpoint_dir, make_folder, scratch, scratch_path,
)
from tests.conftest import conf, local_dir


ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


class _Conf(dict):
    def get(self, key, default=None):  # noqa: D401 - mimics RuntimeConfig.get
        return super().get(key, default)


class _Context:
    def __init__(self, master, checkpoint=None):
        self.master = master
        self._ckpt = checkpoint
        self.defaultParallelism = 64

    def getCheckpointDir(self):
        return self._ckpt

    def setCheckpointDir(self, d):
        self._ckpt = d + "/uuid"

    def getConf(self):
        return _Conf()


class _Session:
    def __init__(self, context=None, **conf):
        self._ctx = context
        self.conf = _Conf(conf)

    @property
    def sparkContext(self):
        if self._ctx is None:
            raise PySparkAttributeError("no context (Spark Connect)")
        return self._ctx


def test_configured_folder_is_used():
    s = _Session(_Context("spark://m:7077"), **{"spark.checkpoint.dir": "hdfs:///shared/ckpt"})
    assert ensure_checkpoint_dir(s) == "hdfs:///shared/ckpt/uuid"
    assert scratch_path(s, "x").startswith("hdfs:///shared/ckpt/uuid/quarry/x-")


def test_cluster_without_folder_refuses():
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        ensure_checkpoint_dir(_Session(_Context("yarn")))


def test_local_without_folder_gets_a_temporary_one():
    d = ensure_checkpoint_dir(_Session(_Context("local[2]")))
    assert d.endswith("/uuid") and "quarry-ckpt-" in d


def test_session_without_context():
    s = _Session(None, **{"spark.checkpoint.dir": "s3a://bucket/ckpt", "spark.default.parallelism": "16"})
    assert ensure_checkpoint_dir(s) == "s3a://bucket/ckpt"
    with pytest.raises(RuntimeError):
        ensure_checkpoint_dir(_Session(None, **{"spark.master": "k8s://x"}))


def test_settings_of_the_active_session_win(spark):
    with conf(spark, spark__sql__shuffle__partitions="37",
              spark__sql__adaptive__advisoryPartitionSizeInBytes="5m"):
        s = build_session(app_name="again")
        assert s.conf.get("spark.sql.shuffle.partitions") == "37"
        assert s.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes") == "5m"


@pytest.mark.parametrize("module", ["quarry.plans.apps", "quarry.streaming.apps"])
def test_submitted_settings_survive_the_command_lines(module, tmp_path):
    # the command line's own session, printed instead of running a job
    code = (
        f"import {module} as m, quarry.session as s\n"
        "spark = s.build_session(app_name='x')\n"
        "print('GOT', spark.conf.get('spark.sql.shuffle.partitions'),"
        " spark.conf.get('spark.sql.adaptive.autoBroadcastJoinThreshold'))\n"
    )
    env = os.environ | {
        "PYTHONPATH": ROOT,
        "PYSPARK_SUBMIT_ARGS": "--master local[1] --conf spark.ui.enabled=false "
        "--conf spark.sql.shuffle.partitions=4000 pyspark-shell",
    }
    out = subprocess.run([sys.executable, "-c", code], env=env, capture_output=True, text=True,
                         timeout=180)
    assert "GOT 4000 10485760" in out.stdout, out.stderr[-1500:]


def test_spread_only_on_request(spark):
    from quarry.sources.tables import INPUT_PARTITIONS, spread

    df = spark.range(100).coalesce(1)
    assert spread(df) is df
    spark.conf.set(INPUT_PARTITIONS, "3")
    try:
        assert spread(df).rdd.getNumPartitions() == 3
    finally:
        spark.conf.unset(INPUT_PARTITIONS)


def test_scratch_scope_leaves_nothing(spark):
    with scratch(spark) as made:
        path = scratch_path(spark, "t-scope")
        spark.range(3).write.parquet(path)
        assert spark.read.parquet(path).count() == 3
        make_folder(spark, scratch_path(spark, "t-empty"))
        assert len(made) == 2 and all(os.path.isdir(local_dir(p)) for p in made)
    assert not any(os.path.exists(local_dir(p)) for p in made)


def test_registered_job_in_a_scope_leaves_nothing(spark):
    from quarry.plans.catalog import QUERIES

    with scratch(spark) as made:
        assert QUERIES["sql_on_file"](spark, "/root/testdata/sf0.001").count() > 0
    assert made and not any(os.path.exists(local_dir(p)) for p in made)
