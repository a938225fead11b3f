"""Staging follows the session's shared folder and refuses a machine-local one on a cluster."""

import os
import subprocess
import sys
from pathlib import Path

import pytest

from plainloom import session


class _Context:
    def __init__(self, master):
        self.master = master

    def getConf(self):
        return {}

    def getCheckpointDir(self):
        return None


class _Session:
    class conf:
        named = None

        @classmethod
        def get(cls, key, default=None):
            return cls.named if key == "spark.checkpoint.dir" else default

    def __init__(self, master):
        self.sparkContext = _Context(master)


def test_cluster_needs_a_shared_folder():
    with pytest.raises(RuntimeError):
        session.shared_folder(_Session("yarn"))


def test_named_folder_wins(monkeypatch):
    monkeypatch.setattr(_Session.conf, "named", "hdfs:///shared/")
    assert session.shared_folder(_Session("yarn")) == "hdfs:///shared"


def test_stage_keeps_rows_and_schema(spark, small):
    nation = small("nation")
    staged = session.stage(nation)
    assert staged.schema == nation.schema and staged.exceptAll(nation).count() == 0
    assert "parquet" in staged._jdf.queryExecution().executedPlan().toString()


def test_stage_is_gone_after_the_application(tmp_path):
    code = (
        "import sys; sys.path.insert(0, sys.argv[1])\n"
        "from pyspark.sql import SparkSession\n"
        "from plainloom.session import stage\n"
        "spark = SparkSession.builder.master('local[1]').config('spark.ui.enabled', 'false')"
        ".config('spark.checkpoint.dir', sys.argv[2]).getOrCreate()\n"
        "print(stage(spark.range(3)).count())\n"
        "import os; print(any('plainloom' in d for d in os.listdir(sys.argv[2])))\n"
    )
    root = str(Path(__file__).resolve().parents[1])
    done = subprocess.run([sys.executable, "-c", code, root, str(tmp_path)], capture_output=True, text=True, timeout=120)
    assert done.stdout.split() == ["3", "True"], done.stderr[-500:]
    import time

    for _ in range(50):  # the JVM ends shortly after the interpreter
        if not any("plainloom" in d for d in os.listdir(tmp_path)):
            break
        time.sleep(0.2)
    assert not any("plainloom" in d for d in os.listdir(tmp_path))


def test_spread_leaves_big_tables_alone(small):
    nation = small("nation")
    assert session.spread(nation, small_bytes=1) is nation
    assert session.spread(nation).rdd.getNumPartitions() > 1
