"""Session helpers: partition sizing and the shared checkpoint folder."""

from __future__ import annotations

import os
import subprocess
import sys

import pytest

from kinship.session import ensure_checkpoint_dir, input_bytes, scale_conf, session_conf, shared_dir


def test_scale_conf_bounds():
    big = scale_conf(100 * 10**12, 8000)
    assert big["spark.sql.shuffle.partitions"] == str(100 * 10**12 // (256 * 1024 * 1024))
    assert big["spark.sql.files.maxPartitionBytes"] == str(256 * 1024 * 1024)
    mid = scale_conf(10**12, 1000)
    assert int(mid["spark.sql.shuffle.partitions"]) == 10**12 // (256 * 1024 * 1024)
    small = scale_conf(10**6, 8)
    assert small["spark.sql.shuffle.partitions"] == "16"


def test_input_bytes_and_shared_dir(spark, micro_paths):
    total = input_bytes(spark, list(micro_paths.values()))
    assert total == sum(len(open(p, "rb").read()) for p in micro_paths.values())
    path = shared_dir(spark, "x", "y")
    assert path == spark.conf.get("spark.checkpoint.dir").rstrip("/") + "/x/y"


def test_input_bytes_of_patterns(spark, tmp_path):
    for name in ("p1.csv", "p2.csv", "q.csv"):
        (tmp_path / name).write_text("abc\n")
    assert input_bytes(spark, [f"{tmp_path}/p*.csv"]) == 8
    with pytest.raises(FileNotFoundError):
        input_bytes(spark, [f"{tmp_path}/none*.csv"])


def test_width_is_set_only_when_given():
    assert "spark.sql.shuffle.partitions" not in session_conf()
    assert session_conf(5)["spark.sql.shuffle.partitions"] == "5"


def test_submitted_width_survives():
    """A session whose master and width come from the submission keeps that width."""
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    submitted = "--master local[1] --conf spark.sql.shuffle.partitions=777 --conf spark.ui.enabled=false pyspark-shell"
    code = "from kinship.session import get_session; print('width', get_session().conf.get('spark.sql.shuffle.partitions'))"
    env = {**os.environ, "PYTHONPATH": root, "PYSPARK_SUBMIT_ARGS": submitted}
    done = subprocess.run([sys.executable, "-c", code], env=env, capture_output=True, text=True, timeout=300)
    assert "width 777" in done.stdout


class _Cluster:
    """As much of a session as the folder helper asks, on a cluster that names no shared folder."""

    class conf:  # noqa: N801
        get = staticmethod(lambda key, default=None: default)

    class sparkContext:  # noqa: N801
        master = "spark://host:7077"
        getConf = staticmethod(lambda: _Cluster.conf)


def test_no_machine_local_folder_on_a_cluster():
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        ensure_checkpoint_dir(_Cluster)
