"""Shared Spark session and small-frame helpers for the test suite."""

from __future__ import annotations

import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from vigil.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    s = build_session(
        "local[4]",
        app_name="vigil-tests",
        shuffle_partitions=4,
        extra={"spark.checkpoint.dir": tempfile.mkdtemp(prefix="vigil-test-ckpt-")}
        if not os.environ.get("SPARK_CHECKPOINT_DIR")
        else {"spark.checkpoint.dir": os.environ["SPARK_CHECKPOINT_DIR"]},
    )
    yield s
    s.stop()


@pytest.fixture()
def scratch(tmp_path):
    """A fresh folder per test for written tables, stores and checkpoints."""
    return str(tmp_path)
