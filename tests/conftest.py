"""Shared fixtures: one local session for the whole run, scratch folders per test."""

from __future__ import annotations

import sys
import tempfile
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))

SF_SMALL = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from gridlake.session import build_session

    session = build_session(
        "gridlake-tests",
        master="local[4]",
        shuffle_partitions=4,
        conf={
            "spark.checkpoint.dir": tempfile.mkdtemp(prefix="gridlake-test-ckpt-"),
            "spark.sql.streaming.forceDeleteTempCheckpointLocation": "true",
        },
    )
    yield session
    session.stop()


@pytest.fixture()
def scratch():
    """A fresh scratch folder per test (never reused, never cleared)."""
    return tempfile.mkdtemp(prefix="gridlake-test-")
