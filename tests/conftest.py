from __future__ import annotations

import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"
SF_ORACLE = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from sleeper.session import build_session

    s = build_session("local[4]", app="sleeper-tests", shuffle_partitions=8)
    # Tests run without a cluster: register a private checkpoint dir (unset otherwise).
    if not s.sparkContext.getCheckpointDir():
        s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="sleeper-test-ckpt-"))
    yield s
    s.stop()


def rows(df, *cols):
    """Collected rows as sorted tuples (optionally a column subset)."""
    cols = cols or tuple(df.columns)
    return sorted((tuple(r[c] for c in cols) for r in df.collect()), key=lambda t: tuple(map(str, t)))
