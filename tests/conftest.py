import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from textloom.session import local_session  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    s = local_session(cores="*", partitions=8, app="textloom-tests")
    # tests only: the session names no shared checkpoint folder, so set one
    if not s.sparkContext.getCheckpointDir():
        s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="textloom-test-ckpt-"))
    yield s
    s.stop()


def rows(df, *cols):
    """Sorted list of tuples (for order-insensitive compares)."""
    sel = df.select(*cols) if cols else df
    return sorted(tuple(r) for r in sel.collect())
