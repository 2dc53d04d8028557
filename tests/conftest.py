import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from pulsegrid.session import get_session

    s = get_session("local[4]", partitions=8, app="pulsegrid-tests", checkpoint_dir=tempfile.mkdtemp(prefix="pg-test-ckpt-"))
    yield s


@pytest.fixture
def tmpdir_fresh():
    return tempfile.mkdtemp(prefix="pg-test-")


def rows(df, *cols):
    sel = df.select(*cols) if cols else df
    return [tuple(r) for r in sel.collect()]
