import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark():
    from latentforge.session import build_session, ensure_checkpoint_dir

    s = build_session("local[4]", app="latentforge-tests", shuffle_partitions=8)
    s.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(s)
    yield s
    s.stop()


@pytest.fixture(scope="session")
def sf():
    return SF


def rows(df, *cols):
    """Collected rows as plain tuples, sorted."""
    sel = df.select(*cols) if cols else df
    return sorted(tuple(r) for r in sel.collect())
