import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SMALL_SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from castwright.session import local_session

    s = local_session(cores=4, shuffle_partitions=4, app="castwright-tests")
    yield s
    s.stop()


def rows(df, *cols):
    """Collect as a list of tuples (in the given column order)."""
    cols = cols or tuple(df.columns)
    return [tuple(r[c] for c in cols) for r in df.collect()]
