import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from quarry.session import local_session

    s = local_session("*", shuffle_partitions=8, app="quarry-tests")
    yield s
    s.stop()


def rows(df, *cols):
    """Sorted tuples of the given columns (all if none)."""
    cols = cols or tuple(df.columns)
    return sorted(tuple(r[c] for c in cols) for r in df.collect())
