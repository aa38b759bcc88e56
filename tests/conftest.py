import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from laketide.session import build_session, shared_dir  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    s = build_session("local[*]", app_name="laketide-tests", shuffle_partitions=8)
    shared_dir(s)  # sets a local one only when the cluster names none
    yield s
    s.stop()


def rows(df, order=None):
    """Collect as sorted list of tuples (order-insensitive comparisons)."""
    out = [tuple(r) for r in df.collect()]
    return sorted(out, key=lambda t: tuple((x is None, str(x)) for x in t))
