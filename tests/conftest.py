import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from ledgerline.session import get_session
    s = get_session("local[*]", shuffle_partitions=8)
    yield s


def _key(t):
    return tuple((v is None, str(type(v)), v if v is not None else 0) for v in t)


def rows(df, *cols):
    cols = cols or tuple(df.columns)
    return sorted((tuple(r[c] for c in cols) for r in df.collect()), key=_key)
