import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from aloft.session import local_session
    s = local_session("*", 8, app="aloft-tests")
    yield s
    s.stop()


def rows(df, *cols):
    """Collected rows as sorted tuples (selected columns, or all)."""
    d = df.select(*cols) if cols else df
    return sorted((tuple(r) for r in d.collect()), key=lambda t: tuple((x is None, str(type(x)), x) for x in t))
