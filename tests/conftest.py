import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.join(ROOT, "tests"))

from martlens.session import local_session  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"
SF_ORACLE = os.environ.get("MARTLENS_ORACLE_SF", "/root/testdata/sf0.01")


@pytest.fixture(scope="session")
def spark():
    import tempfile
    s = local_session("*", shuffle_partitions=8, app="martlens-tests",
                      warehouse=tempfile.mkdtemp(prefix="martlens-warehouse-"))
    yield s
    s.stop()


def rows(df, *cols):
    """Sorted list of tuples of the given columns (all when none given)."""
    sel = df.select(*cols) if cols else df
    return sorted((tuple(r) for r in sel.collect()), key=repr)
