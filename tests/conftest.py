import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tessera.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    s = build_session("local[4]", "tessera-tests", shuffle_partitions=4, extra={"spark.driver.memory": "4g"})
    yield s
    s.stop()


@pytest.fixture(autouse=True)
def _release_cache(request):
    """Tests cache intermediate frames; drop them after each test so a
    long session does not accumulate them."""
    yield
    if "spark" in request.fixturenames:
        request.getfixturevalue("spark").catalog.clearCache()


def rows(df, *cols):
    """Collected rows as sorted tuples (NULLs first)."""
    cols = cols or tuple(df.columns)
    out = [tuple(r[c] for c in cols) for r in df.select(*cols).collect()]
    return sorted(out, key=lambda t: tuple((v is not None, v) for v in t))
