import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from tidemark.session import build_session
    s = build_session(master="local[*]", shuffle_partitions=8,
                      extra={"spark.sql.warehouse.dir": tempfile.mkdtemp(prefix="tidemark-wh-")})
    yield s
    s.stop()


@pytest.fixture
def tmp(tmp_path):
    return str(tmp_path)


def rows(df, *cols):
    """Collected rows as tuples, sorted (None first)."""
    cols = cols or df.columns
    out = [tuple(r[c] for c in cols) for r in df.select(*cols).collect()]
    return sorted(out, key=lambda t: tuple((v is not None, v) for v in t))
