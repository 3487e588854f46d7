import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from tidemark.session import build_session, clear_staged


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    warehouse = str(tmp_path_factory.mktemp("warehouse"))
    session = build_session("tests", "local[8]", **{"spark.sql.warehouse.dir": warehouse})
    session.sparkContext.setLogLevel("ERROR")
    yield session
    clear_staged(session)
    session.stop()


def rows(df, *order):
    """The rows as tuples, sorted by the given columns (nulls first)."""
    found = [tuple(r) for r in df.collect()]
    place = [df.columns.index(c) for c in order]
    return sorted(found, key=lambda r: [(r[i] is not None, r[i]) for i in place])
