import sys
import uuid
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from caudal.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    return local_session("tests", "8")


@pytest.fixture
def new_path(tmp_path):
    return lambda name="t": str(tmp_path / f"{name}-{uuid.uuid4().hex[:8]}")


def values(df, *cols):
    """Rows as a sorted list of tuples (single values when one column is asked for)."""
    rows = [tuple(r[c] for c in (cols or df.columns)) for r in df.collect()]
    rows.sort(key=lambda r: tuple((v is None, str(type(v)), v if v is not None else 0) for v in r))
    return [r[0] for r in rows] if len(cols) == 1 else rows
