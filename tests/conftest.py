import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent))
sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from compare import session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    return session()


@pytest.fixture
def rows():
    """Rows of a frame as sorted tuples."""

    def collect(df, *cols):
        picked = df.select(*cols) if cols else df
        return sorted((tuple(r) for r in picked.collect()), key=repr)

    return collect
