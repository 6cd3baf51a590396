import pathlib
import sys

import pytest

ROOT = pathlib.Path(__file__).resolve().parent.parent
sys.path[:0] = [str(ROOT), str(ROOT / "tools")]


@pytest.fixture(scope="session")
def spark():
    from larkspur.session import clear_scratch, local_session

    session = local_session(8, app="tests", **{"spark.sql.shuffle.partitions": "4"})
    yield session
    clear_scratch(session)
    session.stop()


@pytest.fixture
def rows():
    """Sorted tuples of a frame, for order-free comparison."""

    def collect(df, *cols):
        return sorted((tuple(r) for r in df.select(*(cols or df.columns)).collect()), key=repr)

    return collect
