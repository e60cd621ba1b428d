import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))


@pytest.fixture(scope="session")
def spark():
    from noticelake.runtime import build_session

    s = build_session("tests", cores=4, shuffle_partitions=4)
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


@pytest.fixture
def rows():
    """Rows of a DataFrame as a sorted list of tuples."""
    return lambda df: sorted((tuple(r) for r in df.collect()), key=repr)
