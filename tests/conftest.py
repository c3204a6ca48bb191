import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from lakemart.session import build_session, drop_scratch  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    root = tmp_path_factory.mktemp("spark")
    session = build_session(
        "tests", "local[8]", spark__sql__shuffle__partitions="2", spark__default__parallelism="2", spark__driver__memory="4g",
        spark__checkpoint__dir=str(root / "scratch"), spark__sql__warehouse__dir=str(root / "warehouse"),
        spark__driver__extraJavaOptions="-XX:TieredStopAtLevel=1")  # short jobs: compile fast, not well
    session.sparkContext.setLogLevel("ERROR")
    yield session
    drop_scratch(session)
    session.stop()


@pytest.fixture
def folder(tmp_path):
    """A new folder's path as text, with a helper to build paths in it."""
    return lambda *parts: str(tmp_path.joinpath(*parts))


def rows(df, *columns):
    """Rows as a sorted list of tuples."""
    picked = df.select(*columns) if columns else df
    return sorted((tuple(r) for r in picked.collect()), key=str)
