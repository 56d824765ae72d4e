import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from chronoweave.session import build_session  # noqa: E402

DATA = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "tests",
        "local[8]",
        spark__sql__shuffle__partitions="8",
        spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false",
        spark__driver__memory="8g",
        spark__checkpoint__dir=tempfile.mkdtemp(prefix="chronoweave-test-"),
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def data_dir():
    return DATA


@pytest.fixture
def same_rows():
    """Assert that two frames hold the same rows, in any order."""

    def check(left, right, digits=9):
        columns = sorted(left.columns)
        assert columns == sorted(right.columns)

        def rows(df):
            def plain(value):
                return round(value, digits) + 0.0 if isinstance(value, float) else value

            return sorted(repr([plain(v) for v in r]) for r in df.select(columns).collect())

        assert rows(left) == rows(right)

    return check
