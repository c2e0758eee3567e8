import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from quarrysift.session import get_session, ship_package  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = get_session(
        "tests",
        "local[4]",
        spark__sql__shuffle__partitions=4,
        spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false",
        spark__checkpoint__dir=tempfile.mkdtemp(prefix="quarrysift-test-"),
    )
    session.sparkContext.setLogLevel("ERROR")
    ship_package(session)
    # Functions defined in tests run in tasks, as those of a user's module would.
    here = os.path.dirname(os.path.abspath(__file__))
    for name in os.listdir(here):
        if name.endswith(".py"):
            session.sparkContext.addPyFile(os.path.join(here, name))
    yield session
    session.stop()
