import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from rowsluice.session import local_session


@pytest.fixture(scope="session")
def spark():
    session = local_session(4, "rowsluice-tests", spark__sql__shuffle__partitions=4)
    yield session
    session.stop()


@pytest.fixture
def folder():
    return tempfile.mkdtemp(prefix="rowsluice-test-")
