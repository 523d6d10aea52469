import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from churnlens.session import local_session
    s = local_session(8, app="churnlens-tests")
    # Tests choose their own scratch folder only where the session has none.
    if not s.sparkContext.getCheckpointDir():
        s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="churnlens-test-"))
    yield s


@pytest.fixture
def scratch():
    return tempfile.mkdtemp(prefix="churnlens-run-")
