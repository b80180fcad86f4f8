import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from tests.sessions import local_session  # noqa: E402

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    return local_session()


@pytest.fixture(scope="session")
def fixtures(spark):
    from tideline.sources.fixtures import Fixtures

    return Fixtures(spark, SMALL)
