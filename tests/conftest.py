import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tidemark.session import Workspace, local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    return local_session("4", shuffle_partitions=4, memory="4g", shared=str(tmp_path_factory.mktemp("shared")))


@pytest.fixture()
def ws(spark):
    return Workspace(spark)
