import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from cellsurvey.session import local_session

    return local_session(8, spark__checkpoint__dir=str(tmp_path_factory.mktemp("checkpoints")))
