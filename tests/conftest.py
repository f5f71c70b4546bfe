import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from marlstone.session import build_session

    shared = tmp_path_factory.mktemp("shared")
    return build_session("local[4]", spark__sql__shuffle__partitions="4", spark__checkpoint__dir=f"file://{shared}", spark__sql__warehouse__dir=str(tmp_path_factory.mktemp("warehouse")), spark__driver__memory="3g")


@pytest.fixture(scope="session")
def sf():
    return SF
