import os
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
DATA = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from colloquy.session import get_spark

    s = get_spark("tests", spark__sql__shuffle__partitions="4", spark__sql__warehouse__dir=str(tmp_path_factory.mktemp("warehouse")), spark__checkpoint__dir=f"file://{tmp_path_factory.mktemp('shared')}")
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


@pytest.fixture(scope="session")
def sf():
    return DATA
