import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))


@pytest.fixture(scope="session")
def spark():
    from ledgerline.session import build_session

    session = build_session(
        "tests", "local[8]", spark__sql__shuffle__partitions="4", spark__driver__memory="8g",
        spark__checkpoint__dir=tempfile.mkdtemp(prefix="ledgerline-tests-"),
    )
    session.sparkContext.setLogLevel("OFF")
    return session


@pytest.fixture
def root(spark):
    from ledgerline.session import work_dir

    return work_dir(spark, "test")
