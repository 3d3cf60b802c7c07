import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from sluicebox.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        app="tests", master="local[4]", spark__sql__shuffle__partitions="4",
        spark__driver__memory="4g", spark__ui__showConsoleProgress="false",
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def layers(spark, tmp_path):
    from sluicebox.plans.layers import Layers

    return Layers(spark, str(tmp_path / "tables"))
