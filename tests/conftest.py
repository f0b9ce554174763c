import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from ledgerlens.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    # tests run locally with their own shared folder (a cluster names its own)
    ckpt = str(tmp_path_factory.mktemp("ckpt"))
    session = build_session("local[4]", 8, app_name="ledgerlens-tests",
                            extra={"spark.checkpoint.dir": ckpt})
    yield session


@pytest.fixture()
def scratch(spark, tmp_path):
    return str(tmp_path)
