import os
import sys

import pytest

HERE = os.path.dirname(os.path.abspath(__file__))
sys.path[:0] = [os.path.dirname(HERE), HERE]


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from sentimill.session import build_session

    # a cluster names its shared folder; tests have one of their own
    ckpt = str(tmp_path_factory.mktemp("checkpoints"))
    s = build_session(master="local[*]", shuffle_partitions=8,
                      extra={"spark.checkpoint.dir": ckpt, "spark.driver.memory": "6g"})
    yield s
    s.stop()


@pytest.fixture()
def scratch(tmp_path):
    return str(tmp_path)
