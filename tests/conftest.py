import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
os.environ["PYTHONPATH"] = os.pathsep.join([sys.path[0], os.environ.get("PYTHONPATH", "")])

from dossierlake.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    return local_session(4, "4g", "tests", **{"spark.sql.shuffle.partitions": "4"})


@pytest.fixture(scope="session")
def small():
    return "/root/testdata/sf0.001"
