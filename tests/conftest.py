import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
os.environ.setdefault("PYTHONWARNINGS", "ignore::FutureWarning")


@pytest.fixture(scope="session")
def spark():
    from tidewatch.session import get_session

    s = get_session("local[4]", app="tidewatch-tests", shuffle_partitions=4,
                    extra={"spark.executorEnv.PYTHONWARNINGS": "ignore::FutureWarning"})
    yield s
    s.stop()


@pytest.fixture()
def scratch():
    return tempfile.mkdtemp(prefix="tw-test-", dir="/tmp")
