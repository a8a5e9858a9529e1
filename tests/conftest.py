import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from marketlake.session import local_session

    shared = {"spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared"))}
    session = local_session(cores=8, partitions=4, **shared)
    yield session
    session.stop()


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()
