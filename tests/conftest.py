import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from regional_balance.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = local_session(8, **{"spark.sql.shuffle.partitions": "4", "spark.driver.memory": "4g"})
    session.sparkContext.setCheckpointDir(str(tmp_path_factory.mktemp("checkpoints")))
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf():
    folder = Path("/root/testdata/sf0.001")
    if not folder.exists():
        pytest.skip("driver tables not present")
    return str(folder)


@pytest.fixture(scope="session")
def plan():
    """Physical plan text of a frame."""

    def text(df) -> str:
        return df._jdf.queryExecution().executedPlan().toString()

    return text
