import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from govlake.session import local_session  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    home = tmp_path_factory.mktemp("spark")
    session = local_session(4, "tests", 4, **{
        "spark.sql.warehouse.dir": str(home / "warehouse"),
        "spark.checkpoint.dir": str(home / "checkpoint"),
        "spark.driver.extraJavaOptions": f"-Dderby.system.home={home}"})
    session.sparkContext.setCheckpointDir(str(home / "checkpoint"))
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf():
    return SF

