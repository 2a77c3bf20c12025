import pytest

from spendlens.session import build_session


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session("tests", "local[4]", **{
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.sql.shuffle.partitions": "4",
        "spark.driver.memory": "6g",
        # test inputs are tiny: keep several partitions, so that boundaries are crossed
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
        "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared")),
    })
    session.sparkContext.setLogLevel("OFF")
    yield session
    session.stop()
