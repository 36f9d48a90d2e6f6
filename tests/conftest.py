import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
sys.path.insert(0, str(ROOT))

from gridflow.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    shared = tmp_path_factory.mktemp("shared")
    session = build_session("gridflow-tests", "local[8]", shuffle_partitions=4, extra={
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.driver.memory": "4g",
        "spark.checkpoint.dir": str(shared),
        "spark.sql.warehouse.dir": str(shared / "warehouse"),
    })
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def plan_of(capsys):
    """The physical plan as text."""
    def show(df):
        capsys.readouterr()
        df.explain("formatted")
        return capsys.readouterr().out
    return show
