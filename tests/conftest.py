import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))


@pytest.fixture(scope="session")
def spark():
    from paperloom.session import build_session, ship_package

    session = build_session("paperloom-tests", "local[8]", {
        "spark.sql.shuffle.partitions": "4", "spark.ui.enabled": "false", "spark.driver.memory": "6g",
    })
    session.sparkContext.setLogLevel("OFF")
    ship_package(session)
    return session
