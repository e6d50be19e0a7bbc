import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from tidemart.session import build_session  # noqa: E402

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = build_session("tests", "local[8]", 8, {"spark.driver.memory": "4g",
                                                     "spark.sql.streaming.noDataMicroBatches.enabled": "true"})
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()
