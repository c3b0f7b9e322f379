import sys
import tempfile
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from logframe import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "logframe-tests",
        "local[8]",
        spark__ui__enabled="false",
        spark__sql__shuffle__partitions="8",
        # Plans are checked as text, so their filters must not be cut short.
        spark__sql__maxMetadataStringLength="10000",
    )
    session.sparkContext.setLogLevel("ERROR")
    if session.conf.get("spark.checkpoint.dir", None) is None:
        session.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="logframe-checkpoints-"))
    yield session
    session.stop()
