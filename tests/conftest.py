import os
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))
os.environ.setdefault("PYTHONDONTWRITEBYTECODE", "1")
os.environ.setdefault("TZ", "UTC")


@pytest.fixture(scope="session")
def spark():
    from sylvaframe.runtime import make_session

    session = make_session("tests", "local[4]", **{"spark.sql.shuffle.partitions": "4"})
    yield session
    session.stop()
