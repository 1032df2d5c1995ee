import os
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))
os.environ["PYTHONPATH"] = f"{ROOT}{os.pathsep}{os.environ.get('PYTHONPATH', '')}"

from quarterloom.session import session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    s = session("quarterloom-tests", cpus=4, **{"spark.sql.shuffle.partitions": "4", "spark.driver.memory": "3g"})
    yield s
    s.stop()


@pytest.fixture(scope="session")
def tiny():
    return "/root/testdata/sf0.001"
