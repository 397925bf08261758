from __future__ import annotations

import os
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
sys.path.insert(0, str(ROOT))
os.environ["PYTHONPATH"] = os.pathsep.join([str(ROOT), os.environ.get("PYTHONPATH", "")])

DATA = Path(os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001"))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from lexmill.session import session, ship

    s = session(
        "tests", "local[4]", spark_sql_shuffle_partitions="4", spark_ui_enabled="false", spark_driver_memory="4g", spark_checkpoint_dir=str(tmp_path_factory.mktemp("checkpoints")),
        spark_sql_warehouse_dir=str(tmp_path_factory.mktemp("warehouse")),
    )
    s.sparkContext.setLogLevel("ERROR")
    yield ship(s)
    s.stop()


@pytest.fixture(scope="session")
def sf_dir():
    if not DATA.exists():
        pytest.skip("no test tables")
    return str(DATA)
