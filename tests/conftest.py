from __future__ import annotations

import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from spendstar.session import build_session
    scratch = tempfile.mkdtemp(prefix="spendstar-test-")
    s = build_session("local[*]", 8, extra={"spark.checkpoint.dir": os.path.join(scratch, "ckpt"),
                                            "spark.driver.memory": "8g",
                                            "spark.sql.warehouse.dir": os.path.join(scratch, "wh")})
    yield s
    s.stop()


@pytest.fixture()
def scratch():
    return tempfile.mkdtemp(prefix="spendstar-run-")


@pytest.fixture(scope="session")
def T001(spark):
    from spendstar.sources.fixtures import FixtureTables
    return FixtureTables(spark, SF001)
