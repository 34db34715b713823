import os
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
sys.path.insert(0, str(ROOT))
os.environ["PYTHONPATH"] = f"{ROOT}{os.pathsep}{os.environ.get('PYTHONPATH', '')}"  # for the workers

from stayscope.operators.language import default_language_model  # noqa: E402
from stayscope.session import build_session  # noqa: E402

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    os.chdir(tmp_path_factory.mktemp("cwd"))
    session = build_session(
        "tests", "local[4]",
        spark__driver__host="127.0.0.1", spark__driver__bindAddress="127.0.0.1",
        spark__sql__shuffle__partitions="4", spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false", spark__driver__memory="6g",
        spark__checkpoint__dir=str(tmp_path_factory.mktemp("shared")),
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def seed_model(spark):
    return default_language_model(spark)


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def logical_plan_of(df) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString()
