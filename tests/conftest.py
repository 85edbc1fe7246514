import os
import re
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from arenalake.session import build_session  # noqa: E402
from arenalake.storage import remove_app_files  # noqa: E402

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "tests",
        master="local[8]",
        spark__sql__shuffle__partitions="8",
        spark__driver__memory="6g",
        spark__ui__showConsoleProgress="false",
        spark__sql__warehouse__dir=str(tmp_path_factory.mktemp("warehouse")),
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    remove_app_files(session)
    session.stop()


def initial_plan(df) -> str:
    """The physical plan before execution, without expression ids."""
    text = df._jdf.queryExecution().executedPlan().toString()
    return re.sub(r"#\d+L?", "", text.split("== Initial Plan ==")[-1])


def ranks_before_the_shuffle(df, key: str) -> bool:
    """Whether each task keeps one row per key before it shuffles on the key."""
    lines = initial_plan(df).splitlines()
    exchanges = [i for i, line in enumerate(lines) if f"Exchange hashpartitioning({key}," in line]
    return any("WindowGroupLimit" in lines[i + 1] and "Partial" in lines[i + 1] for i in exchanges)
