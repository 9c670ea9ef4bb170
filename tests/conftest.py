import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from docledger.session import build_session, ship  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    home = tmp_path_factory.mktemp("spark")
    session = build_session("tests", "local[4]", **{
        "spark.sql.shuffle.partitions": "4",
        "spark.driver.memory": "4g",
        "spark.checkpoint.dir": str(home / "shared"),
        "spark.sql.warehouse.dir": str(home / "warehouse"),
    })
    session.sparkContext.setLogLevel("ERROR")
    ship(session)
    yield session
    session.stop()


@pytest.fixture
def conf(spark):
    """Set session settings for one test."""
    changed = {}

    def change(**settings):
        for key, value in settings.items():
            key = key.replace("__", ".")
            changed.setdefault(key, spark.conf.get(key, None))
            spark.conf.set(key, value)

    yield change
    for key, value in changed.items():
        spark.conf.unset(key) if value is None else spark.conf.set(key, value)
