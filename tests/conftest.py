import sys
from datetime import datetime, timedelta, timezone
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from tickloom.session import build_session

SF_DIR = "/root/testdata/sf0.001"
BASE = datetime(2024, 3, 4, 9, 0, 0, tzinfo=timezone.utc)


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "tests", master="local[4]",
        **{"spark.sql.shuffle.partitions": "4", "spark.ui.enabled": "false",
           "spark.ui.showConsoleProgress": "false",
           "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared")),
           "spark.sql.streaming.stateStore.providerClass":
               "org.apache.spark.sql.execution.streaming.state.HDFSBackedStateStoreProvider"})
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


def at(seconds: float) -> datetime:
    """A moment after the fixtures' start."""
    return BASE + timedelta(seconds=seconds)


TICK_DDL = "Symbol string, Price double, Volume double, Trade_Time timestamp, Seq bigint"


def ticks(spark, rows):
    """Rows of (symbol, price, volume, seconds after the start, seq)."""
    return spark.createDataFrame(
        [(s, p, v, None if t is None else at(t), q) for s, p, v, t, q in rows], TICK_DDL)


def rows(df, *order):
    return [tuple(r) for r in df.orderBy(*order).collect()] if order else [tuple(r) for r in df.collect()]


def seconds_of(moment: datetime) -> float:
    """Seconds after the start of a collected timestamp (sessions run in UTC)."""
    return (moment.replace(tzinfo=timezone.utc) - BASE).total_seconds()
