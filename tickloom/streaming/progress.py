"""Progress reports of streaming queries as a table."""

from __future__ import annotations

import threading

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from tickloom.schema import OBSERVED, PROGRESS_LOG


class ProgressLog(StreamingQueryListener):
    """Append every query's progress reports to JSON files below ``path``, ``every`` at a time."""

    def __init__(self, spark: SparkSession, path: str, every: int = 20):
        super().__init__()
        self._spark = spark
        self._path = path
        self._every = every
        self._lines: list[str] = []
        self._lock = threading.Lock()

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        with self._lock:
            self._lines.append(" ".join(event.progress.json.splitlines()))
            full = len(self._lines) >= self._every
        if full:
            self.flush()

    def onQueryTerminated(self, event) -> None:
        self.flush()

    def flush(self) -> None:
        with self._lock:
            lines, self._lines = self._lines, []
        if lines:
            rows = self._spark.createDataFrame([(line,) for line in lines], "value string")
            rows.coalesce(1).write.mode("append").text(self._path)


def read_progress(spark: SparkSession, path: str) -> DataFrame:
    """The log as a table; a source's end position stays JSON text."""
    return spark.read.schema(PROGRESS_LOG).json(path)


def late_rows(progress: DataFrame) -> DataFrame:
    """Per query, how many rows its stateful operators left out because the watermark had passed them.

    Spark counts them after its first, partial aggregation, so several ticks may count as one row. Above
    0, a refresh of the raw table from the oldest late tick puts the bars right.
    """
    dropped = F.aggregate("stateOperators", F.lit(0).cast("long"),
                          lambda total, op: total + F.coalesce(op["numRowsDroppedByWatermark"], F.lit(0)))
    return progress.groupBy("name").agg(F.coalesce(F.sum(dropped), F.lit(0)).alias("late_rows"))


def observed(progress: DataFrame) -> DataFrame:
    """Per query and micro-batch, the ticks, missing prices and foreign fingerprints that were counted.

    A batch that ran again counts once, as it ended.
    """
    told = progress.filter(F.col("observedMetrics.ticks").isNotNull())
    last = told.groupBy("name", "batchId").agg(F.max_by("observedMetrics.ticks", "timestamp").alias("told"))
    return last.select("name", "batchId", *[F.col(f"told.{n}").alias(n) for n in OBSERVED])


def recent_progress(spark: SparkSession, query: StreamingQuery) -> DataFrame:
    """The reports a running query still holds (a bounded number) as the same table."""
    lines = [(report.json,) for report in query.recentProgress]
    texts = spark.createDataFrame(lines, "value string")
    return texts.select(F.from_json("value", PROGRESS_LOG).alias("report")).select("report.*")
