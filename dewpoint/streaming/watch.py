"""What running queries report: measurements by micro-batch, progress and failures."""

from __future__ import annotations

import time
from collections.abc import Callable, Sequence
from threading import Condition

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from dewpoint.operators.windows import ARRIVED, CLOSED, READINGS
from dewpoint.streaming.state import sums_in_state

MEASUREMENTS = (
    "batch_id long, messages long, unreadable long, untimed long, window_readings long, "
    "closed_readings long, late_readings long"
)


class _Reports(StreamingQueryListener):
    """Keeps the last report of every run, and wakes those who wait for one."""

    def __init__(self):
        self.changed = Condition()
        self.idle: dict[str, bool] = {}
        self.ended: set[str] = set()

    def _note(self, run: object, idle: bool) -> None:
        with self.changed:
            self.idle[str(run)] = idle
            self.changed.notify_all()

    def onQueryStarted(self, event) -> None:  # noqa: N802
        pass

    def onQueryProgress(self, event) -> None:  # noqa: N802
        # A batch without rows is planned only if there is no more data.
        self._note(event.progress.runId, event.progress.numInputRows == 0)

    def onQueryIdle(self, event) -> None:  # noqa: N802
        self._note(event.runId, True)

    def onQueryTerminated(self, event) -> None:  # noqa: N802
        with self.changed:
            self.ended.add(str(event.runId))
            self.changed.notify_all()


class BatchMeasurements(_Reports):
    """Writes a row per micro-batch of one measured job to ``folder/batch_id=N``.

    ``messages``; those of them with no readable field (``unreadable``); readings without a
    readable time (``untimed``); readings counted once per window they belong to
    (``window_readings``); those in the windows the batch closed (``closed_readings``); and
    those that came too late for their window (``late_readings``).

    The first four are observed by the job itself in the pass that sums the readings. Late
    ones follow from them: what came in and is neither in a closed window nor in the state.
    The state is read only after batches in which Spark dropped something; its own count
    is of sums, not readings. A batch delivered again replaces its row. A report is sent
    after the batch; one that is lost with the driver leaves a gap in ``batch_id``.
    """

    def __init__(self, spark: SparkSession, checkpoint: str, folder: str):
        super().__init__()
        self.spark, self.checkpoint, self.folder = spark, checkpoint, folder.rstrip("/")
        self.run_id: str | None = None
        self.problem: Exception | None = None

    def onQueryProgress(self, event) -> None:  # noqa: N802
        progress = event.progress
        arrived = progress.observedMetrics.get(ARRIVED)
        with self.changed:  # not before ``start`` knows the run
            ours = str(progress.runId) == self.run_id
        if ours and arrived is not None:
            try:
                self._write(progress, arrived)
            except Exception as problem:  # raised by wait(); Spark would only log it
                self.problem = problem
        super().onQueryProgress(event)

    def _write(self, progress, arrived) -> None:
        closed = progress.observedMetrics[CLOSED].window_readings or 0
        came = arrived.window_readings or 0
        late = 0
        if any(operator.numRowsDroppedByWatermark for operator in progress.stateOperators):
            before, after = (self._open(b) for b in (progress.batchId - 1, progress.batchId))
            late = came - closed - (after - before)
        row = (arrived.messages, arrived.unreadable, arrived.untimed, came, closed, late)
        schema = MEASUREMENTS.split(", ", 1)[1]
        # A file sink skips a batch that it already has: nothing is seen of its messages.
        mode = "overwrite" if arrived.messages else "ignore"
        self.spark.createDataFrame([row], schema).coalesce(1).write.mode(mode).parquet(
            f"{self.folder}/batch_id={progress.batchId}"
        )

    def _open(self, batch_id: int) -> int:
        sums = sums_in_state(self.spark, self.checkpoint, batch_id)
        return sums.agg(F.sum(READINGS)).first()[0] or 0

    def start(self, start: Callable[[], StreamingQuery]) -> StreamingQuery:
        """Starts the job under observation."""
        self.spark.streams.addListener(self)
        try:
            # Reports wait until the run is known.
            with self.changed:
                query = start()
                self.run_id = str(query.runId)
            return query
        except BaseException:
            self.spark.streams.removeListener(self)
            raise

    def wait(self, timeout: float | None = None) -> bool:
        """Waits for the last report of a job that has ended; False if it did not come."""
        with self.changed:
            come = self.changed.wait_for(lambda: self.run_id in self.ended, timeout)
        if come:
            self.spark.streams.removeListener(self)
        if self.problem is not None:
            raise self.problem
        return come


def read_measurements(spark: SparkSession, folder: str) -> DataFrame:
    """The rows that ``BatchMeasurements`` has written, one per micro-batch."""
    found = spark.read.schema(MEASUREMENTS).parquet(folder)
    # The column of the folders' names comes last in the files.
    return found.select(*[field.split()[0] for field in MEASUREMENTS.split(", ")])


def supervise(
    spark: SparkSession,
    start: Callable[[], Sequence[StreamingQuery]],
    *,
    restarts: int = 3,
    pause: float = 0.0,
    until_idle: bool = False,
    timeout: float | None = None,
) -> bool:
    """Keeps the queries that ``start`` starts together running.

    If one fails, all are stopped and started again, from their checkpoints, after
    ``pause`` seconds, which double with every failure in a row. ``restarts`` failures in a
    row are borne, the next one is raised; they are in a row unless every query finished a
    batch or was idle in between. Ends, with True, when all queries have ended by themselves
    (as under ``availableNow``) or, with ``until_idle``, when none had more to read in its
    last report; with False after ``timeout`` seconds. In the end all are stopped.
    """
    reports = _Reports()
    spark.streams.addListener(reports)
    until = None if timeout is None else time.monotonic() + timeout
    failures = 0
    try:
        while True:
            queries = list(start())
            try:
                done = _watched(reports, queries, until_idle, until)
            finally:
                for query in queries:
                    query.stop()
            if done is not None:
                return done
            if all(str(query.runId) in reports.idle for query in queries):
                failures = 0
            failures += 1
            if failures > restarts:
                raise next(e for e in (query.exception() for query in queries) if e)
            time.sleep(pause * 2 ** (failures - 1))
    finally:
        spark.streams.removeListener(reports)
        # Failures that were dealt with here are not for the next ``run``.
        spark.streams.resetTerminated()


def _watched(
    reports: _Reports, queries: Sequence[StreamingQuery], until_idle: bool, until: float | None
) -> bool | None:
    """True when the queries are done, False after the time, None if one failed."""
    runs = [str(query.runId) for query in queries]
    while True:
        # A query that ends between the check and the wait is seen after a second.
        if any(query.exception() for query in queries):
            return None
        if not any(query.isActive for query in queries):
            return True
        with reports.changed:
            if until_idle and all(reports.idle.get(r) or r in reports.ended for r in runs):
                if not any(query.exception() for query in queries):
                    return True
            left = 1.0 if until is None else min(1.0, until - time.monotonic())
            if left <= 0:
                return False
            reports.changed.wait(left)
