"""Follow-up of failed sessions as a stream: a session whose requests ran out of retries and that stays silent is reported.

Per session the state holds the latest exhausted request, the latest answer and what was last reported. A timer on event time fires when
the stream's clock has passed the silence after the failure; without an answer by then the session is ``stalled``. An answer, however
late it arrives, takes that back: ``recovered``. A later failure opens the session again: ``open``.

The clock is the watermark, but nothing is dropped as late: the operator does not see the column that the watermark is on. What was
last reported of a session depends on its events and on the clock alone, not on how files fall into batches.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import Any

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from tracelode.functions.times import as_instant, from_micros
from tracelode.operators.reliability import MAX_RETRIES
from tracelode.operators.sliced import micros
from tracelode.sources.sinks import write_table

#: No answer for so long after the failure.
SILENCE_SECONDS = 3600
SERVED_BY = ("api_request", "assistant_response")
REPORT = "session_id string, change int, status string, failed_at long"
_NONE = -(2**62)


class FollowUp(StatefulProcessor):
    """Times are microseconds since the epoch. Takes rows, not frames: most sessions have a row or two in a batch."""

    def __init__(self, silence_seconds: int):
        self.silence = silence_seconds * 1_000_000

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.state = handle.getValueState("session", "failed long, served long, status string, change int")

    def close(self) -> None:
        pass

    def _report(self, key: Any, old: tuple, failed: int, served: int, status: str) -> Iterator[Row]:
        """What is new of a session: its status, or a later failure."""
        before, _, said, change = old
        changed = (status, failed) != (said, before)
        self._keep(old, (failed, served, status, change + changed))
        if changed:
            yield Row(session_id=key[0], change=change + 1, status=status, failed_at=failed)

    def _keep(self, old: tuple, new: tuple) -> None:
        if new != old:
            self.state.update(new)

    def handleInputRows(self, key: Any, rows: Iterator[Row], timerValues: Any) -> Iterator[Row]:
        old = tuple(self.state.get() or (_NONE, _NONE, "", 0))
        before, served, status, change = old
        failed = before
        for row in rows:
            at, fails = row["at"], row["failed"]
            if fails:
                failed = max(failed, at)
            else:
                served = max(served, at)
        if failed == _NONE:
            self._keep(old, (failed, served, status, change))
            return
        if failed > before:
            self.handle.registerTimer((failed + self.silence) // 1000)
        if served > failed:
            now = "recovered"
        else:
            now = "stalled" if status == "stalled" and failed == before else "open"
        yield from self._report(key, old, failed, served, now)

    def handleExpiredTimer(self, key: Any, timerValues: Any, expiredTimerInfo: Any) -> Iterator[Row]:
        old = tuple(self.state.get())
        failed, served, status, _ = old
        if status == "open" and (failed + self.silence) // 1000 <= expiredTimerInfo.getExpiryTimeInMs():
            yield from self._report(key, old, failed, served, "stalled")


def _relevant(events: DataFrame, max_retries: int) -> tuple[DataFrame, Column]:
    failed = (F.col("event_name") == "api_error") & (F.col("attempt") >= max_retries + 1)
    wanted = events.filter(F.col("session_id").isNotNull() & F.col("event_timestamp").isNotNull() & (failed | F.col("event_name").isin(*SERVED_BY)))
    return wanted, failed


def follow_up(
    events: DataFrame, target: str, checkpoint: str, silence_seconds: int = SILENCE_SECONDS, max_retries: int = MAX_RETRIES
) -> None:
    """Write what changes about failed sessions, one folder per micro-batch, then stop when all input is done.

    A session without a failure reports nothing. Reports of a session are numbered.
    """
    wanted, failed = _relevant(events, max_retries)
    clocked = wanted.withColumn("clock", as_instant(F.col("event_timestamp"))).withWatermark("clock", "0 seconds")
    rows = clocked.select("session_id", micros(F.col("event_timestamp")).alias("at"), failed.alias("failed"))
    reports = rows.groupBy("session_id").transformWithState(
        FollowUp(silence_seconds), outputStructType=REPORT, outputMode="Update", timeMode="EventTime"
    )

    def write(batch: DataFrame, batch_id: int) -> None:
        write_table(batch, f"{target}/batch_id={batch_id}")

    query = (
        reports.writeStream.foreachBatch(write)
        .outputMode("update")
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def read_reports(spark: SparkSession, target: str) -> DataFrame:
    """The last report of each session: session_id, status, last_exhausted_at."""
    rows = spark.read.schema(f"{REPORT}, batch_id long").parquet(target)
    newest = rows.groupBy("session_id").agg(F.max("change").alias("change"))
    last = rows.join(newest, ["session_id", "change"])
    return last.select("session_id", "status", from_micros(F.col("failed_at")).alias("last_exhausted_at"))


def follow_up_batch(events: DataFrame, silence_seconds: int = SILENCE_SECONDS, max_retries: int = MAX_RETRIES) -> DataFrame:
    """What ``read_reports`` must equal: the same from all events at once, at the time of the latest of them."""
    wanted, failed = _relevant(events, max_retries)
    at = F.col("event_timestamp")
    clock = wanted.agg(F.max(F.unix_millis(as_instant(at)))).first()[0]
    ends = wanted.groupBy("session_id").agg(F.max(F.when(failed, at)).alias("last_exhausted_at"), F.max(F.when(~failed, at)).alias("last_served_at"))
    due = F.unix_millis(as_instant(F.col("last_exhausted_at"))) + silence_seconds * 1000
    status = F.when(F.col("last_served_at") > F.col("last_exhausted_at"), "recovered").when(due <= F.lit(clock), "stalled").otherwise("open")
    return ends.filter(F.col("last_exhausted_at").isNotNull()).select("session_id", status.alias("status"), "last_exhausted_at")
