"""Changes that wait for a review, from streams of changes and of patrol entries in whatever order they come.

Each revision has a state: its changes that are shown as open, and whether it has been reviewed. A timer gives the state up some time after the
change, when no entry is waited for any more.
"""

from __future__ import annotations

from collections.abc import Iterator
from datetime import timedelta

from pyspark.sql import Column, DataFrame, Row, functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from changewatch.functions.values import epoch_seconds

ROCKS_DB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
OUTPUT = "date date, total long, registered long"


class Waiting(StatefulProcessor):
    """Rows of a revision: changes (with ``rc_id``) and entries (without). Gives what they add to or take from the open changes of a
    date."""

    def __init__(self, within: timedelta):
        self.within = within

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.reviewed = handle.getValueState("reviewed", "reviewed boolean")
        self.shown = handle.getListState("shown", "rc_id long, date date, registered boolean")

    def handleInputRows(self, key: tuple, rows: Iterator[Row], timerValues: object) -> Iterator[Row]:
        done = self.reviewed.exists()
        own = [tuple(row) for row in self.shown.get()] if self.shown.exists() else []
        before = set(own)
        latest = None
        for row in rows:
            latest = max(latest or row.event_time, row.event_time)
            if row.rc_id is None or row.rc_patrolled == 1:
                done = True
            elif row.rc_id not in {ident for ident, _, _ in own}:  # a change may come twice
                own.append((row.rc_id, row.date, row.registered))
        if done:
            own = []
            self.reviewed.update((True,))
        if set(own) != before:
            self.shown.clear()
            if own:
                self.shown.put(own)
        if latest is not None:
            self.handle.registerTimer(int((latest + self.within).timestamp() * 1000))
        for sign, changed in ((1, set(own) - before), (-1, before - set(own))):
            for _, date, registered in sorted(changed, key=lambda one: one[0]):
                yield Row(date=date, total=sign, registered=sign * registered)

    def handleExpiredTimer(self, key: tuple, timerValues: object, expiredTimerInfo: object) -> Iterator[Row]:
        """What is shown stays shown; that it may change is given up."""
        self.reviewed.clear()
        self.shown.clear()
        return iter(())

    def close(self) -> None:
        pass


def open_changes(changes: DataFrame, log: DataFrame, within: timedelta = timedelta(days=31), lateness: str = "1 hour") -> DataFrame:
    """Streaming (date, total, registered): what is to be added to the open changes of a date, in all and by registered editors.

    ``changes`` has rc_id, rc_this_oldid, time, actor_user and rc_patrolled, ``log`` rc_curid and log_time. A change is open from when it comes until an
    entry of its revision does; an entry may come first, and either may come twice. A change that comes as reviewed never is open. Changes
    without a revision (0) wait under their own id, for no entry. ``within`` the newest row of a revision its state is kept."""
    def seen(time: str) -> Column:
        return F.timestamp_seconds(epoch_seconds(F.col(time)))

    key = F.when(F.col("rc_this_oldid") == 0, -F.col("rc_id")).otherwise(F.col("rc_this_oldid"))
    edits = changes.filter("time IS NOT NULL").select(
        key.alias("revision"), seen("time").alias("event_time"), "rc_id", F.to_date("time").alias("date"),
        F.col("actor_user").isNotNull().alias("registered"), "rc_patrolled")
    entries = log.filter("rc_curid > 0 AND log_time IS NOT NULL").select(
        F.col("rc_curid").alias("revision"), seen("log_time").alias("event_time"), F.lit(None).cast("bigint").alias("rc_id"),
        F.lit(None).cast("date").alias("date"), F.lit(None).cast("boolean").alias("registered"), F.lit(None).cast("int").alias("rc_patrolled"))
    rows = edits.unionByName(entries).withWatermark("event_time", lateness)
    return rows.groupBy("revision").transformWithState(Waiting(within), OUTPUT, "Append", "EventTime")


def start(result: DataFrame, sink: str, state: str, every: str | None = None) -> StreamingQuery:
    """Append what is to be added to a folder of Parquet files. State lies in RocksDB, of which ``state`` keeps copies that all machines see."""
    result.sparkSession.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKS_DB)
    trigger = {"processingTime": every} if every else {"availableNow": True}
    return result.writeStream.format("parquet").outputMode("append").option("checkpointLocation", state).trigger(**trigger).start(sink)


def remaining(added: DataFrame) -> DataFrame:
    """(date, total, registered, anon) of the open changes, from all that was added."""
    return added.groupBy("date").agg(F.sum("total").alias("total"), F.sum("registered").alias("registered")).filter(
        F.col("total") > 0).withColumn("anon", F.col("total") - F.col("registered"))
