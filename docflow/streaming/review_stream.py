"""Review commands as a stream, in the order of their events.

Commands may come late, split over micro-batches in any way, and by two routes. A document's state has its status as of the watermark,
before which nothing can come any more, and the commands that are not that old. With every arrival the commands that wait are
applied by (ts, event_id) to that status, each once, and the outcome is put out as the document's next version; once the watermark has
passed them they become part of the status. So the last versions are those of ``operators.review.fold`` over all that has come, in
whatever order, as long as commands are not later than the watermark allows; those that are do not count.

A document whose last command is older than ``forget``, in event time, leaves the state; a command that comes for it after that finds
it pending. Without ``forget`` none leaves.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.streaming.stateful_processor import ExpiredTimerInfo, TimerValues

from ..operators.ranking import last_seen
from ..storage import scratch_path

STATE = "status string, notes string, changes long, errors long, version long, last long"
WAITING = "micros long, event_id long, decision string, notes string"
OUT = "doc long, status string, notes string, changes long, errors long, version long"
#: Keyed lists and timers need this state store.
STORE = ("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
PENDING = ("pending", None, 0, 0)

Standing = tuple[str, str | None, int, int]


def step(status: str, notes: str | None, decision: str, given: str | None) -> Standing:
    """(status, notes, changes, errors) after one command; the counts are of this command."""
    given = (given or "").strip() or None
    if decision == "approve":
        return (status, notes, 0, int(status == "rejected")) if status != "pending" else ("approved", notes, 1, 0)
    if status == "rejected":
        return status, notes, 0, 0
    return ("rejected", given, 1, 0) if given else (status, notes, 0, 1)


def applied(standing: Standing, commands: list[tuple]) -> Standing:
    """A standing after commands (micros, event_id, decision, notes) in their order."""
    status, notes, changes, errors = standing
    for _, _, decision, given in sorted(commands, key=lambda c: c[:2]):
        status, notes, changed, failed = step(status, notes, decision, given)
        changes, errors = changes + changed, errors + failed
    return status, notes, changes, errors


class Review(StatefulProcessor):
    """One document."""

    def __init__(self, forget_ms: int | None) -> None:
        self.forget_ms = forget_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.settled = handle.getValueState("settled", STATE)
        self.waiting = handle.getListState("waiting", WAITING)

    def _settled(self) -> tuple:
        return tuple(self.settled.get()) if self.settled.exists() else (*PENDING, 0, 0)

    def _waiting(self) -> list[tuple]:
        return [tuple(row) for row in self.waiting.get()] if self.waiting.exists() else []

    def handleInputRows(self, key: tuple, rows: Iterator[Row], timerValues: TimerValues) -> Iterator[Row]:
        passed = timerValues.getCurrentWatermarkInMs() * 1000
        *standing, version, last = self._settled()
        waiting = self._waiting()
        known, before = {c[1] for c in waiting}, len(waiting)
        for row in rows:
            if row["micros"] >= passed and row["event_id"] not in known:  # the same command by another route is one
                known.add(row["event_id"])
                waiting.append((row["micros"], row["event_id"], row["decision"], row["notes"]))
        if len(waiting) == before:
            return
        last = max([last, *(c[0] for c in waiting)])
        self.waiting.put(waiting)
        self.settled.update((*standing, version + 1, last))
        self.handle.registerTimer(min(c[0] for c in waiting) // 1000 + 1)
        status, notes, changes, errors = applied(tuple(standing), waiting)
        yield Row(doc=key[0], status=status, notes=notes, changes=changes, errors=errors, version=version + 1)

    def handleExpiredTimer(self, key: tuple, timerValues: TimerValues, expiredTimerInfo: ExpiredTimerInfo) -> Iterator[Row]:
        """What the watermark has passed becomes part of the status; nothing is put out, as no view changes."""
        passed = timerValues.getCurrentWatermarkInMs() * 1000
        *standing, version, last = self._settled()
        waiting = self._waiting()
        due, rest = [c for c in waiting if c[0] < passed], [c for c in waiting if c[0] >= passed]
        if due:
            self.settled.update((*applied(tuple(standing), due), version, last))
            if rest:
                self.waiting.put(rest)
            else:
                self.waiting.clear()
        if rest:
            self.handle.registerTimer(min(c[0] for c in rest) // 1000 + 1)
        elif self.forget_ms is not None:
            if passed > last + self.forget_ms * 1000:
                self.settled.clear()
            else:
                self.handle.registerTimer(last // 1000 + self.forget_ms + 1)
        yield from ()

    def close(self) -> None:
        return


def review_states(commands: DataFrame, late: str = "1 day", forget_ms: int | None = None) -> DataFrame:
    """A stream commands(event_id, ts, doc, decision, notes) -> a stream of versions of documents; the session needs STORE while it runs."""
    rows = commands.withWatermark("ts", late).withColumn("micros", F.unix_micros("ts"))
    return rows.groupBy("doc").transformWithState(Review(forget_ms), OUT, "Update", "EventTime")


@contextmanager
def state_store(spark: SparkSession) -> Iterator[None]:
    """STORE in the session, and what was there before afterwards."""
    name, wanted = STORE
    before = spark.conf.get(name, None)
    spark.conf.set(name, wanted)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(name)
        else:
            spark.conf.set(name, before)


def run_available(states: DataFrame, out: str | None = None, check: str | None = None) -> DataFrame:
    """Run the stream over what is new, add its versions to ``out``, and return the last version of each document there."""
    spark = states.sparkSession
    out, check = out or scratch_path(spark, "review_states"), check or scratch_path(spark, "review_checkpoint")

    def write(batch: DataFrame, epoch: int) -> None:
        batch.write.mode("overwrite").parquet(f"{out}/epoch={epoch}")  # a repeated epoch replaces itself

    with state_store(spark):
        query = states.writeStream.outputMode("update").foreachBatch(write).option("checkpointLocation", check).trigger(availableNow=True).start()
        query.awaitTermination()
    return last_seen(spark.read.schema(OUT).parquet(f"{out}/*"), ["doc"], ["version"]).drop("version")


def commands_of_events(events: DataFrame) -> DataFrame:
    """Events in the role of commands: sign-ups and purchases approve, clicks reject with notes, errors reject without."""
    decision = F.when(F.col("event_type").isin("signup", "purchase"), "approve").when(F.col("event_type").isin("click", "error"), "reject")
    rows = events.select("event_id", F.col("ts").cast("timestamp").alias("ts"), F.col("user_id").alias("doc"), decision.alias("decision"), F.when(F.col("event_type") == "click", F.concat(F.lit("see "), "props")).alias("notes"))
    return rows.where("decision is not null")
