"""Status moves of a stream, checked per key in event-time order with keyed state."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


@contextmanager
def rocksdb(spark: SparkSession) -> Iterator[None]:
    """Queries started inside keep their state in RocksDB, which keyed state needs; afterwards the session is as before."""
    name = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(name, None)
    spark.conf.set(name, PROVIDER)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(name)
        else:
            spark.conf.set(name, before)


class MoveChecker(StatefulProcessor):
    """Keeps a key's last status, and its rows that the watermark has not passed yet.

    A row waits until the watermark passes its time, because an earlier one may still arrive. Then rows are taken in order of
    (time, tie), each is compared with the status before it, and moves that the machine does not allow come out. Rows that arrive behind the watermark
    were dropped by Spark before (their number is in the query's progress).
    """

    def __init__(self, key: str, allowed: set[tuple[str | None, str]], kinds: dict[str, str], out: Sequence[str]):
        self.key, self.allowed, self.kinds, self.out = key, allowed, kinds, list(out)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.last = handle.getValueState("last", "status string")
        self.waiting = handle.getListState("waiting", ", ".join(f"{c} {k}" for c, k in self.kinds.items()))

    def handleInputRows(self, key: tuple, rows: Iterator, timerValues) -> Iterator[Row]:
        new = [tuple(r[c] for c in self.kinds) for r in rows]
        if new:
            self.waiting.appendList(new)
            self.wake(min(r[0] for r in new))
        return iter(())

    def wake(self, micros: int) -> None:
        """A timer for the first millisecond that the row lies wholly before."""
        self.handle.registerTimer(micros // 1000 + 1)

    def handleExpiredTimer(self, key: tuple, timerValues, expiredTimerInfo) -> Iterator[Row]:
        passed = timerValues.getCurrentWatermarkInMs() * 1000
        rows = [tuple(r) for r in self.waiting.get()] if self.waiting.exists() else []
        later = [r for r in rows if r[0] > passed]
        if len(later) == len(rows):
            return
        before = self.last.get()[0] if self.last.exists() else None
        names = list(self.kinds)
        for r in sorted((r for r in rows if r[0] <= passed), key=lambda r: r[:2]):
            status = r[2]
            if status != before and (before, status) not in self.allowed:
                found = dict(zip(names, r)) | {self.key: key[0], "from_state": before}
                yield Row(**{c: found[c] for c in self.out})
            before = status
        self.last.update((before,))
        if later:
            self.waiting.put(later)
            self.wake(min(r[0] for r in later))
        else:
            self.waiting.clear()

    def close(self) -> None:
        pass


def state_check_stream(stream: DataFrame, key: str, ts: str, tie: str, status: str, edges: DataFrame, machine: str, delay: str) -> DataFrame:
    """Invalid moves of a status stream: (key, tie, from_state, status), in append mode.

    ``ts`` orders a key's rows, ``tie`` rows of one time; batches may bring rows up to ``delay`` late. The first row of a key must be the
    machine's entry state, a repeat is no move. State is one status per key plus the rows inside the delay. ``edges`` is the fixed
    list of moves (from_state NULL for the entry). The stream's session must use the RocksDB state store.
    """
    allowed = {(r["from_state"], r["to_state"]) for r in edges.filter(F.col("machine") == machine).collect()}
    kind = dict(stream.dtypes)
    kinds = {"micros": "bigint", "tie": kind[tie], "status": "string"}
    out = T.StructType.fromDDL(f"{key} {kind[key]}, tie {kind[tie]}, from_state string, status string")
    rows = stream.withWatermark(ts, delay).select(key, ts, F.unix_micros(ts).alias("micros"), F.col(tie).alias("tie"), F.col(status).cast("string").alias("status"))
    checked = rows.groupBy(key).transformWithState(
        MoveChecker(key, allowed, kinds, out.names), outputStructType=out, outputMode="Append", timeMode="EventTime"
    )
    return checked.withColumnRenamed("tie", tie)

