"""Structured Streaming operators.

Streams read files as they land (file source with a fixed schema), sinks
are file sinks or ``foreachBatch`` writers under the shared checkpoint
folder, and every query keeps its own checkpoint there, so a restarted
driver or a lost executor resumes from the last committed batch.  Stateful
custom logic uses ``transformWithStateInPandas`` (state kept per key in RocksDB,
read a time slice at a time, opened by event-time timers).
"""

from __future__ import annotations

import pickle
from typing import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from tessera.session import scratch_path


def drain(query):
    """Wait until an availableNow query has taken everything; surface its failure."""
    query.awaitTermination()
    if query.exception() is not None:
        raise RuntimeError(str(query.exception()))
    return query


def to_files(stream: DataFrame, path: str, checkpoint: str, fmt: str = "parquet", by: str | None = None):
    """Append sink (exactly-once file sink) drained with availableNow; a folder
    for each value of ``by``, if given."""
    w = stream.writeStream.format(fmt).option("path", path).option("checkpointLocation", checkpoint).outputMode("append")
    if by:
        w = w.partitionBy(by)
    return drain(w.trigger(availableNow=True).start())


def to_table_snapshot(stream: DataFrame, path: str, checkpoint: str, mode: str = "complete"):
    """Aggregates in complete/update mode: each micro-batch writes a folder of
    its own (``foreachBatch``), so a batch that fails leaves the earlier ones as
    they are and a repeated one replaces itself.  ``read_snapshot`` takes the last."""
    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch={batch_id}")
    w = stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).outputMode(mode)
    return drain(w.trigger(availableNow=True).start())


def read_snapshot(query, spark: SparkSession, path: str) -> DataFrame:
    """What the last micro-batch of a drained query has written."""
    last = max(p["batchId"] for p in query.recentProgress)
    return spark.read.parquet(f"{path}/batch={last}")


def late_rows(query) -> int:
    """Rows that came after the watermark had passed their window, by the
    query's own progress reports (they count what reaches the state: rows of one
    window and partition are already one partial aggregate).  Reports that the
    session no longer holds would be missed, so that is an error."""
    reports = query.recentProgress
    if reports and reports[0]["batchId"] > 0:
        raise RuntimeError("raise spark.sql.streaming.numRecentProgressUpdates: early batches are no longer held")
    return sum(int(s["numRowsDroppedByWatermark"]) for p in reports for s in p["stateOperators"])


def first_seen(stream: DataFrame, id_col: str, path: str, checkpoint: str):
    """Each id once, in the micro-batch that first has it, for as long as ``path``
    lasts: nothing expires and the stream keeps no state.

    The output is its own memory: a batch's distinct ids, less those of the
    folders of earlier batches (an exact anti-join on the id alone), become the
    folder of that batch.  A repeated batch reads the same earlier folders and
    replaces its own.  A null id is one id."""
    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        fresh = batch.select(id_col).distinct()
        if batch_id:
            earlier = spark.read.schema(fresh.schema).option("basePath", path).parquet(*[f"{path}/batch={k}" for k in range(batch_id)]) \
                .select(F.col(id_col).alias("_seen"))
            fresh = fresh.join(earlier, F.col(id_col).eqNullSafe(F.col("_seen")), "left_anti")
        fresh.write.mode("overwrite").parquet(f"{path}/batch={batch_id}")
    w = stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    return drain(w.trigger(availableNow=True).start())


def file_stream(spark: SparkSession, path: str, schema, fmt: str = "parquet", max_files: int = 2,
                clean: str | None = None, archive: str | None = None) -> DataFrame:
    r = spark.readStream.schema(schema).option("maxFilesPerTrigger", max_files)
    if clean:
        r = r.option("cleanSource", clean)
        if archive:
            r = r.option("sourceArchiveDir", archive)
    if fmt == "csv":
        r = r.option("header", True)
    return r.format(fmt).load(path)


def land(df: DataFrame, name: str, n_files: int = 8, fmt: str = "parquet", order: str | None = None) -> str:
    """Write a table as several files for a file stream to pick up."""
    path = scratch_path(df.sparkSession, name)
    d = df.repartitionByRange(n_files, order) if order else df.repartition(n_files)
    w = d.write.option("header", True) if fmt == "csv" else d.write
    w.format(fmt).save(path)
    return path


def land_in_order(df: DataFrame, name: str, order: str, n_files: int = 8, end: dict | None = None) -> str:
    """Writes a table as files that follow each other in ``order`` and in time,
    as a producer hands them over.  ``end``: column values of a last file of one
    row, behind all others, which lets a watermark pass everything before it."""
    spark, path = df.sparkSession, scratch_path(df.sparkSession, name)
    cuts = df.agg(F.percentile_approx(F.col(order).cast("double"), [i / n_files for i in range(1, n_files)], 1000)).first()[0] or []
    cut = sum((F.col(order).cast("double") > float(c)).cast("int") for c in cuts) if cuts else F.lit(0)
    staged = scratch_path(spark, f"{name}-staged")
    df.withColumn("_file", cut).write.partitionBy("_file").parquet(staged)
    rows = spark.read.parquet(staged)
    for k in range(len(cuts) + 1):
        rows.where(F.col("_file") == k).select(*df.columns).coalesce(1).write.mode("append").parquet(path)
    if end:
        spark.range(1).select(*[(end[f.name] if f.name in end else F.lit(None)).cast(f.dataType).alias(f.name) for f in df.schema]) \
            .write.mode("append").parquet(path)
    return path


# --------------------------------------------------------------- stateful
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


class InOrder(StatefulProcessor):
    """Hands a key's rows on in event-time order, whatever micro-batch they came
    in: rows wait in slices of ``width`` seconds, a slice in the state store under
    its number, and an event-time timer opens it when the watermark has passed
    it.  So one slice of a key is in memory at a time, not the key.

    Subclasses say, with ``step``, what becomes of the ordered rows of a slice
    and what the key keeps (``memory``, a row of ``memory_schema``)."""

    memory_schema = ""

    def __init__(self, order: list[str], schema: str, columns: list[str], width: float):
        self.order, self.schema, self.columns, self.width = order, schema, columns, width

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.held = handle.getMapState("held", "slice bigint", "rows binary")
        self.kept = handle.getValueState("kept", self.memory_schema)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        for pdf in rows:   # one Arrow batch of the key
            at = np.floor(pdf[self.order[0]].astype(float) / self.width).astype("int64")
            for number, some in pdf[self.columns].groupby(at.to_numpy()):
                slice_key = (int(number),)
                new = some.to_dict("list")
                if self.held.containsKey(slice_key):
                    old = pickle.loads(self.held.getValue(slice_key)[0])
                    new = {c: old[c] + new[c] for c in self.columns}
                else:
                    self.handle.registerTimer(int((number + 1) * self.width * 1000))
                self.held.updateValue(slice_key, (pickle.dumps(new),))
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        number = round(expiredTimerInfo.getExpiryTimeInMs() / 1000 / self.width) - 1
        slice_key = (int(number),)
        if self.held.containsKey(slice_key):
            rows = pd.DataFrame(pickle.loads(self.held.getValue(slice_key)[0])).sort_values(self.order, kind="stable")
            self.held.removeKey(slice_key)
            out, memory = self.step(rows, self.kept.get() if self.kept.exists() else None)
            self.kept.update(memory)
            for k, v in zip(self.keys, key):
                out[k] = v
            yield out[self.out]

    def step(self, rows: pd.DataFrame, memory: tuple | None) -> tuple[pd.DataFrame, tuple]:
        raise NotImplementedError

    def over(self, stream: DataFrame, keys: list[str], event_time: str, delay: str) -> DataFrame:
        """The ordered rows of every key; ``event_time`` is a timestamp that agrees
        with the seconds in ``order[0]``."""
        self.keys = keys
        named = ", ".join(f"{k} {stream.schema[k].dataType.simpleString()}" for k in keys)
        self.out = [*keys, *[c.split()[0] for c in self.schema.split(", ")]]
        stream.sparkSession.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
        return stream.withWatermark(event_time, delay).groupBy(*keys).transformWithStateInPandas(
            self, f"{named}, {self.schema}", "Append", "EventTime")


class CounterRate(InOrder):
    """(value - prev) / dt / 1024 from a key's previous sample: negative
    differences are 0, dt is at least 1e-6, the first sample has none."""

    memory_schema = "t double, v double"

    def __init__(self, order_id: str, t: str, value: str, width: float = 3600.0):
        super().__init__([t, order_id], f"{order_id} bigint, rate double", [t, order_id, value], width)
        self.id, self.t, self.value = order_id, t, value

    def step(self, rows, memory):
        at, v = rows[self.t].astype(float).to_numpy(), rows[self.value].astype(float).to_numpy()
        first = memory or (float("nan"), float("nan"))
        dt, dv = np.diff(at, prepend=first[0]), np.diff(v, prepend=first[1])
        rate = pd.Series(np.maximum(dv, 0.0) / np.maximum(dt, 1e-6) / 1024.0, dtype=object)
        out = pd.DataFrame({self.id: rows[self.id].astype("int64").to_numpy(), "rate": rate.where(rate.notna(), None)})
        return out, (float(at[-1]), float(v[-1]))


class BurstLimit(InOrder):
    """At most ``burst`` rows of a key are let through within ``interval``
    seconds; the key keeps the times of those (at most ``burst``)."""

    memory_schema = "times array<double>"

    def __init__(self, order_id: str, t: str, burst: int, interval: float, width: float = 3600.0):
        super().__init__([t, order_id], f"{order_id} bigint, accepted boolean", [t, order_id], width)
        self.id, self.t, self.burst, self.interval = order_id, t, burst, interval

    def step(self, rows, memory):
        times, accepted = list(memory[0]) if memory else [], []
        for now in rows[self.t].astype(float).tolist():
            times = [w for w in times if now - w <= self.interval]
            accepted.append(len(times) < self.burst)
            if accepted[-1]:
                times.append(now)
        return pd.DataFrame({self.id: rows[self.id].astype("int64").to_numpy(), "accepted": accepted}), (times,)


def foreach_batch_sink(stream: DataFrame, sink: Callable[[DataFrame, int], None], checkpoint: str):
    """Any callable as a sink (the reference's sink adapter)."""
    w = stream.writeStream.foreachBatch(sink).option("checkpointLocation", checkpoint)
    return drain(w.trigger(availableNow=True).start())
