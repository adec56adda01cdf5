"""The tick operators as Structured Streaming jobs: each takes a streaming DataFrame and a sink folder or callback.

Every job names its watermark and output mode, writes with exactly-once sinks (files, or foreachBatch with a
deterministic overwrite by batch id) and is driven by `availableNow`, so that the same code runs as a catch-up batch.
"""

from __future__ import annotations

import json
import os
import uuid
from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor

from ..operators import ticks as tk
from ..sources.io import work_dir


def read_ticks(spark: SparkSession, path: str) -> DataFrame:
    """A stream of tick files (Parquet; a folder or one file) with a plain timestamp column."""
    schema = spark.read.parquet(path).schema
    pattern = f"{path[:-1]}[{path[-1]}]"  # a pattern may match a single file, a plain path must be a folder
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 64).parquet(pattern).withColumn("ts", F.col("ts").cast("timestamp"))


def drain(df: DataFrame, out: str, *, mode: str = "append", each: Callable[[DataFrame, int], None] | None = None) -> None:
    """Runs the stream until its input is used up."""
    w = df.writeStream.outputMode(mode).option("checkpointLocation", f"{out}-state").trigger(availableNow=True)
    w = w.foreachBatch(each) if each else w.format("parquet").option("path", out)
    query = w.start()
    query.awaitTermination()


def _out(spark: SparkSession, name: str) -> str:
    return os.path.join(work_dir(spark), f"{name}-{uuid.uuid4().hex}")


def windowed_counts(ticks: DataFrame, *, width: str = "1 hour", slide: str | None = None, late: str = "1 day") -> DataFrame:
    """Appended window counts; rows later than the watermark are dropped."""
    return tk.tumbling(ticks.withWatermark("ts", late), width, ["event_type"], slide=slide)


def session_counts(ticks: DataFrame, *, gap: str = "30 minutes", late: str = "1 day") -> DataFrame:
    return tk.sessions(ticks.withWatermark("ts", late), gap, ["user_id"])


ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def drain_keyed(df: DataFrame, out: str, mode: str = "update") -> None:
    """Runs a stream with keyed state until its input is used up; each batch's rows are written to their own folder of
    out (column batch), over again if the batch is repeated. State lies in RocksDB under the checkpoint: a batch reads and
    writes just the state of its own keys, and a job that is started again goes on where the last one stopped."""
    spark, key = df.sparkSession, "spark.sql.streaming.stateStore.providerClass"
    held = spark.conf.get(key, None)
    spark.conf.set(key, ROCKSDB)
    try:
        drain(df, out, mode=mode, each=lambda batch, n: batch.write.mode("overwrite").parquet(f"{out}/batch={n}"))
    finally:
        spark.conf.set(key, held) if held else spark.conf.unset(key)


class _Latest(StatefulProcessor):
    """Keeps the key's newest row by (ts, event_id) and tells it when it changes."""

    def init(self, handle) -> None:
        self.last = handle.getValueState("last", "ts long, event_id long, value double")

    def handleInputRows(self, key, rows, timers):
        best = self.last.get() if self.last.exists() else None
        new = best
        for part in rows:
            for row in zip(part["ts"].tolist(), part["event_id"].tolist(), part["value"].tolist(), strict=True):
                if new is None or row[:2] > tuple(new[:2]):
                    new = row
        if new is not best:
            self.last.update(tuple(new))
            yield pd.DataFrame({"user_id": [key[0]], "ts": [new[0]], "event_id": [new[1]], "value": [new[2]]})

    def close(self) -> None:
        pass


def latest_state(ticks: DataFrame, out: str) -> None:
    """Upsert of the latest tick of each key: out gets the keys that each batch changed; `read_latest` reads the state."""
    rows = ticks.select("user_id", F.unix_micros("ts").alias("ts"), "event_id", "value")
    changes = rows.groupBy("user_id").transformWithStateInPandas(_Latest(), "user_id long, ts long, event_id long, value double", "Update", "None")
    drain_keyed(changes.select("user_id", F.timestamp_micros("ts").alias("ts"), "event_id", "value"), out)


def read_latest(spark: SparkSession, out: str) -> DataFrame:
    """The latest row of each key that latest_state has written."""
    return tk.latest(spark.read.parquet(out), ["user_id"], ["ts", "event_id", "value"], ("ts", "event_id"))


def first_write_wins(ticks: DataFrame, deadlines: DataFrame, out: str, *, minutes: int = 15, late: str = "400 days") -> None:
    """Of the rows at least `minutes` before their day's deadline the first written of each key and day stays for good.

    Within a batch the earliest row counts as first; rows after the freeze and later rows of a key are left out. Rows of
    days before the watermark, whole days behind the newest one, are dropped, so that these days' state can go.

    The state is an aggregate by key and day: the least of (time of the batch, ts, event_id). A batch writes the keys
    whose first row it brought; the time of a batch is in the stream's own log, so a repeated batch has it again.
    """
    rows = ticks.withColumn("day", F.col("ts").cast("date")).join(F.broadcast(deadlines), "day")  # one row a day
    open_ = rows.filter(F.col("ts") <= F.col("deadline") - F.make_dt_interval(mins=F.lit(minutes)))
    named = open_.select("user_id", F.date_trunc("day", "ts").alias("start"), F.current_timestamp().alias("at"), "ts", "event_id").withWatermark("start", late)
    first = named.groupBy("user_id", "start").agg(F.min(F.struct("at", "ts", "event_id")).alias("first")).filter(F.col("first.at") == F.current_timestamp())
    drain_keyed(first.select("user_id", F.col("start").cast("date").alias("day"), "first.event_id"), out)


def _packed(ids: np.ndarray, kinds: np.ndarray) -> tuple[bytes, bytes, str]:
    """Events in the order of their ids as one value of a state."""
    order = np.argsort(ids)
    codes, names = pd.factorize(kinds[order])
    return ids[order].astype("<i8").tobytes(), codes.astype("<i4").tobytes(), json.dumps(names.tolist())


class _Deliveries(StatefulProcessor):
    """A subscriber's deliveries: `cap` in a batch, the others wait for its next batch.

    Waiting events lie in the state in packed runs, each under its lowest id: a batch reads the runs that hold one of its
    `cap` lowest events, and rows go through in parts, so that no task holds a subscriber's batch.
    """

    def __init__(self, cap: int):
        self.cap = cap

    def init(self, handle) -> None:
        self.waiting = handle.getMapState("waiting", "lowest long", "ids binary, codes binary, names string")

    def _keep(self, ids: np.ndarray, kinds: np.ndarray) -> None:
        if len(ids):
            self.waiting.updateValue((int(ids.min()),), _packed(ids, kinds))

    def _run(self, lowest: int) -> tuple[np.ndarray, np.ndarray]:
        ids, codes, names = self.waiting.getValue((lowest,))
        return np.frombuffer(ids, "<i8"), np.array(json.loads(names), object)[np.frombuffer(codes, "<i4")]

    def handleInputRows(self, key, rows, timers):
        def told(ids, kinds, sent, silent):
            return pd.DataFrame({"subscriber": key[0], "event_id": ids, "event_type": kinds, "sent": sent, "silent": silent})

        waiting = sorted(k[0] for k in self.waiting.keys())
        ids, kinds = np.zeros(0, np.int64), np.zeros(0, object)  # the lowest new events so far
        for part in rows:
            quiet = part["silent"].to_numpy(bool)
            new, its = part["event_id"].to_numpy(np.int64), part["event_type"].to_numpy(object)
            if quiet.any():
                yield told(new[quiet], its[quiet], False, True)
            new, its = np.concatenate([ids, new[~quiet]]), np.concatenate([kinds, its[~quiet]])
            order = np.argsort(new, kind="stable")
            chosen, rest = order[: self.cap], order[self.cap :]
            ids, kinds = new[chosen], its[chosen]
            if len(rest):
                self._keep(new[rest], its[rest])
                yield told(new[rest], its[rest], False, False)
        runs = {}
        best = ids
        for lowest in waiting:
            if len(best) >= self.cap and lowest > best[-1]:
                break
            runs[lowest] = self._run(lowest)
            best = np.sort(np.concatenate([best, runs[lowest][0]]))[: self.cap]
        now = np.isin(ids, best)
        if now.any():
            yield told(ids[now], kinds[now], True, False)
        if not now.all():
            self._keep(ids[~now], kinds[~now])
            yield told(ids[~now], kinds[~now], False, False)
        for lowest, (held, its) in runs.items():
            now = np.isin(held, best)
            if now.any():
                self.waiting.removeKey((lowest,))
                self._keep(held[~now], its[~now])
                yield told(held[now], its[now], True, False)

    def close(self) -> None:
        pass


def latest_subscriptions(subscribers: DataFrame) -> DataFrame:
    """subscriber, event_type, since, silent: of several subscriptions of a device to a kind the one created last counts.

    Missing columns: created (all alike), since (null: from the start), silent (false).
    """
    has = lambda c, v: F.col(c) if c in subscribers.columns else v
    rows = subscribers.select("subscriber", "event_type", has("created", F.lit(0)).alias("created"), has("since", F.lit(None).cast("timestamp")).alias("since"), has("silent", F.lit(False)).alias("silent"))
    best = F.max_by(F.struct("since", "silent"), F.struct("created", "since", "silent")).alias("s")
    return rows.groupBy("subscriber", "event_type").agg(best).select("subscriber", "event_type", "s.since", F.coalesce("s.silent", F.lit(False)).alias("silent"))


def notify(ticks: DataFrame, subscribers: DataFrame, out: str, *, cap: int = 3) -> None:
    """Rows subscriber, event_id, event_type, sent, silent: new ticks joined with the subscribers of their kind, each pair once.

    subscribers: subscriber long, event_type, and where given created, since (baseline: earlier ticks are not new) and
    silent (recorded, not sent, not counted); see `latest_subscriptions`. A batch sends at most `cap` to a subscriber,
    lowest ids first; the others are written as not sent and wait in the subscriber's state for its next batch with
    something new for it. A batch reads and writes the state of its own subscribers and pairs only: which pairs were seen
    is the state of Spark's own deduplication, spread over all tasks by pair.
    """
    held = latest_subscriptions(subscribers)
    hits = ticks.select("event_id", "event_type", "ts").join(held, "event_type").filter(F.col("since").isNull() | (F.col("ts") > F.col("since")))
    rows = hits.select(F.col("subscriber").cast("long").alias("subscriber"), F.col("event_id").cast("long").alias("event_id"), "event_type", "silent")
    rows = rows.filter("event_id IS NOT NULL").dropDuplicates(["subscriber", "event_id"])
    sent = rows.groupBy("subscriber").transformWithStateInPandas(_Deliveries(cap), "subscriber long, event_id long, event_type string, sent boolean, silent boolean", "Append", "None")
    drain_keyed(sent, out, mode="append")


def stale(ticks: DataFrame, *, late: str = "1 day", hours: int = 24) -> DataFrame:
    """Kinds with the time of their last tick, by day, for a heartbeat."""
    return ticks.withWatermark("ts", late).groupBy(F.window("ts", f"{hours} hours").alias("w"), "event_type").agg(F.max("ts").alias("last")).select(F.col("w.start").alias("start"), "event_type", "last")
