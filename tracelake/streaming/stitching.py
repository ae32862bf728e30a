"""Stitching of spans over two requests while they arrive."""

from __future__ import annotations

import json
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

TIMES = {"timestampFormat": "yyyy-MM-dd HH:mm:ss.SSSSSSXXX", "timestampNTZFormat": "yyyy-MM-dd HH:mm:ss.SSSSSS"}
ARRIVED = ["__session", "__salt", "__ms", "__span", "__trace", "__parent", "__time"]
GIVEN = "__span string, __trace string, __parent string"
#: Tasks that the spans of one session are spread over; each keeps the session's dispatch.
SALTS = 16
#: Waiting spans that are one entry of the state.
CHUNK = 1000


class _Stitcher(StatefulProcessor):
    """State of a share of a session: its dispatch, and the spans that came before it, in chunks ordered by time."""

    def __init__(self, skew_ms: int, timeout_ms: int):
        self.skew, self.timeout = skew_ms, timeout_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.dispatch = handle.getValueState("dispatch", "trace string, parent string, ms long")
        self.waiting = handle.getListState("waiting", "spans string, ms long")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        frames = list(rows)
        found = pd.concat(frames, ignore_index=True).set_axis(ARRIVED, axis=1)  # they come in this order, but without names
        spans = found[found["__span"].notna()]
        dispatches = found[found["__span"].isna()]
        known = self.dispatch.get() if self.dispatch.exists() else None
        fresh = known is None and len(dispatches) > 0
        if fresh:
            first = dispatches[dispatches["__ms"] == dispatches["__ms"].min()].sort_values(["__trace", "__parent"]).iloc[0]
            known = (first["__trace"], first["__parent"], int(first["__ms"]))
            self.dispatch.update(known)
            self.handle.registerTimer(known[2] + self.timeout)
        given, kept = self._sorted(spans["__span"].to_numpy(object), spans["__ms"].to_numpy("int64"), known)
        if len(given):
            yield self._out(given, known)
        if fresh and self.waiting.exists():
            for entry in self.waiting.get():
                given, more = self._sorted(*_opened(entry), known)
                kept = tuple(np.concatenate(pair) for pair in zip(kept, more))
                if len(given):
                    yield self._out(given, known)
            self.waiting.clear()
        self._keep(*kept)

    def _keep(self, spans: np.ndarray, times: np.ndarray) -> None:
        """Add waiting spans; the first of them calls again when it has waited long enough."""
        if len(spans):
            self.waiting.appendList(_chunks(spans, times))
            self.handle.registerTimer(int(times.min()) + self.timeout)

    def _sorted(self, spans: np.ndarray, times: np.ndarray, known) -> tuple[np.ndarray, tuple[np.ndarray, np.ndarray]]:
        due = np.zeros(len(spans), bool) if known is None else (times >= known[2] - self.skew) & (times <= known[2] + self.timeout)
        return spans[due], (spans[~due], times[~due])

    @staticmethod
    def _out(given: np.ndarray, known) -> pd.DataFrame:
        trace, parent = known[:2] if known else (None, None)
        return pd.DataFrame({"__span": given, "__trace": trace, "__parent": parent}, dtype=object)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        now = timerValues.getCurrentWatermarkInMs()
        if self.waiting.exists():
            kept, parted = [], False
            for entry in self.waiting.get():
                if entry[1] + self.timeout > now:
                    kept.append((entry[0], entry[1]))
                    continue
                spans, times = _opened(entry)
                late, parted = times + self.timeout <= now, True
                kept += _chunks(spans[~late], times[~late])
                yield self._out(spans[late], None)
            if parted:
                self.waiting.clear()
                if kept:
                    self.waiting.put(kept)
                    self.handle.registerTimer(min(ms for _, ms in kept) + self.timeout)
        if self.dispatch.exists() and self.dispatch.get()[2] + self.timeout <= now:
            self.dispatch.clear()

    def close(self) -> None:
        pass


def _chunks(spans: np.ndarray, times: np.ndarray) -> list[tuple[str, int]]:
    """Waiting spans as entries of the state, in order of time: a text of spans and times, and the first time."""
    order = np.argsort(times, kind="stable")
    cuts = [order[at : at + CHUNK] for at in range(0, len(order), CHUNK)]
    return [(json.dumps([spans[cut].tolist(), times[cut].tolist()]), int(times[cut[0]])) for cut in cuts]


def _opened(entry: tuple) -> tuple[np.ndarray, np.ndarray]:
    spans, times = json.loads(entry[0])
    return np.array(spans, dtype=object), np.array(times, dtype="int64")


def _earliest(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Of each session's dispatches in a batch the first, and the latest of all, which moves the watermark."""
    for rows in batches:
        first = rows.sort_values(["__ms", "__trace", "__parent"]).drop_duplicates("__session")
        last = rows.nlargest(1, "__ms") if len(rows) else rows
        yield pd.concat([first, last])


def _milliseconds(spark: SparkSession, interval: str) -> int:
    return int(spark.range(1).select((F.unix_micros(F.timestamp_seconds(F.lit(0)) + F.expr(f"INTERVAL {interval}")) / 1000).cast("long")).first()[0])


def stitch_stream(spans: DataFrame, dispatches: DataFrame, timeout: str = "1 hour", watermark: str = "10 minutes", skew: str = "1 minute") -> DataFrame:
    """Attach parentless spans to the dispatch of their session, whichever of the two arrives first.

    ``dispatches`` has ``session_id, trace_id, dispatch_span_id, dispatch_time``. A session has one dispatch: the first to
    arrive (of one batch the earliest), so a span is given out once, however often its dispatch is repeated. A span is attached as soon as both
    are there, if it starts within ``timeout`` after the dispatch, or ``skew`` before it; otherwise it waits, and goes out
    unattached once the watermark has passed its start by ``timeout``. State is the dispatch and the waiting spans of
    sessions that are open by that time. A session's spans are spread over ``SALTS`` tasks, each with its dispatch. Spans with a parent, or without a session, pass straight through. Rows older than the
    watermark are dropped, as by any stateful query.
    """
    spark = spans.sparkSession
    # Keyed state with timers is kept by this provider only; a running query keeps the one it began with.
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    loose = F.col("parent_span_id").isNull() & F.col("session_id").isNotNull()
    session = F.col("session_id").cast("string").alias("__session")
    no_text = F.lit(None).cast("string")
    arrived = spans.where(loose).select(session, _ms("start_time"), F.to_json(F.struct("*"), TIMES).alias("__span"), no_text.alias("__trace"), no_text.alias("__parent"), _time("start_time"))
    sent = dispatches.where("session_id IS NOT NULL").select(
        session, _ms("dispatch_time"), no_text.alias("__span"), F.col("trace_id").alias("__trace"), F.col("dispatch_span_id").alias("__parent"), _time("dispatch_time")
    )
    sent = sent.mapInPandas(_earliest, sent.schema).withColumn("__salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    arrived = arrived.withColumn("__salt", F.pmod(F.xxhash64("__span"), F.lit(SALTS)).cast("int"))
    both = arrived.select(*ARRIVED).unionByName(sent.select(*ARRIVED)).withWatermark("__time", watermark)
    stitcher = _Stitcher(_milliseconds(spark, skew), _milliseconds(spark, timeout))
    given = both.groupBy("__session", "__salt").transformWithStateInPandas(stitcher, GIVEN, "Append", "EventTime")
    span = F.from_json("__span", spans.schema, TIMES)
    attached = given.withColumn("__s", span)
    changed = {"trace_id": "__trace", "parent_span_id": "__parent"}
    columns = [F.coalesce(F.col(changed[c]), F.col("__s")[c]).alias(c) if c in changed else F.col("__s")[c].alias(c) for c in spans.columns]
    return attached.select(*columns).unionByName(spans.where(~loose))


def _ms(column: str) -> Column:
    return F.unix_millis(F.col(column).cast("timestamp")).alias("__ms")


def _time(column: str) -> Column:
    return F.col(column).cast("timestamp").alias("__time")
