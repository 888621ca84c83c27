"""Keyed state on streams.

* ``case_status_stream``: an arbitrary-state processor per bucket of cases. The state is
  each case's latest status; an event-time timer stands at the first expiry, and a closed
  case leaves the state a retention period after its last update.
* ``failed_login_stream``: transactions and logins joined on the account within an
  interval of event time, both sides watermarked, then counted per transaction.
* ``account_history_stream``: an arbitrary-state processor per account. The state is
  a ring of hour totals over the look-back and the rows of the hours that may still
  be cut by its ends, so a value needs the ring and two hours' rows.
* ``drift_window_stream``: one histogram per (window, feature) against the static
  reference's bins, as conditional counts in an ordinary windowed aggregation (so it
  is merged map-side and by the state store); PSI is computed as a window closes.

State lives in Spark's state stores under the query's checkpoint; the processors need
the RocksDB provider (``rocksdb_state``). Rows later than the watermark are dropped.

Append-mode results appear when the watermark passes them. A bounded input is ended by
a marker: a row of filler values with the time ``END``, read from a folder of its own
after all data (``EndMarker``); it moves the watermark past everything and is then filtered."""

from __future__ import annotations

import datetime as dt
import os
from bisect import bisect_left
from collections.abc import Iterator, Sequence
from contextlib import contextmanager

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from ledgerlens.operators import drift as G
from ledgerlens.streaming.scoring import run_available_now

PROVIDER = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
END = dt.datetime(9000, 1, 1)
HOUR = 3_600_000_000
CLOSED_STATUSES = ("RESOLVED_FRAUD", "RESOLVED_GENUINE")


@contextmanager
def rocksdb_state(spark: SparkSession) -> Iterator[None]:
    """Queries started (and state read) inside use the RocksDB state store."""
    before = spark.conf.get(PROVIDER)
    spark.conf.set(PROVIDER, ROCKSDB)
    try:
        yield
    finally:
        spark.conf.set(PROVIDER, before)


class EndMarker:
    """Ends a bounded stream: ``attach`` unions the stream with a folder that is empty until
    ``write`` puts the marker row there."""

    def __init__(self, spark: SparkSession, folder: str, ts: str):
        self.spark, self.folder, self.ts = spark, folder, ts

    def attach(self, stream: DataFrame) -> DataFrame:
        self.schema = stream.schema
        self.spark.createDataFrame([], self.schema).write.mode("overwrite").parquet(self.folder)
        return stream.unionByName(self.spark.readStream.schema(self.schema).parquet(self.folder))

    def write(self) -> None:
        # no nulls: a join's inferred IS NOT NULL is pushed below the watermark and would take the row
        filler = {"string": "", "timestamp": END, "timestamp_ntz": END, "boolean": False, "double": 0.0, "float": 0.0}
        row = tuple(END if f.name == self.ts else filler.get(f.dataType.simpleString(), 0) for f in self.schema)
        self.spark.createDataFrame([row], self.schema).coalesce(1).write.mode("append").parquet(self.folder)


def event_time(stream: DataFrame, ts: str, watermark: str) -> DataFrame:
    """Cast (TIMESTAMP_NTZ has no watermark), watermark, and drop the end marker. The filter
    names the time column, so it is not pushed below the watermark."""
    return (stream.withColumn(ts, F.col(ts).cast("timestamp")).withWatermark(ts, watermark)
            .where(F.col(ts) < F.lit(END).cast("timestamp")))


def drain_to_end(stream: DataFrame, markers: Sequence[EndMarker], sink: str, checkpoint: str) -> None:
    """Drain all data, then the markers: every window and timer closes."""
    run_available_now(stream, sink, checkpoint)
    for m in markers:
        m.write()
    run_available_now(stream, sink, checkpoint)


class CaseStatus(StatefulProcessor):
    """Latest (updated_at, status) of each case of a bucket, in this order; closed cases expire.
    The state's arrays are by case, so a bucket takes a few calls to the store, not a few per case."""

    def __init__(self, closed: Sequence[str], keep_ms: int):
        self.closed, self.keep_ms = tuple(closed), keep_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        # timer: the first expiry among the closed cases
        self.latest = handle.getValueState("latest", "case_ids array<string>, us array<long>, statuses array<string>, timer long")

    def _held(self):
        ids, us, statuses, timer = self.latest.get() or ((), (), (), None)
        return dict(zip(ids, zip(us, statuses))), timer

    def _expiry(self, us: int, status: str | None) -> int | None:
        return us // 1000 + self.keep_ms if status in self.closed else None

    def _hold(self, held: dict, timer: int | None) -> None:
        """Write the bucket; ``timer`` is the one still registered."""
        first = min((x for v in held.values() if (x := self._expiry(*v)) is not None), default=None)
        if first != timer:
            if timer is not None:
                self.handle.deleteTimer(timer)
            if first is not None:
                self.handle.registerTimer(first)
        if held:
            us, statuses = zip(*held.values())
            self.latest.update((list(held), list(us), list(statuses), first))
        else:
            self.latest.clear()

    def handleInputRows(self, key, rows, timerValues):
        rank = lambda v: (v[0], v[1] is not None, v[1] or "")  # noqa: E731  (a null status sorts first)
        new = {}
        for pdf in rows:
            for case, us, status in zip(pdf["case_id"], pdf["us"].tolist(), pdf["status"]):
                if case not in new or rank((us, status)) > rank(new[case]):
                    new[case] = us, status
        held, timer = self._held()
        changed = {c: v for c, v in new.items() if c not in held or rank(v) > rank(held[c])}
        if not changed:
            return
        held.update(changed)
        self._hold(held, timer)
        us, statuses = zip(*changed.values())
        yield pd.DataFrame({"case_id": list(changed), "status": list(statuses), "us": list(us)})

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        """Drop every closed case whose time is up (the fired timer goes by itself)."""
        mark = max(expiredTimerInfo.getExpiryTimeInMs(), timerValues.getCurrentWatermarkInMs() - 1)
        held, _ = self._held()
        self._hold({c: v for c, v in held.items() if (x := self._expiry(*v)) is None or x > mark}, None)
        yield from ()

    def close(self) -> None:
        pass


def case_status_stream(events: DataFrame, watermark: str = "1 day", keep_days: int = 30,
                       closed: Sequence[str] = CLOSED_STATUSES, buckets: int = 2048) -> DataFrame:
    """(case_id, status, updated_at timestamp) updates -> a row whenever a case's latest
    status changes. Use update mode and :func:`rocksdb_state`. Cases are kept by the hash of
    their id in ``buckets`` (fixed for a checkpoint), each read and written whole when a batch
    touches it: set so many that a bucket's live cases are some thousands."""
    e = event_time(events.select("case_id", "status", "updated_at"), "updated_at", watermark).where(F.col("case_id").isNotNull())
    e = e.select(F.pmod(F.xxhash64("case_id"), F.lit(buckets)).alias("bucket"), "case_id", "status", F.unix_micros("updated_at").alias("us"), "updated_at")
    out = e.groupBy("bucket").transformWithStateInPandas(
        CaseStatus(closed, keep_days * 86_400_000), "case_id string, status string, us long", "Update", "EventTime")
    return out.select("case_id", "status", F.timestamp_micros("us").alias("updated_at"))


def case_states(spark: SparkSession, checkpoint: str) -> DataFrame:
    """The cases that a drained status stream still holds: case_id, updated_at, status."""
    with rocksdb_state(spark):
        state = spark.read.format("statestore").option("stateVarName", "latest").load(checkpoint)
        held = state.select(F.inline(F.arrays_zip(*[F.col(f"value.{c}").alias(c) for c in ("case_ids", "us", "statuses")])))
        return held.select(F.col("case_ids").alias("case_id"), F.timestamp_micros("us").alias("updated_at"), F.col("statuses").alias("status"))


def failed_login_stream(tx: DataFrame, logins: DataFrame, account: str = "account_id", ts: str = "timestamp", minutes: int = 60,
                        watermark: str = "10 minutes", key: str = "event_id", out: str = "failed_login_count_1h") -> DataFrame:
    """L2 on streams: per transaction, the account's failed logins in [ts - minutes, ts].
    State is bounded on both sides: a login leaves it when the transactions' watermark has
    passed it by the interval, a transaction when the logins' watermark has passed it."""
    left = event_time(tx.select(key, account, ts), ts, watermark)
    right = event_time(logins.select(F.col(account).alias("_account"), F.col(ts).alias("_at")), "_at", watermark)
    within = ((F.col(account) == F.col("_account")) & (F.col("_at") <= F.col(ts))
              & (F.col("_at") >= F.col(ts) - F.expr(f"INTERVAL {minutes} MINUTES")))
    return (left.join(right, within, "leftOuter").groupBy(key, account, ts)
            .agg(F.count("_at").cast("int").alias(out)))


class AccountHistory(StatefulProcessor):
    """Values of a transaction from the account's earlier ones (see :func:`account_history_stream`)."""

    def __init__(self, days: int):
        self.hours = 24 * days

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        # Ring place h % hours holds the totals of hour h, for the hours (last - hours, last].
        self.ring = handle.getValueState("ring", "last long, sums array<double>, counts array<long>")
        self.rows = handle.getMapState("rows", "hour long", "ts array<long>, ids array<long>, amounts array<double>")
        self.waiting = handle.getValueState("waiting", "ts array<long>, ids array<long>")

    def _hour(self, h: int):
        got = self.rows.getValue((h,)) if self.rows.containsKey((h,)) else None
        return tuple(np.array(x) for x in got) if got else (np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0))

    def handleInputRows(self, key, rows, timerValues):
        """New rows join their hour and wait for the watermark."""
        new = pd.concat(list(rows))
        ts = new["us"].to_numpy(np.int64)
        columns = ts, new["id"].to_numpy(np.int64), new["value"].to_numpy(float)
        for h in np.unique(ts // HOUR).tolist():
            at = ts // HOUR == h
            self.rows.updateValue((h,), tuple(np.r_[old, c[at]].tolist() for old, c in zip(self._hour(h), columns)))
        waiting = self.waiting.get() if self.waiting.exists() else ([], [])
        self.waiting.update(([*waiting[0], *ts.tolist()], [*waiting[1], *columns[1].tolist()]))
        self.handle.registerTimer(int(ts.max() // 1000) + 1)
        yield from ()

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        """The watermark has passed waiting rows: all that precedes them is known."""
        mark = timerValues.getCurrentWatermarkInMs() * 1000
        ts, ids = (np.array(x, np.int64) for x in (self.waiting.get() if self.waiting.exists() else ([], [])))
        ready = ts < mark
        order = np.lexsort((ids[ready], ts[ready]))
        due = list(zip(ts[ready][order].tolist(), ids[ready][order].tolist()))
        if not due:
            return
        if ready.all():
            self.waiting.clear()
        else:
            self.waiting.update((ts[~ready].tolist(), ids[~ready].tolist()))
            self.handle.registerTimer(int(ts[~ready].max() // 1000) + 1)
        hours = sorted(k[0] for k in self.rows.keys())
        seen = {}

        def hour(h):
            if h not in seen:
                seen[h] = self._hour(h)
            return seen[h]

        n_hours = self.hours
        if self.ring.exists():
            last, sums, counts = self.ring.get()
            last, sums, counts = int(last), np.array(sums, float), np.array(counts, np.int64)
        else:
            last, sums, counts = hours[0], np.zeros(n_hours), np.zeros(n_hours, np.int64)
        out = []
        for t, i in due:
            h = t // HOUR
            if h > last:
                # hours ended by now enter the ring, those a look-back ago leave it
                gone = np.arange(max(last, h - n_hours) + 1, h + 1) % n_hours
                sums[gone], counts[gone] = 0.0, 0
                for x in hours[bisect_left(hours, max(last, h - n_hours + 1)):bisect_left(hours, h)]:
                    sums[x % n_hours], counts[x % n_hours] = hour(x)[2].sum(), len(hour(x)[2])
                last = h
            at, who, amounts = hour(h)
            before = amounts[at < t]
            edge = hour(h - n_hours)
            edge = edge[2][edge[0] >= t - n_hours * HOUR]
            whole = np.arange(h - n_hours + 1, h) % n_hours
            n = int(counts[whole].sum()) + len(before) + len(edge)
            today = sums[np.arange(h // 24 * 24, h) % n_hours].sum() + amounts[(at < t) | ((at == t) & (who < i))].sum()
            out.append((i, t, float(today), float(sums[whole].sum() + before.sum() + edge.sum()) / n if n else None))
        self.ring.update((last, sums.tolist(), counts.tolist()))
        for x in hours[:bisect_left(hours, last - n_hours)]:
            self.rows.removeKey((x,))
        yield pd.DataFrame(out, columns=["id", "us", "daily_total_before_txn", "avg_amount_30d"]).assign(who=key[0]).astype({"avg_amount_30d": float})

    def close(self) -> None:
        pass


def account_history_stream(tx: DataFrame, account: str = "account_id", ts: str = "timestamp", amount: str = "amount", key: str = "event_id",
                           days: int = 30, watermark: str = "1 hour") -> DataFrame:
    """L3 and L4 on a stream: account, key, ts, the sum of the account's earlier
    transactions of the same UTC day (by ts, key) and the mean of those in [ts - days, ts).
    A row appears when the watermark has passed it; append mode, :func:`rocksdb_state`."""
    e = event_time(tx.select(account, key, ts, amount), ts, watermark)
    e = e.where(F.col(account).isNotNull() & F.col(amount).isNotNull()).select(
        F.col(account).cast("string").alias("who"), F.col(key).cast("long").alias("id"), F.unix_micros(ts).alias("us"), F.col(amount).cast("double").alias("value"), ts)
    out = e.groupBy("who").transformWithStateInPandas(
        AccountHistory(days), "id long, us long, daily_total_before_txn double, avg_amount_30d double, who string", "Append", "EventTime")
    return out.select(F.col("who").cast(tx.schema[account].dataType).alias(account), F.col("id").alias(key),
                      F.timestamp_micros("us").alias(ts), "daily_total_before_txn", "avg_amount_30d")


def drift_window_stream(reference: DataFrame, current: DataFrame, features: Sequence[str], ts: str, window: str = "1 day", n_bins: int = 10,
                        watermark: str = "1 hour", epsilon: float = 1e-6) -> DataFrame:
    """L9 on a stream: PSI of each closed window of ``current`` against the static
    ``reference`` (its edges and shares: one small row per feature). The state is one row
    of bin counts per open window and feature."""
    ref = G.numeric_long(reference.select(F.lit(G.REFERENCE).alias("side"), *features), features)
    edges = F.broadcast(G.bin_edges(ref, n_bins))  # features x bins numbers
    counts = [F.count_if(F.col("bin") == b).alias(f"b{b}") for b in range(n_bins)]
    binned = lambda long: long.join(edges, "feature").withColumn("bin", G.bin_index(F.col("value"), F.col("inner_edges"), n_bins))
    shares = binned(ref).groupBy("feature").agg(F.count(F.lit(1)).alias("rn"), F.max(F.size("inner_edges")).alias("last"), *[c.alias(f"r{b}") for b, c in enumerate(counts)])
    pairs = F.array(*[F.struct(F.lit(f).alias("feature"), F.col(f).try_cast("double").alias("value")) for f in features])
    long = event_time(current.select(ts, *features), ts, watermark).select(ts, F.inline(pairs)).where(F.col("value").isNotNull() & ~F.isnan("value"))
    closed = binned(long).groupBy(F.window(ts, window).alias("w"), "feature").agg(F.count(F.lit(1)).alias("cn"), *counts)
    at = closed.join(F.broadcast(shares), "feature")
    eps, zero = F.lit(epsilon), F.lit(0.0)

    def term(b: int):
        c, r = F.greatest(F.col(f"b{b}") / F.col("cn"), eps), F.greatest(F.col(f"r{b}") / F.col("rn"), eps)
        return F.when(F.col("last") >= b, (c - r) * F.ln(c / r)).otherwise(zero)

    psi = F.greatest(zero, sum((term(b) for b in range(1, n_bins)), term(0)))
    return at.select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), F.col("feature").alias("feature_name"),
                     F.col("cn").alias("current_count"), psi.alias("population_stability_index"), G.alert_level(psi).alias("alert_level"))


def run_changes_table(stream: DataFrame, path: str, checkpoint: str, key: str, order: Sequence[str]) -> DataFrame:
    """Drain a stream of changes into one folder per batch (written again, not twice, if a
    batch is retried) and return each key's latest change by ``order``."""
    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(os.path.join(path, f"batch={batch_id}"))

    with rocksdb_state(stream.sparkSession):
        q = (stream.writeStream.outputMode("update").foreachBatch(write)
             .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
        q.awaitTermination()
    if q.exception() is not None:
        raise q.exception()
    rest = [c for c in stream.columns if c != key]
    changes = stream.sparkSession.read.schema(stream.schema).parquet(path)
    latest = changes.groupBy(key).agg(F.max_by(F.struct(*rest), F.struct(*order)).alias("_e"))
    return latest.select(*[F.col(c) if c == key else F.col(f"_e.{c}").alias(c) for c in stream.columns])
