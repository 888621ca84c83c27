"""Keyed state on streams: equal to the batch operators, with several batches, late rows,
and state that leaves (L2-L4, L8, L9)."""

import datetime as dt
import random
import time
from types import SimpleNamespace

import pandas as pd
import pytest
from pyspark.sql import functions as F

from ledgerlens.operators import drift as G
from ledgerlens.operators import features as L
from ledgerlens.streaming import keyed as K
from ledgerlens.streaming import scoring as S

T0 = dt.datetime(2024, 3, 1)


def at(minutes, micros=0):
    return T0 + dt.timedelta(minutes=minutes, microseconds=micros)


@pytest.fixture
def fed(spark, tmp_path):
    """A stream that reads the given lists of rows, one batch each, in order."""
    n = iter(range(100))

    def make(batches, schema):
        src = str(tmp_path / f"in{next(n)}")
        for i, rows in enumerate(batches):
            spark.createDataFrame(rows, schema).coalesce(1).write.parquet(f"{src}/b{i:02d}")
            time.sleep(0.02)  # files are read by modification time
        return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(f"{src}/b*")
    return make


def drained(spark, tmp_path, build, *streams, ts="timestamp"):
    markers = [K.EndMarker(spark, str(tmp_path / f"end{i}"), ts) for i in range(len(streams))]
    out = build(*[m.attach(s) for m, s in zip(markers, streams, strict=True)])
    K.drain_to_end(out, markers, str(tmp_path / "out"), str(tmp_path / "ck"))
    return spark.read.schema(out.schema).parquet(str(tmp_path / "out"))


def test_case_status_equals_batch_and_closed_cases_leave_the_state(spark, fed, tmp_path):
    days = lambda d: T0 + dt.timedelta(days=d)
    first = [("a", "UNDER_REVIEW", days(0)), ("a", "RESOLVED_FRAUD", days(2)), ("b", "UNDER_REVIEW", days(1)), ("c", "RESOLVED_GENUINE", days(1)), (None, "OPEN", days(1)),
             ("e", "ESCALATED", days(1)), ("e", "ESCALATED", days(1)), ("e", "CLOSED", days(1))]
    second = [("b", "ESCALATED", days(40)), ("c", "UNDER_REVIEW", days(39.5)), ("d", "RESOLVED_FRAUD", days(39))]
    third = [("f", "UNDER_REVIEW", days(41)), ("b", "UNDER_REVIEW", days(1.5)), ("d", "ESCALATED", days(40.9))]
    events = fed([first, second, third], "case_id string, status string, updated_at timestamp")
    ck = str(tmp_path / "ck")
    out = K.run_changes_table(K.case_status_stream(events, "1 day", 30), str(tmp_path / "out"), ck, "case_id", ("updated_at", "status"))
    got = {r["case_id"]: (r["status"], r["updated_at"]) for r in out.collect()}
    every = [r for r in (*first, *second, *third) if r[0]]
    want = {c: max((t, s) for k, s, t in every if k == c)[::-1] for c in {r[0] for r in every}}
    assert got == want
    held = {r["case_id"]: r["status"] for r in K.case_states(spark, ck).collect()}
    # a was closed on day 2 and has expired by day 40; c was reopened, d reopened, the others are open
    assert held == {"b": "ESCALATED", "c": "UNDER_REVIEW", "d": "ESCALATED", "e": "ESCALATED", "f": "UNDER_REVIEW"}


class Store:
    """A bucket's value state and timers in memory, counting the calls."""

    def __init__(self):
        self.value, self.timers, self.calls = None, set(), 0

    def getValueState(self, name, schema):  # noqa: N802
        return self

    def _called(self):
        self.calls += 1

    def get(self):
        return self._called() or self.value

    def update(self, value):
        self.value = self._called() or value

    def clear(self):
        self.value = self._called()

    def registerTimer(self, at):  # noqa: N802
        self._called() or self.timers.add(at)

    def deleteTimer(self, at):  # noqa: N802
        self._called() or self.timers.remove(at)


def test_cases_of_a_bucket_share_their_store_calls():
    """Calls to the store do not grow with a bucket's cases, nor do results with its expired ones."""
    store, p = Store(), K.CaseStatus(("DONE",), 1000)
    p.init(store)
    rows = pd.DataFrame({"case_id": [f"c{i % 500}" for i in range(1500)], "us": range(1500), "status": ["OPEN", "DONE"] * 750})
    out = pd.concat(p.handleInputRows((3,), iter([rows[:700], rows[700:]]), None))
    assert store.calls == 3 and store.timers == {1001}
    assert dict(zip(out["case_id"], zip(out["us"], out["status"]))) == {f"c{i}": (1000 + i, ("OPEN", "DONE")[i % 2]) for i in range(500)}
    assert not list(p.handleInputRows((3,), iter([rows]), None)) and store.calls == 4
    again = pd.DataFrame({"case_id": ["c1", "c499", "new", "new"], "us": [5_000, 1_499, 7, 7], "status": ["OPEN", None, None, "OPEN"]})
    assert sorted(pd.concat(p.handleInputRows((3,), iter([again]), None))["case_id"]) == ["c1", "new"]
    store.timers.clear()  # the one that fires
    fired = SimpleNamespace(getExpiryTimeInMs=lambda: 1001, getCurrentWatermarkInMs=lambda: 1002)
    assert not list(p.handleExpiredTimer((3,), fired, fired))
    # 1001 at once: closed at 1000 to 1499 us, all of them in millisecond 1 and due at 1001
    held = dict(zip(store.value[0], store.value[2]))
    assert set(held.values()) == {"OPEN"} and len(held) == 252 and not store.timers and store.value[3] is None


def test_case_buckets_over_batches_against_a_plain_walk(spark, fed, tmp_path):
    """Changes, latest statuses and the cases still held, of many cases in few buckets."""
    rng = random.Random(7)
    names = ["UNDER_REVIEW", "ESCALATED", "RESOLVED_FRAUD", "RESOLVED_GENUINE"]
    batches = [[(f"case {rng.randrange(400)}", rng.choice(names), T0 + dt.timedelta(days=25 * b + rng.randrange(20), microseconds=rng.randrange(10**6)))
                for _ in range(300)] for b in range(4)]
    batches[0].append(("no status", None, T0))
    ck = str(tmp_path / "ck")
    stream = K.case_status_stream(fed(batches, "case_id string, status string, updated_at timestamp"), "6 days", 10, buckets=5)
    out = K.run_changes_table(stream, str(tmp_path / "out"), ck, "case_id", ("updated_at", "status"))
    held, changes, latest, seen = {}, [], {}, T0
    for batch in [*batches, []]:
        mark = seen - dt.timedelta(days=6)  # no row of these is late
        for c in {r[0] for r in batch}:
            best = max((t, s) for k, s, t in batch if k == c)
            if c not in held or best > held[c]:
                held[c] = best
                changes.append((c, best[1], best[0]))
            latest[c] = max(latest.get(c, best), best)
        held = {c: (t, s) for c, (t, s) in held.items() if s not in K.CLOSED_STATUSES or t + dt.timedelta(days=10) > mark}
        seen = max([seen, *(r[2] for r in batch)])
    assert sorted(map(tuple, spark.read.schema(stream.schema).parquet(str(tmp_path / "out")).select(stream.columns).collect())) == sorted(changes)
    assert {r["case_id"]: (r["updated_at"], r["status"]) for r in out.collect()} == latest
    assert {r["case_id"]: (r["updated_at"], r["status"]) for r in K.case_states(spark, ck).collect()} == held and len(held) < len(latest)
    with K.rocksdb_state(spark):
        assert spark.read.format("statestore").option("stateVarName", "latest").load(ck).count() == 5


def test_state_rows_do_not_grow_with_the_cases(spark, fed, tmp_path):
    """Each state row costs its calls to the Python worker and the store: fewer than cases."""
    events = fed([[(f"case {i}", "ESCALATED", at(i)) for i in range(6000)]], "case_id string, status string, updated_at timestamp")
    ck = str(tmp_path / "ck")
    out = K.run_changes_table(K.case_status_stream(events), str(tmp_path / "out"), ck, "case_id", ("updated_at", "status"))
    assert out.count() == 6000 and K.case_states(spark, ck).distinct().count() == 6000
    with K.rocksdb_state(spark):
        assert spark.read.format("statestore").option("stateVarName", "latest").load(ck).count() <= 2048


def test_failed_logins_of_two_streams(spark, fed, tmp_path):
    tx = [[(1, "x", at(100)), (2, "y", at(100)), (3, "x", at(130))], [(4, "x", at(101)), (5, "x", at(160)), (6, None, at(150))], [(7, "z", at(500))]]
    logins = [[("x", at(40)), ("x", at(39, 999_999)), ("x", at(100)), ("x", at(100, 1)), ("y", at(10))], [("x", at(99)), ("x", at(95)), ("w", at(120))], [("x", at(160)), ("x", at(160)), ("z", at(441))]]
    t, g = fed(tx, "event_id long, account_id string, timestamp timestamp"), fed(logins, "account_id string, timestamp timestamp")
    got = drained(spark, tmp_path, lambda a, b: K.failed_login_stream(a, b, watermark="45 minutes"), t, g)
    flat = [r for b in tx for r in b], [r for b in logins for r in b]
    batch = L.failed_login_count(spark.createDataFrame(flat[0], "event_id long, account_id string, timestamp timestamp"),
                                 spark.createDataFrame([(i, *r) for i, r in enumerate(flat[1])], "event_id long, account_id string, timestamp timestamp"))
    want = {r["event_id"]: r["failed_login_count_1h"] for r in batch.collect()}
    assert {r["event_id"]: r["failed_login_count_1h"] for r in got.collect()} == want and want[1] == 4


def test_account_history_over_batches_with_late_rows(spark, fed, tmp_path):
    rows = [(i, f"u{i % 3}", at(i * 97 % 60_000, i % 2), float(i % 13) + 0.25) for i in range(600)]
    rows += [(1000 + i, "u0", at(5000), 1.0 + i) for i in range(4)] + [(2000, "once", at(70), 5.0), (2001, "u1", at(60_000 + 43_200), 1.0)]
    rows.sort(key=lambda r: (r[2], r[0]))
    late = rows[100::7]
    batches = [[r for r in rows[a:a + 150] if r not in late] + [r for r in late if r in rows[max(0, a - 150):a]] for a in range(0, len(rows) + 150, 150)]
    assert sorted(r for b in batches for r in b) == sorted(rows)
    stream = fed([b for b in batches if b], "event_id long, account_id string, timestamp timestamp, amount double")
    with K.rocksdb_state(spark):
        got = drained(spark, tmp_path, lambda s: K.account_history_stream(s, watermark="40 days"), stream)
    tx = spark.createDataFrame(rows, "event_id long, account_id string, timestamp timestamp, amount double")
    batch = L.trailing_average(L.daily_total_before(tx))
    keyed = lambda df: {r["event_id"]: (r["account_id"], r["timestamp"], round(r["daily_total_before_txn"], 6), r["avg_amount_30d"] and round(r["avg_amount_30d"], 6))
                        for r in df.collect()}
    assert keyed(got) == keyed(batch)


def test_account_history_in_order_drops_old_hours(spark, fed, tmp_path):
    batches = [[(100 * b + i, "u", T0 + dt.timedelta(days=20 * b, hours=i), 1.0 + i) for i in range(30)] for b in range(5)]
    stream = fed(batches, "event_id long, account_id string, timestamp timestamp, amount double")
    with K.rocksdb_state(spark):
        got = drained(spark, tmp_path, lambda s: K.account_history_stream(s, watermark="2 hours"), stream)
        held = spark.read.format("statestore").option("stateVarName", "rows").load(str(tmp_path / "ck")).select("user_map_key.hour").collect()
    tx = spark.createDataFrame([r for b in batches for r in b], "event_id long, account_id string, timestamp timestamp, amount double")
    batch = L.trailing_average(L.daily_total_before(tx))
    keyed = lambda df: {r["event_id"]: (round(r["daily_total_before_txn"], 6), r["avg_amount_30d"] and round(r["avg_amount_30d"], 6)) for r in df.collect()}
    assert keyed(got) == keyed(batch)
    newest = int((T0 - dt.datetime(1970, 1, 1)).total_seconds() // 3600) + 80 * 24 + 29
    assert held and min(r["hour"] for r in held) >= newest - 720


def test_windowed_drift_of_closed_windows(spark, fed, tmp_path):
    ref = spark.createDataFrame([(float(i % 50), float(i)) for i in range(400)], "a double, b double")
    rows = [(at(i * 9), float(i % 70), None if i % 5 else float("nan") if i % 10 else float(i * 3)) for i in range(500)]
    schema = "ts timestamp, a double, b double"
    stream = fed([rows[:200], rows[200:350], rows[350:]], schema)
    got = drained(spark, tmp_path, lambda s: K.drift_window_stream(ref, s, ["a", "b"], "ts", "1 day", n_bins=5), stream, ts="ts")
    cur = spark.createDataFrame(rows, schema).withColumn("w", F.window("ts", "1 day")["start"])
    want = G.windowed_numeric_drift(ref, cur, ["a", "b"], "w", n_bins=5)
    keyed = lambda df, w: {(r[w], r["feature_name"]): (r["current_count"], round(r["population_stability_index"], 9), r["alert_level"]) for r in df.collect()}
    assert keyed(got, "window_start") == keyed(want, "window") and got.count() >= 6


def test_rows_later_than_the_watermark_are_left_out(spark, fed, tmp_path):
    stream = fed([[(1, "u", at(0), 1.0), (2, "u", at(600), 2.0)], [(3, "u", at(601), 4.0)], [(4, "u", at(10), 8.0), (5, "u", at(700), 16.0)]],
                 "event_id long, account_id string, timestamp timestamp, amount double")
    with K.rocksdb_state(spark):
        got = drained(spark, tmp_path, lambda s: K.account_history_stream(s, watermark="1 hour"), stream)
    assert {r["event_id"]: r["daily_total_before_txn"] for r in got.collect()} == {1: 0.0, 2: 1.0, 3: 3.0, 5: 7.0}


def test_state_provider_is_put_back(spark):
    before = spark.conf.get(K.PROVIDER)
    with pytest.raises(KeyError), K.rocksdb_state(spark):
        raise KeyError
    assert spark.conf.get(K.PROVIDER) == before
    assert S.shared_dir(spark, "x") != S.shared_dir(spark, "x")
