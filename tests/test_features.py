"""Point-in-time features against brute force, with one account holding a third of the rows."""

import random
from datetime import datetime, timedelta

import pytest

from ledgerlens.operators import features as L


def _rows(n=240, seed=3):
    """Times on a half-hour grid, so ties and gaps of exactly the limit occur."""
    rnd = random.Random(seed)
    base = datetime(2024, 1, 1)
    out = []
    for i in range(n):
        acct = "hot" if i % 3 == 0 else f"a{rnd.randrange(8)}"
        ts = None if i in (7, 9) else base + timedelta(minutes=30 * rnd.randrange(48 * 70))
        out.append((i, acct, ts, None if i == 11 else float(rnd.randrange(1000))))
    return out


@pytest.fixture(scope="module")
def tx(spark):
    return spark.createDataFrame(_rows(), "event_id long, account_id string, timestamp timestamp, amount double")


def test_trailing_average(tx):
    rows = _rows()
    got = {r.event_id: r.avg_amount_30d for r in L.trailing_average(tx).collect()}
    assert len(got) == len(rows)
    for i, a, t, _ in rows:
        vals = [v for _, b, u, v in rows if t and u and b == a and t - timedelta(days=30) <= u < t and v is not None]
        want = sum(vals) / len(vals) if vals else None
        assert got[i] == (pytest.approx(want) if vals else None)


def test_account_age(tx, monkeypatch):
    rows = _rows()
    first = {}
    for _, a, t, _ in rows:
        if t:
            first[a] = min(first.get(a, t), t)
    for parts in (1024, 4):  # all accounts hot; only the hot one
        monkeypatch.setattr(L, "HOT_PARTS", parts)
        got = {r.event_id: r.account_age_days for r in L.account_age(tx, tx).collect()}
        assert got == {i: (t.date() - first[a].date()).days if t else None for i, a, t, _ in rows}


def test_sessions(tx):
    rows = _rows()
    by = {}
    for _, a, t, _ in rows:
        if t:
            by.setdefault(a, []).append(t)
    want = set()
    for a, ts in by.items():
        ts.sort()
        start, prev, n = ts[0], ts[0], 0
        for t in ts:
            if t - prev >= timedelta(hours=3) and n:
                want.add((a, start, prev + timedelta(hours=3), n))
                start, n = t, 0
            prev, n = t, n + 1
        want.add((a, start, prev + timedelta(hours=3), n))
    got = L.event_windows(tx, "timestamp", "session", gap="3 hours", keys=("account_id",)).collect()
    assert {(r.account_id, r.window_start, r.window_end, r.n) for r in got} == want


def test_empty(tx):
    none = tx.limit(0)
    assert L.trailing_average(none).count() == 0 and L.account_age(none, none).count() == 0
    assert L.event_windows(none, "timestamp", "session", keys=("account_id",)).count() == 0


def test_velocity_reads_the_source_once(tx):
    got = {r.event_id: r.tx_count_2min for r in L.velocity_count(tx, minutes=60).collect()}
    rows = _rows()
    for i, a, t, _ in rows:
        if t:
            assert got[i] == sum(1 for _, b, u, _ in rows if u and b == a and t - timedelta(hours=1) <= u <= t)
    assert len(got) == len(rows)
