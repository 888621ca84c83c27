"""Point-in-time features computed from event tables.

The rule engine consumes velocity / login / running-total / trailing-average
features that must be computed on real data. They are interval RANGE
windows per account. A window partitioned only by account would put a hot
account (say a third of all rows) into one task, so every window here is
partitioned by (account, time bucket): rows whose look-back interval
reaches into the previous bucket are *replicated* into the next bucket as
context-only rows ("halo"), the window runs per (account, bucket), and only
the bucket's own rows are kept. Exact, and a group never exceeds one
account's traffic in one bucket (plus its halo).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def _micros(ts) -> F.Column:
    return F.unix_micros(F.col(ts).cast("timestamp"))


def halo_bucketed(df: DataFrame, ts: str, lookback_us: int, bucket_us: int) -> DataFrame:
    """Add ``_bucket`` and ``_own``: every row in its own bucket, plus a copy
    (``_own`` = False) in the next bucket if its [ts, ts + lookback] interval
    reaches it (at most one, as lookback <= bucket). One scan of the input."""
    if lookback_us > bucket_us:
        raise ValueError("bucket must be at least as long as the look-back interval")
    t = _micros(ts)
    b = F.floor(t / F.lit(bucket_us)).cast("long")
    nxt = F.floor((t + F.lit(lookback_us)) / F.lit(bucket_us)).cast("long")
    return (df.withColumns({"_b0": b, "_bucket": F.explode_outer(F.sequence(b, nxt))})
            .withColumn("_own", F.col("_bucket").eqNullSafe(F.col("_b0"))).drop("_b0"))


def velocity_count(tx: DataFrame, account: str = "account_id", ts: str = "timestamp", minutes: int = 2,
                   bucket_minutes: int = 60, out: str = "tx_count_2min") -> DataFrame:
    """L1: number of the account's transactions in [ts - minutes, ts]
    (current row included, RANGE semantics: ties at ts count)."""
    look = minutes * 60_000_000
    h = halo_bucketed(tx, ts, look, bucket_minutes * 60_000_000).withColumn("_t", _micros(ts))
    w = Window.partitionBy(account, "_bucket").orderBy("_t").rangeBetween(-look, 0)
    return (h.withColumn(out, F.count(F.lit(1)).over(w).cast("int"))
            .where("_own").drop("_bucket", "_own", "_t"))


def failed_login_count(tx: DataFrame, logins: DataFrame, account: str = "account_id", ts: str = "timestamp",
                       minutes: int = 60, bucket_minutes: int = 240, out: str = "failed_login_count_1h",
                       key: str = "event_id") -> DataFrame:
    """L2: failed logins of the account in [ts - minutes, ts] for every
    transaction, by a conditional count over the unioned event stream."""
    look = minutes * 60_000_000
    # transactions keep all their columns; logins are padded with nulls, so no join back is needed
    u = (tx.withColumns({"_is_tx": F.lit(1), "_is_fail": F.lit(0)})
         .unionByName(logins.select(key, account, ts).withColumns({"_is_tx": F.lit(0), "_is_fail": F.lit(1)}),
                      allowMissingColumns=True))
    h = halo_bucketed(u, ts, look, bucket_minutes * 60_000_000).withColumn("_t", _micros(ts))
    w = Window.partitionBy(account, "_bucket").orderBy("_t").rangeBetween(-look, 0)
    return (h.withColumn(out, F.sum("_is_fail").over(w).cast("int"))
            .where(F.col("_own") & (F.col("_is_tx") == 1))
            .drop("_bucket", "_own", "_t", "_is_tx", "_is_fail"))


def daily_total_before(tx: DataFrame, account: str = "account_id", ts: str = "timestamp",
                       amount: str = "amount", key: str = "event_id",
                       out: str = "daily_total_before_txn") -> DataFrame:
    """L3: sum of the account's earlier transactions on the same calendar day
    (ordered by ts, key; current excluded). Two-level prefix: hour totals
    (<= 24 per account-day, a tiny window) + running sum inside the hour."""
    d = tx.withColumns({"_day": F.to_date(ts), "_hour": F.hour(ts)})
    hours = d.groupBy(account, "_day", "_hour").agg(F.sum(amount).alias("_h"))
    wh = Window.partitionBy(account, "_day").orderBy("_hour").rowsBetween(Window.unboundedPreceding, -1)
    off = hours.select(account, "_day", "_hour", F.coalesce(F.sum("_h").over(wh), F.lit(0.0)).alias("_off"))
    wi = Window.partitionBy(account, "_day", "_hour").orderBy(ts, key).rowsBetween(Window.unboundedPreceding, -1)
    within = d.withColumn("_in", F.coalesce(F.sum(amount).over(wi), F.lit(0.0)))
    return (within.join(off, [account, "_day", "_hour"])
            .withColumn(out, F.col("_off") + F.col("_in")).drop("_day", "_hour", "_off", "_in"))


def trailing_average(tx: DataFrame, account: str = "account_id", ts: str = "timestamp", amount: str = "amount",
                     days: int = 30, bucket_minutes: int = 60, out: str = "avg_amount_30d") -> DataFrame:
    """L4: mean amount of the account's transactions in [ts - days, ts),
    rows at the same instant excluded (null when there are none).

    The interval is the row's own bucket before it, the whole buckets between, and the end
    of the bucket ``days`` earlier. The whole buckets are a window over bucket totals (one
    row per account and bucket); the other two are windows within one bucket, where the
    earlier rows are laid on the row's clock by adding ``days``. A group is one account's
    rows of two buckets, so a hot account spreads over as many tasks as it has buckets."""
    look, width = days * 86_400_000_000, bucket_minutes * 60_000_000
    if look % width:
        raise ValueError("the look-back must be a whole number of buckets")
    span = look // width
    t = _micros(ts)
    value = F.col(amount).cast("double")
    keyed = tx.withColumns({"_t": t, "_bucket": F.floor(t / F.lit(width)).cast("long"), "_v": value})
    totals = keyed.where(F.col("_t").isNotNull()).groupBy(account, "_bucket").agg(
        F.sum("_v").alias("_s"), F.count("_v").alias("_n"))
    wt = Window.partitionBy(account).orderBy("_bucket").rangeBetween(-(span - 1), -1)
    whole = totals.select(account, "_bucket", F.sum("_s").over(wt).alias("_ws"), F.sum("_n").over(wt).alias("_wn"),
                          F.lit(2).alias("_kind"))
    # kind 0: the row itself; 1: the row as the end of the interval of rows ``days`` later; 2: the whole buckets
    both = keyed.withColumn("_kind", F.explode(F.array(F.lit(0), F.lit(1)))).withColumns({
        "_t": F.col("_t") + F.col("_kind") * F.lit(look), "_bucket": F.col("_bucket") + F.col("_kind") * F.lit(span)})
    rows = both.unionByName(whole, allowMissingColumns=True)
    group = Window.partitionBy(account, "_bucket")
    before = group.orderBy("_t").rangeBetween(Window.unboundedPreceding, -1)
    after = group.orderBy("_t").rangeBetween(0, Window.unboundedFollowing)
    own, old = F.when(F.col("_kind") == 0, F.col("_v")), F.when(F.col("_kind") == 1, F.col("_v"))
    zero = F.lit(0.0)
    rows = rows.withColumns({
        "_s": F.coalesce(F.sum(own).over(before), zero) + F.coalesce(F.max("_ws").over(group), zero)
        + F.coalesce(F.sum(old).over(after), zero),
        "_n": F.count(own).over(before) + F.coalesce(F.max("_wn").over(group), F.lit(0)) + F.count(old).over(after)})
    return (rows.where(F.col("_kind") == 0)
            .withColumn(out, F.when(F.col("_t").isNotNull() & (F.col("_n") > 0), F.col("_s") / F.col("_n")))
            .drop("_t", "_bucket", "_v", "_kind", "_s", "_n", "_ws", "_wn"))


# An account is hot from this share of all events on, so there are at most HOT_PARTS hot accounts.
HOT_PARTS = 1024


def account_age(tx: DataFrame, events: DataFrame, account: str = "account_id", ts: str = "timestamp",
                out: str = "account_age_days") -> DataFrame:
    """Days since the account's first event (partial min per account, then a join on
    the account). Hot accounts (fewer than ``HOT_PARTS``, each with more than that part of
    all events) are looked up in a broadcast table; the salt spreads their rows in the join
    that serves the others."""
    first = events.groupBy(account).agg(F.min(ts).alias("_first"), F.count(F.lit(1)).alias("_n"))
    total = events.select(F.count(F.lit(1))).scalar()
    hot = first.where(F.col("_n") * HOT_PARTS > total).select(account, F.col("_first").alias("_hot"))
    spread = tx.join(F.broadcast(hot), account, "left")
    salt = F.when(F.col("_hot").isNotNull(), F.lit(1) + F.pmod(F.xxhash64(F.col(ts)),
                                                               F.lit(HOT_PARTS))).otherwise(F.lit(0)).cast("long")
    return (spread.withColumn("_salt", salt)
            .join(first.select(account, "_first", F.lit(0).cast("long").alias("_salt")), [account, "_salt"], "left")
            .withColumn(out, F.datediff(F.col(ts), F.coalesce("_hot", "_first"))).drop("_first", "_hot", "_salt"))


def session_counts(events: DataFrame, ts: str, gap: str, keys: tuple[str, ...], bucket_minutes: int = 60) -> DataFrame:
    """L7 sessions in two levels: rows are cut into sessions within (keys, time bucket), then
    these are merged over the buckets of a key. The second window sees one row per piece of a
    session, so a key's whole history never meets in one task. A gap of exactly ``gap``
    starts a new session; rows without a time are in none."""
    gap_us = F.unix_micros(F.expr(f"timestamp_micros(0) + INTERVAL {gap}"))
    width = bucket_minutes * 60_000_000

    def numbered(df, start, prev, *part):
        w = Window.partitionBy(*part).orderBy("_start", "_end")
        new = F.when(F.col(start) - F.lag(prev).over(w) < gap_us, 0).otherwise(1)
        return df.withColumn("_new", new).withColumn(
            "_sid", F.sum("_new").over(w.rowsBetween(Window.unboundedPreceding, 0)))

    t = _micros(ts)
    rows = events.select(*keys, t.alias("_start"), t.alias("_end"), F.floor(t / F.lit(width)).alias("_bucket")) \
        .where(F.col("_start").isNotNull())
    merged = lambda df, *by: df.groupBy(*by).agg(
        F.min("_start").alias("_start"), F.max("_end").alias("_end"), F.sum("_n").alias("_n"))
    pieces = merged(numbered(rows.withColumn("_n", F.lit(1)), "_start", "_end", *keys, "_bucket"), *keys, "_bucket", "_sid")
    sessions = merged(numbered(pieces.drop("_sid", "_bucket"), "_start", "_end", *keys), *keys, "_sid")
    return sessions.select(F.struct(F.timestamp_micros("_start").alias("start"),
                                    F.timestamp_micros(F.col("_end") + gap_us).alias("end")).alias("w"),
                           *keys, F.col("_n").alias("n"))


def event_windows(events: DataFrame, ts: str = "ts", kind: str = "tumbling", duration: str = "1 hour",
                  slide: str | None = None, gap: str = "5 minutes", keys: tuple[str, ...] = ("event_type",)) -> DataFrame:
    """L7 (batch form): tumbling / sliding / session window counts."""
    t = F.col(ts).cast("timestamp")
    if kind == "tumbling":
        w = F.window(t, duration)
    elif kind == "sliding":
        w = F.window(t, duration, slide or duration)
    elif kind != "session":
        raise ValueError(kind)
    g = session_counts(events, ts, gap, keys) if kind == "session" else events \
        .groupBy(w.alias("w"), *keys).agg(F.count(F.lit(1)).alias("n"))
    return g.select(F.col("w.start").cast("timestamp_ntz").alias("window_start"),
                    F.col("w.end").cast("timestamp_ntz").alias("window_end"), *keys, "n")
