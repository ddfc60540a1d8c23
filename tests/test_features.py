from decimal import Decimal

from pyspark.sql import functions as F

from merchant_signals.operators.features import (
    features_at_times, latest_per_merchant, merchant_features, snapshot_backfill)
from tests.helpers import facts, one, ts


def test_window_edges_for_T_1100(spark):
    f = facts(spark, [
        ("a", "m1", "2024-01-01 10:00:00", "2024-01-01 10:00:00", Decimal("1.00")),
        ("b", "m1", "2024-01-01 10:45:00", "2024-01-01 10:45:00", Decimal("2.00")),
        ("c", "m1", "2024-01-01 11:00:00", "2024-01-01 11:00:00", Decimal("4.00")),
    ])
    r = one(merchant_features(f), snapshot_time_utc=ts("2024-01-01 11:00"))
    assert (r.txn_count_15m, r.gmv_usd_15m, r.txn_count_1h, r.gmv_usd_1h) == (1, Decimal("2.00"), 2, Decimal("3.00"))


def test_late_event_counts_from_next_bucket(spark):
    f = facts(spark, [("a", "m1", "2024-01-01 10:50:00", "2024-01-01 11:00:00", Decimal("5.00"))])
    out = merchant_features(f)
    assert out.filter(F.col("snapshot_time_utc") == ts("2024-01-01 11:00")).count() == 0
    r = one(out, snapshot_time_utc=ts("2024-01-01 11:15"))
    assert (r.txn_count_15m, r.txn_count_1h) == (0, 1)
    assert sorted(x[0] for x in out.select("snapshot_time_utc").collect()) == [
        ts("2024-01-01 11:15"), ts("2024-01-01 11:30"), ts("2024-01-01 11:45")]


def test_null_amount_counts_but_does_not_sum(spark):
    f = facts(spark, [("a", "m1", "2024-01-01 10:50:00", "2024-01-01 10:50:00", None),
                      ("b", "m1", "2024-01-01 10:51:00", "2024-01-01 10:51:00", Decimal("-3.00"))])
    r = one(merchant_features(f), snapshot_time_utc=ts("2024-01-01 11:00"))
    assert (r.txn_count_15m, r.gmv_usd_15m) == (2, Decimal("-3.00"))
    f2 = facts(spark, [("a", "m1", "2024-01-01 10:50:00", "2024-01-01 10:50:00", None)])
    assert one(merchant_features(f2), snapshot_time_utc=ts("2024-01-01 11:00")).gmv_usd_1h == Decimal("0.00")


def test_sliding_equals_brute_force(spark):
    """Every (merchant, T) of the sliding-window plan equals the literal range
    definition evaluated in Python."""
    import random

    random.seed(7)
    rows = []
    for i in range(300):
        e = ts("2024-01-01 00:00") + __import__("datetime").timedelta(seconds=random.randint(0, 6 * 3600))
        lag = __import__("datetime").timedelta(minutes=random.randint(0, 40))
        rows.append((f"e{i}", f"m{random.randint(1, 4)}", e.isoformat(sep=" "), (e + lag).isoformat(sep=" "),
                     Decimal(random.randint(-500, 5000)) / 100))
    f = facts(spark, rows)
    got = {(r.merchant_id, r.snapshot_time_utc): (r.txn_count_15m, r.gmv_usd_15m, r.txn_count_1h, r.gmv_usd_1h)
           for r in merchant_features(f).collect()}
    import datetime as dt
    exp = {}
    data = [(m, ts(t), ts(i), a) for _, m, t, i, a in rows]
    times = {(m, dt.datetime(2024, 1, 1) + dt.timedelta(minutes=15 * k)) for m, *_ in data for k in range(0, 4 * 8)}
    for m, T in times:
        inwin = [(e, a) for mm, e, i, a in data if mm == m and T - dt.timedelta(hours=1) <= e < T and i < T]
        if not inwin:
            continue
        w15 = [(e, a) for e, a in inwin if e >= T - dt.timedelta(minutes=15)]
        exp[(m, T)] = (len(w15), sum((a for _, a in w15), Decimal("0.00")), len(inwin),
                       sum((a for _, a in inwin), Decimal("0.00")))
    assert got == exp


def test_features_at_unaligned_times(spark):
    f = facts(spark, [("a", "m1", "2024-01-01 10:00:00", "2024-01-01 10:00:00", Decimal("1.00")),
                      ("b", "m1", "2024-01-01 10:20:00", "2024-01-01 10:20:00", Decimal("2.00"))])
    times = spark.createDataFrame([(ts("2024-01-01 10:30:07"),)], "snapshot_time_utc timestamp")
    r = one(features_at_times(f, times))
    assert (r.txn_count_15m, r.txn_count_1h, r.gmv_usd_1h) == (1, 2, Decimal("3.00"))


def test_latest_and_backfill(spark):
    f = facts(spark, [("a", "m1", "2024-01-01 10:00:00", "2024-01-01 10:00:00", Decimal("1.00")),
                      ("b", "m1", "2024-01-01 10:20:00", "2024-01-01 10:20:00", Decimal("2.00"))])
    latest = one(latest_per_merchant(merchant_features(f)))
    assert latest.snapshot_time_utc == ts("2024-01-01 11:15")
    # backfill stops at next15(max event) = 10:30, although the 1h window reaches 11:15
    assert max(r[0] for r in snapshot_backfill(f).select("snapshot_time_utc").collect()) == ts("2024-01-01 10:30")


def test_features_of_asked_keys_are_marked_without_a_join(spark):
    """Keys may repeat, name no fact or no merchant; the features are those of a semi join with them."""
    import datetime as dt

    from pyspark.sql import functions as F

    from merchant_signals.operators.features import merchant_features
    from merchant_signals.streaming.stream import touched_keys

    t0 = dt.datetime(2024, 1, 5, 10, 1)
    rows = [(m, t0 + dt.timedelta(minutes=7 * i), t0 + dt.timedelta(minutes=7 * i + 20 * (i % 2)), None if i % 5 == 0 else i)
            for i in range(12) for m in ("a", "b", None)]
    facts = spark.createDataFrame(rows, "merchant_id string, event_time_utc timestamp, ingested_at_utc timestamp, amount_usd int")
    facts = facts.withColumn("amount_usd", F.col("amount_usd").cast("decimal(18,2)"))
    batch = facts.filter((F.col("event_time_utc") < F.lit(t0 + dt.timedelta(minutes=20))) & F.coalesce("merchant_id", F.lit("")).isin("a", ""))
    keys = touched_keys(batch).unionByName(touched_keys(batch)).unionByName(
        spark.createDataFrame([("c", t0), ("a", dt.datetime(2024, 1, 9))], "merchant_id string, snapshot_time_utc timestamp"))
    got = merchant_features(facts, keys=keys)
    want = merchant_features(facts).join(keys, ["merchant_id", "snapshot_time_utc"], "left_semi")
    assert got.schema == want.schema
    assert sorted(got.collect()) == sorted(want.collect()) and got.count() >= 5
    assert "Join" not in got._jdf.queryExecution().optimizedPlan().toString()
