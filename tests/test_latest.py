"""Latest state per merchant and newest templates: kept and searched at the cost of what changed."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from merchant_signals.operators.clone import newest_templates
from merchant_signals.operators.features import latest_per_merchant, merge_latest
from merchant_signals.sources.store import SNAPSHOT_SCHEMA, TableStore

T0 = dt.datetime(2024, 1, 1)
RAW_DDL = "raw_id bigint, source string, payload string"


def _snaps(spark, rows):
    """rows: (merchant, hours, transactions)"""
    base = spark.createDataFrame([(m, T0 + dt.timedelta(hours=h), n) for m, h, n in rows], "merchant_id string, snapshot_time_utc timestamp, txn_count_15m int")
    return base.select(*[(F.col(f.name) if f.name in base.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in SNAPSHOT_SCHEMA.fields])


def _state(df):
    return sorted((r.merchant_id, r.snapshot_time_utc, r.txn_count_15m) for r in df.collect())


def test_kept_latest_state_equals_a_scan(spark, tmp_dir):
    store = TableStore(spark, tmp_dir + "/store")
    assert store.latest_snapshots().collect() == []
    waves = [[("a", 30, 1), ("b", 31, 2), ("a", 29, 3)],
             [("a", 2, 4), ("c", 3, 5)],                # older days
             [("a", 30, 9), ("b", 31, 2), ("a", 29, 3)],  # the newest row of a is computed again
             [("b", 80, 6)]]
    for rows in waves:
        store.replace_partitions("snapshots", _snaps(spark, rows))
        assert _state(store.latest_snapshots()) == _state(latest_per_merchant(store.read("snapshots")))
    assert [(m, n) for m, _, n in _state(store.latest_snapshots())] == [("a", 9), ("b", 6), ("c", 5)]


def test_a_swap_that_broke_off_keeps_the_latest_state(spark, tmp_dir, monkeypatch):
    store = TableStore(spark, tmp_dir + "/store")
    store.replace_partitions("snapshots", _snaps(spark, [("a", 1, 1)]))
    with monkeypatch.context() as m:
        m.setattr(TableStore, "_keep_latest", lambda *_: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            store.replace_partitions("snapshots", _snaps(spark, [("a", 30, 2), ("b", 30, 3)]))
    store.recover()
    assert _state(store.latest_snapshots()) == _state(latest_per_merchant(store.read("snapshots")))


def test_latest_state_of_a_store_from_before_it_was_kept(spark, tmp_dir, monkeypatch):
    store = TableStore(spark, tmp_dir + "/store")
    with monkeypatch.context() as m:
        m.setattr(TableStore, "_keep_latest", lambda *_: None)
        store.replace_partitions("snapshots", _snaps(spark, [("a", 1, 1), ("a", 2, 2)]))
    assert [(m, n) for m, _, n in _state(store.latest_snapshots())] == [("a", 2)]


def test_merge_latest_of_empty_sides(spark):
    some, none = _snaps(spark, [("a", 1, 1)]), _snaps(spark, [("a", 1, 1)]).limit(0)
    assert _state(merge_latest(none, some)) == _state(some) == _state(merge_latest(some, none))


GOOD, BAD = '{"event_id":"e","event_type":"t","merchant_id":"m"}', '{"event_id":"e"}'


def _scan(raw):
    best = {}
    for r in raw.collect():
        if r.payload == GOOD and r.raw_id > best.get(r.source, -1):
            best[r.source] = r.raw_id
    return best


def test_newest_templates_equal_a_scan(spark):
    rows = [(i, ["A", "B", None][i % 3], BAD if i > 40 and i % 3 == 1 or i % 5 == 0 else GOOD) for i in range(1, 101)]
    rows += [(i, "NONE", BAD) for i in range(101, 140)] + [(200, "LATE", GOOD), (201, "NONE", "no json"), (202, "NONE", None)]
    raw = spark.createDataFrame(rows, RAW_DDL)
    for first in (1, 7, 4096):
        assert {r.source: r.raw_id for r in newest_templates(raw, first).collect()} == _scan(raw)
    assert newest_templates(raw.limit(0)).collect() == []


def test_newest_templates_leave_old_rows_alone(spark):
    old = F.col("id") < 90_000
    raw = spark.range(1, 100_001).select(F.col("id").alias("raw_id"), F.lit("S").alias("source"),
                                         F.when(old, F.raise_error(F.lit("an old payload was read"))).otherwise(F.lit(GOOD)).alias("payload"))
    assert [r.raw_id for r in newest_templates(raw).collect()] == [100_000]
