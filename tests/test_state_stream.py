"""The stateful stream: equal to the batch features whatever the order of arrival, late rows kept and repaired."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from merchant_signals.operators.features import merchant_features
from merchant_signals.schemas import FACT
from merchant_signals.sources.store import TableStore
from merchant_signals.streaming import stream as ST

T0 = dt.datetime(2024, 3, 1, 12)
COLS = ["merchant_id", "snapshot_time_utc", "txn_count_15m", "gmv_usd_15m", "txn_count_1h", "gmv_usd_1h"]


def _facts(spark, minutes, merchant="m1", late_ingest=0):
    rows = [(f"{merchant}-{m}", merchant, T0 + dt.timedelta(minutes=m), T0 + dt.timedelta(minutes=m + late_ingest), m % 50) for m in minutes]
    df = spark.createDataFrame(rows, "event_id string, merchant_id string, event_time_utc timestamp, ingested_at_utc timestamp, amount int")
    df = df.withColumn("amount_usd", F.col("amount").cast("decimal(18,2)")).withColumn("raw_id", F.monotonically_increasing_id())
    return df.select(*[(F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in FACT.fields])


def _same(store):
    got = store.read("snapshots").select(*COLS).orderBy(*COLS).collect()
    assert got and got == merchant_features(store.read("facts")).select(*COLS).orderBy(*COLS).collect()


def test_late_rows_are_kept_counted_and_repaired(spark, tmp_dir):
    store = TableStore(spark, tmp_dir + "/store")
    ck = tmp_dir + "/ckpt"
    assert ST.append_facts(store, _facts(spark, [600, 610])) == {"inserted_fact": 2, "late_facts": 0}
    out = ST.run_window_stream(spark, store, ck)
    assert out["dropped"] == 0 and out["rows_repaired"] == 0 and out["rows_upserted"] >= 8 - 4
    _same(store)
    # the watermark is at 550: far behind, partly behind (its last window is open), in time
    assert ST.append_facts(store, _facts(spark, [5, 500, 595]))["late_facts"] == 2
    out = ST.run_window_stream(spark, store, ck)
    assert out["dropped"] > 0 and out["rows_repaired"] >= 4
    assert not [n for n in ST.list_names(spark, store.path("late")) if n.startswith("load=")]
    _same(store)
    # the same facts again add nothing; a later merchant, rows that the ingest guard keeps out
    assert ST.append_facts(store, _facts(spark, [5, 595]))["inserted_fact"] == 0
    ST.append_facts(store, _facts(spark, [620, 900], "m2", late_ingest=30))
    ST.run_window_stream(spark, store, ck)
    _same(store)


@pytest.mark.parametrize("where, step", [(ST, "_upsert"), (TableStore, "_swap"), (ST, "recompute_keys")])
def test_a_run_that_breaks_off_is_finished_by_the_next(spark, tmp_dir, monkeypatch, where, step):
    store = TableStore(spark, tmp_dir + "/store")
    ck = tmp_dir + "/ckpt"
    ST.append_facts(store, _facts(spark, [600, 610, 700]))
    ST.run_window_stream(spark, store, ck)
    ST.append_facts(store, _facts(spark, [5, 20, 601, 705]))
    with monkeypatch.context() as m:
        m.setattr(where, step, lambda *a, **k: 1 / 0)
        with pytest.raises(Exception):
            ST.run_window_stream(spark, store, ck)
    ST.run_window_stream(spark, TableStore(spark, tmp_dir + "/store"), ck)
    _same(store)


def test_a_load_that_broke_off_keeps_its_late_keys(spark, tmp_dir, monkeypatch):
    store = TableStore(spark, tmp_dir + "/store")
    ST.append_facts(store, _facts(spark, [600]))
    ST.run_window_stream(spark, store, tmp_dir + "/ckpt")
    append = store.append
    monkeypatch.setattr(store, "append", lambda name, df: append(name, df) if name != "facts" else 1 / 0)
    with pytest.raises(ZeroDivisionError):
        ST.append_facts(store, _facts(spark, [3]))
    monkeypatch.undo()
    ST.run_window_stream(spark, store, tmp_dir + "/ckpt")  # takes the keys whose facts aren't there
    ST.append_facts(store, _facts(spark, [3]))
    ST.run_window_stream(spark, store, tmp_dir + "/ckpt")
    _same(store)
