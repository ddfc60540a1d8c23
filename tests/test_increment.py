"""End-to-end: historical seed -> training export -> model -> a scheduled
increment that loads new raw rows, recomputes its 6 buckets and writes model
scores back; then a rerun without new raw rows does nothing."""

import datetime as dt
import json

from pyspark.sql import functions as F

from merchant_signals.operators.features import snapshot_backfill
from merchant_signals.operators.scoring import risk_score_v1
from merchant_signals.plans.increment import run_increment
from merchant_signals.schemas import RAW
from merchant_signals.sources.store import TableStore

FDDL = ("event_id string, event_type string, event_time_utc timestamp, ingested_at_utc timestamp, "
        "merchant_id string, order_id string, amount_usd decimal(18,2), status string, label_bad_outcome int, "
        "label_anomaly int, label_dispute_lost int, raw_id long, source string, received_at timestamp, "
        "payload string")


def _hist(spark, t0, days=10):
    rows = []
    i = 0
    for h in range(days * 24):
        for m in range(3):
            t = t0 + dt.timedelta(hours=h, minutes=7 * m)
            bad = int((h + m) % 5 == 0)
            rows.append((f"h{i}", "payment", t, t, f"m{m}", None, None, "captured", bad, 0, 0, i + 1,
                         "SYNTHETIC_HISTORICAL", t, "{}"))
            i += 1
    return spark.createDataFrame(rows, FDDL).withColumn("amount_usd", (F.col("raw_id") % 50).cast("decimal(18,2)"))


def test_increment_end_to_end(spark, tmp_dir):
    t0 = dt.datetime(2024, 3, 1)
    end = t0 + dt.timedelta(days=10)
    store = TableStore(spark, tmp_dir + "/store")
    hist = _hist(spark, t0)
    store.append("facts", hist)
    snaps = risk_score_v1(snapshot_backfill(hist)).withColumn("computed_at_utc", F.lit(end).cast("timestamp"))
    store.replace_partitions("snapshots", snaps.select(
        "*", *[F.lit(None).cast(t).alias(c) for c, t in [
            ("local_model_score", "decimal(6,5)"), ("local_model_band", "string"),
            ("local_model_version", "string"), ("local_model_scored_at_utc", "timestamp")]]))

    # new raw events in the last 20 minutes, one duplicate, one reject
    def p(eid, mid, minutes):
        t = (end - dt.timedelta(minutes=minutes)).strftime("%Y-%m-%dT%H:%M:%S.000Z")
        return json.dumps({"event_id": eid, "event_type": "payment", "merchant_id": mid, "amount_usd": 10,
                           "event_time_utc": t, "ingested_at_utc": t})
    raw = [(1, "SYNTH_LIVE", p("n1", "m1", 20), end), (2, "SYNTH_LIVE", p("n1", "m1", 19), end),
           (3, "SYNTH_LIVE", p("n2", "", 5), end), (4, "SYNTH_LIVE", p("n3", "m9", 3), end)]
    store.append("raw", spark.createDataFrame(raw, RAW))

    out = run_increment(spark, store, end)
    assert out["ran"] and out["processed_rows"] == 4 and out["inserted_fact"] == 2
    assert out["updated_watermark"] == 4
    assert out["exported_rows"] > 0 and out.get("trained")
    assert out["scored_rows"] > 0
    s = store.read("snapshots")
    scored = s.filter(F.col("local_model_score").isNotNull())
    assert scored.count() == out["scored_rows"]
    assert scored.agg(F.min("snapshot_time_utc")).first()[0] >= end - dt.timedelta(minutes=75)
    m9 = s.filter(F.col("merchant_id") == "m9").collect()
    assert m9 and all(r.txn_count_1h == 1 for r in m9)
    assert {r.merchant_id for r in store.read("dim_merchant").collect()} == {"m1", "m9"}

    before = store.read("snapshots").orderBy("merchant_id", "snapshot_time_utc").collect()
    assert run_increment(spark, store, end) == {"ran": False}
    after = store.read("snapshots").orderBy("merchant_id", "snapshot_time_utc").collect()
    assert before == after


def _raw_rows(spark, end, n=12):
    rows = []
    for i in range(n):
        t = (end - dt.timedelta(minutes=5 * i + 3)).strftime("%Y-%m-%dT%H:%M:%S.000Z")
        rows.append((i + 1, "SYNTH_LIVE", json.dumps({"event_id": f"n{i % 9}", "event_type": "payment", "merchant_id": f"m{i % 3}",
                                                      "amount_usd": i, "event_time_utc": t, "ingested_at_utc": t}), end))
    return spark.createDataFrame(rows, RAW)


def _seeded(spark, path, end):
    store = TableStore(spark, path)
    hist = _hist(spark, end - dt.timedelta(days=10))
    store.append("facts", hist)
    snaps = risk_score_v1(snapshot_backfill(hist)).withColumn("computed_at_utc", F.lit(end).cast("timestamp"))
    store.replace_partitions("snapshots", snaps.select("*", *[F.lit(None).cast(t).alias(c) for c, t in [
        ("local_model_score", "decimal(6,5)"), ("local_model_band", "string"),
        ("local_model_version", "string"), ("local_model_scored_at_utc", "timestamp")]]))
    store.append("raw", _raw_rows(spark, end))
    return store


def _state(store):
    snaps = store.read("snapshots").orderBy("merchant_id", "snapshot_time_utc").collect()
    facts = sorted((r.event_id, r.amount_usd, r.raw_id) for r in store.read("facts").collect())
    return snaps, facts, sorted(tuple(r) for r in store.read("watermark").collect())


def test_a_run_that_breaks_off_anywhere_is_finished_by_the_next(spark, tmp_dir, monkeypatch):
    import pytest

    from merchant_signals.plans import increment as I

    end = dt.datetime(2024, 3, 11)
    whole = _seeded(spark, tmp_dir + "/whole", end)
    assert run_increment(spark, whole, end)["inserted_fact"] == 9
    want = _state(whole)

    def stop(*a, **k):
        raise RuntimeError("stopped here")

    steps = [(I, "set_position"), (I, "recompute_buckets"), (I, "export_and_train"), (I, "score_horizon"), (TableStore, "append"),
             (TableStore, "replace_partitions"), (TableStore, "_swap")]
    for k, (where, step) in enumerate(steps):
        store = _seeded(spark, f"{tmp_dir}/s{k}", end)
        with monkeypatch.context() as m:
            m.setattr(where, step, stop)
            with pytest.raises(RuntimeError, match="stopped here"):
                run_increment(spark, store, end)
        again = TableStore(spark, f"{tmp_dir}/s{k}")
        assert run_increment(spark, again, end)["ran"], step
        assert _state(again) == want, step
        assert run_increment(spark, again, end) == {"ran": False}


def test_catch_up_loads_all_batches_and_finishes_once(spark, tmp_dir):
    from merchant_signals.plans.increment import catch_up
    from merchant_signals.session import list_names

    end = dt.datetime(2024, 3, 11)
    whole, store = (_seeded(spark, f"{tmp_dir}/{x}", end) for x in "ab")
    run_increment(spark, whole, end)
    out = catch_up(spark, store, end, batch_size=5)
    assert [b["processed_rows"] for b in out["batches"]] == [5, 5, 2]
    # what is compared: everything but the load order of equal facts
    assert _state(store) == _state(whole)
    assert list_names(spark, store.root + "/_staging") == []
    assert catch_up(spark, store, end) == {"ran": False, "batches": []}


def test_replayed_micro_batch_repairs_snapshots(spark, tmp_dir, monkeypatch):
    import pytest

    from merchant_signals.streaming import stream as ST

    end = dt.datetime(2024, 3, 11)
    raw = _raw_rows(spark, end)
    whole = TableStore(spark, tmp_dir + "/whole")
    ST.process_batch(whole, raw)
    drop = "computed_at_utc"
    want = whole.read("snapshots").drop(drop).orderBy("merchant_id", "snapshot_time_utc").collect()
    assert want
    for k, (where, step) in enumerate([(ST, "merchant_features"), (TableStore, "replace_partitions"), (TableStore, "_swap")]):
        store = TableStore(spark, f"{tmp_dir}/m{k}")
        with monkeypatch.context() as m:
            m.setattr(where, step, lambda *a, **kw: 1 / 0)
            with pytest.raises(ZeroDivisionError):
                ST.process_batch(store, raw)
        out = ST.process_batch(TableStore(spark, f"{tmp_dir}/m{k}"), raw)
        assert out["inserted_fact"] == 0 and out["rows_upserted"] > 0
        assert store.read("snapshots").drop(drop).orderBy("merchant_id", "snapshot_time_utc").collect() == want, step
        assert store.read("watermark").first().last_raw_id == 12


def test_one_file_for_a_small_day(spark, tmp_dir):
    import glob

    store = TableStore(spark, tmp_dir + "/store")
    store.append("facts", _hist(spark, dt.datetime(2024, 3, 1), days=4).repartition(8))
    for day in glob.glob(tmp_dir + "/store/facts/event_date=*"):
        assert len(glob.glob(day + "/*.parquet")) == 1


def test_increment_run_loads_more_batches_of_a_larger_table():
    from merchant_signals.plans.catalog import several_batches

    assert [several_batches(n) for n in (0, 5_000, 50_000, 100_000, 600_000, 10 ** 9)] == [2_000, 2_000, 10_000, 20_000, 20_000, 20_000]


def test_catch_up_loads_many_batches_in_few_passes(spark, tmp_dir, monkeypatch):
    from merchant_signals.plans import increment as I

    end = dt.datetime(2024, 3, 11)
    one, many = (_seeded(spark, f"{tmp_dir}/{x}", end) for x in "ab")
    want = []
    while I._pending(one, "SYNTH_LIVE"):
        want.append(I.load_raw_batch(one, "SYNTH_LIVE", 1))
    loads, move = [], I.set_position
    monkeypatch.setattr(I, "set_position", lambda *a: (loads.append(a[1]), move(*a)))
    assert I.catch_up(spark, many, end, batch_size=1)["batches"] == want and len(want) == 12
    assert loads == ["load_position"] * 4 + ["watermark"]
    cols = ["event_id", "raw_id", "merchant_id"]
    assert sorted(many.read("facts").select(*cols).collect()) == sorted(one.read("facts").select(*cols).collect())
