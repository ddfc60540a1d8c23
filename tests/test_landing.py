"""Exactly-once landing, refused payloads, consumed rejects, throttled replay."""

import datetime as dt
import json
import os

import pytest
from pyspark.sql import functions as F

from merchant_signals.functions.json import json_merge, json_reject
from merchant_signals.operators import facts as FO
from merchant_signals.plans.increment import load_raw_batch, position
from merchant_signals.schemas import RAW
from merchant_signals.sources import store as store_module
from merchant_signals.sources.store import TableStore
from merchant_signals.streaming.stream import process_batch, start_feature_stream, start_raw_landing, start_replay

T0 = dt.datetime(2024, 3, 1, 12)


def _event(i, merchant="m1", **more):
    t = (T0 + dt.timedelta(minutes=i)).strftime("%Y-%m-%dT%H:%M:%S.000Z")
    return {"event_type": "payment", "merchant_id": merchant, "amount_usd": i, "event_time_utc": t, "ingested_at_utc": t, **more}


def _write(folder, name, lines):
    os.makedirs(folder, exist_ok=True)
    with open(f"{folder}/{name}", "w") as f:
        f.write("\n".join(lines) + "\n")


def _state(store):
    raw = sorted((r["raw_id"], r["source"], r["payload"]) for r in store.read("raw").collect())
    refused = sorted((r["source"], r["payload"] or "", r["reason"]) for r in store.read("refused").collect())
    return raw, sorted(refused, key=lambda r: (r[0], r[2])), store.last_raw_id()


def _forget_last_commit(checkpoint):
    """Take away the record that the last micro-batch was done, as if the driver had died before writing it."""
    names = sorted((n for n in os.listdir(f"{checkpoint}/commits") if n.isdigit()), key=int)
    for n in (names[-1], f".{names[-1]}.crc"):
        if os.path.exists(f"{checkpoint}/commits/{n}"):
            os.remove(f"{checkpoint}/commits/{n}")


def test_a_replayed_micro_batch_lands_once(spark, tmp_dir):
    store = TableStore(spark, tmp_dir + "/store")
    _write(tmp_dir + "/in", "a.json", [json.dumps({"payload": _event(i)}) for i in range(5)])  # no event ids: facts are named after raw ids
    start_raw_landing(spark, store, tmp_dir + "/in", tmp_dir + "/ckpt").awaitTermination()
    before = _state(store)
    assert [r[0] for r in before[0]] == [1, 2, 3, 4, 5]
    process_batch(store, store.read("raw").withColumn("source", F.lit("SYNTH_LIVE")))
    facts = store.read("facts").count()
    _forget_last_commit(tmp_dir + "/ckpt")
    start_raw_landing(spark, store, tmp_dir + "/in", tmp_dir + "/ckpt").awaitTermination()
    assert _state(store) == before
    process_batch(store, store.read("raw").withColumn("source", F.lit("SYNTH_LIVE")))
    assert store.read("facts").count() == facts == 5
    _write(tmp_dir + "/in", "b.json", [json.dumps({"payload": _event(9)})])
    start_raw_landing(spark, store, tmp_dir + "/in", tmp_dir + "/ckpt").awaitTermination()
    assert [r[0] for r in _state(store)[0]] == [1, 2, 3, 4, 5, 6]


@pytest.mark.parametrize("step", ["note", "data"])
def test_a_landing_that_broke_off_is_finished_by_its_replay(spark, tmp_dir, monkeypatch, step):
    """A crash between taking the ids and noting them leaves a gap, one between the note and the rows nothing."""
    store = TableStore(spark, tmp_dir + "/store")
    rows = spark.createDataFrame([("API", json.dumps(_event(i)), T0) for i in range(4)] + [("API", "[1]", T0)],
                                 "source string, payload string, received_at timestamp")
    store.append_raw(rows.limit(1), key="other.0")

    class Crash(Exception):
        pass

    def crash(*_):
        raise Crash

    if step == "note":
        taken = store._take_ids
        monkeypatch.setattr(store, "_take_ids", lambda last: (taken(last), crash()))
    else:
        from pyspark.sql.readwriter import DataFrameWriter

        write = DataFrameWriter.parquet
        monkeypatch.setattr(DataFrameWriter, "parquet",
                            lambda self, path, *a, **k: crash() if "/raw/landing=s.7" in path else write(self, path, *a, **k))
    with pytest.raises(Crash):
        store.append_raw(rows, key="s.7")
    monkeypatch.undo()
    last = store.append_raw(rows, key="s.7")
    ids = sorted(r["raw_id"] for r in store.read("raw").collect())
    assert len(ids) == 5 and len(set(ids)) == 5 and last == max(ids)
    assert ids[1:] == ([6, 7, 8, 9] if step == "note" else [2, 3, 4, 5])
    assert store.read("refused").count() == 1
    assert store.append_raw(rows, key="s.7") == last and sorted(r["raw_id"] for r in store.read("raw").collect()) == ids


def test_landing_leaves_no_copies_behind(spark, tmp_dir):
    from merchant_signals.session import scratch_path

    store = TableStore(spark, tmp_dir + "/store")
    temp = scratch_path(spark, "temp").removeprefix("file:")
    before = set(os.listdir(temp)) if os.path.isdir(temp) else set()
    store.append_raw(spark.createDataFrame([("API", "{}", T0)], "source string, payload string, received_at timestamp"))
    assert set(os.listdir(temp)) <= before


BAD = ["[1,2]", '"x"', "5", "null", "[]", "{broken", '{"a":1} x', None, '[{"merchant_id":"m"}]']


def test_reasons(spark):
    rows = [(x,) for x in BAD + ['{"merchant_id":"a","merchant_id":"b"}', ' {"a":{"b":[1]}}\n', "{}"]]
    got = [r[0] for r in spark.createDataFrame(rows, "p string").select(json_reject("p")).collect()]
    assert got == ["not an object"] * 5 + ["not JSON"] * 2 + ["null", "not an object"] + [None] * 3


def test_poison_payloads_are_consumed(spark, tmp_dir):
    """Rows that are in the raw table whatever they hold: the load passes them, keeps them as rejects and counts them."""
    store = TableStore(spark, tmp_dir + "/store")
    texts = [b for b in BAD if b and b[0] != "{"] + [json.dumps(_event(1, event_id="e1")), '{"merchant_id":"a","merchant_id":"b"}', "{}", '{"merchant_id":""}', '{"merchant_id":null}']
    store.append("raw", spark.createDataFrame([(i + 1, "SYNTH_LIVE", t, T0) for i, t in enumerate(texts)], RAW))
    stats = load_raw_batch(store, "SYNTH_LIVE")
    assert stats == {"processed_rows": len(texts), "inserted_fact": 2, "updated_watermark": len(texts)}
    assert {(r["event_id"], r["merchant_id"]) for r in store.read("facts").collect()} == {("e1", "m1"), ("raw_8", "b")}
    kept = {r["raw_id"]: r["reason"] for r in store.read("rejects").collect()}
    assert set(kept) == set(range(1, len(texts) + 1)) - {7, 8}
    assert (kept[1], kept[5], kept[6], kept[9], kept[10], kept[11]) == ("not an object", "not an object", "not an object", "no merchant", "empty merchant", "no merchant")
    assert position(store, "load_position", "SYNTH_LIVE") == len(texts)
    # a load that died before the position moved keeps them once
    store.replace("load_position", spark.createDataFrame([], store_module.S.WATERMARK))
    assert load_raw_batch(store, "SYNTH_LIVE")["inserted_fact"] == 0
    assert store.read("rejects").count() == len(kept)


def test_the_door_refuses_what_is_no_object(spark, tmp_dir):
    store = TableStore(spark, tmp_dir + "/store")
    lines = [json.dumps({"source": "API", "payload": _event(1)}), json.dumps({"source": "API", "payload": [1, 2]}), json.dumps({"payload": 5}),
             '{"payload": {"merchant_id":"a","merchant_id":"b"}}', "no json", "[1]", json.dumps({"source": "API"})]
    _write(tmp_dir + "/in", "a.json", lines)
    start_raw_landing(spark, store, tmp_dir + "/in", tmp_dir + "/ckpt").awaitTermination()
    raw, refused, last = _state(store)
    assert len(raw) == last == 2
    assert [(s, r) for s, _, r in refused] == [("API", "not an object"), ("API", "null"), ("HTTP", "not JSON"), ("HTTP", "not an object"), ("HTTP", "not an object")]


def test_throttled_replay_obeys_its_bound_and_resumes(spark, tmp_dir):
    store = TableStore(spark, tmp_dir + "/store")
    for i in range(5):
        _write(tmp_dir + "/in", f"{i}.jsonl", [json.dumps(_event(10 * i + j)) for j in range(3)] + ["  "])
    q = start_replay(spark, store, tmp_dir + "/in", tmp_dir + "/ckpt", max_files=2)
    q.awaitTermination()
    sizes = [n["n"] for n in store.spark.read.parquet(store.path("raw")).groupBy("landing").agg(F.count("*").alias("n")).collect()]
    assert sorted(sizes) == [3, 6, 6]
    _write(tmp_dir + "/in", "9.jsonl", [json.dumps(_event(99))])
    start_replay(spark, store, tmp_dir + "/in", tmp_dir + "/ckpt", max_files=2).awaitTermination()
    raw, refused, last = _state(store)
    assert len(raw) == last == 16 and refused == [] and {r[1] for r in raw} == {"SYNTH_STREAM"}


def test_stream_adds_merchants_and_passes_other_sources(spark, tmp_dir):
    store = TableStore(spark, tmp_dir + "/store")
    rows = [(1, "SYNTH_LIVE", json.dumps(_event(1, "m1")), T0), (2, "HTTP", json.dumps(_event(2, "m2")), T0), (3, "SYNTH_LIVE", "[1]", T0)]
    store.append("raw", spark.createDataFrame(rows, RAW))
    start_feature_stream(spark, store, tmp_dir + "/ckpt").awaitTermination()
    assert {r["merchant_id"] for r in store.read("facts").collect()} == {"m1"}
    assert {r["merchant_id"] for r in store.read("dim_merchant").collect()} == {"m1"}
    with pytest.raises(Exception, match="source"):
        start_feature_stream(spark, store, tmp_dir + "/ckpt2", source="HTTP").awaitTermination()


def test_merge_keeps_types(spark):
    p = '{"n":{"k":[1,2]},"b":true,"x":null,"s":"5","i":7,"event_id":"old"}'
    d = spark.createDataFrame([(p,), ("[1]",)], "p string")
    over = F.create_map(F.lit("event_id"), F.lit("new"), F.lit("z"), F.lit("1"))
    got = [r[0] for r in d.select(json_merge("p", over)).collect()]
    assert json.loads(got[0]) == {"n": {"k": [1, 2]}, "b": True, "x": None, "s": "5", "i": 7, "event_id": "new", "z": "1"}
    assert got[1] is None


def test_dedup_sorts_nothing(spark):
    raw = spark.createDataFrame([(i, "SYNTH_LIVE", json.dumps(_event(i, event_id=f"e{i % 3}")), T0) for i in range(9)], RAW)
    one = FO.dedup_first_wins(FO.facts_from_raw(raw))
    assert {(r["event_id"], r["raw_id"]) for r in one.collect()} == {("e0", 0), ("e1", 1), ("e2", 2)}
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert "Sort" not in plan and "ShuffledHashJoin" in plan
