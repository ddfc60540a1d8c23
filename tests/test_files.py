from decimal import Decimal

from merchant_signals.schemas import FACT_CSV14
from merchant_signals.sources.files import read_csv, replay_file, replay_lines


def test_copy_null_vs_empty(spark, tmp_dir):
    p = tmp_dir + "/f.csv"
    with open(p, "w") as fh:
        fh.write("whatever,header,names\n")
        fh.write('e1,"",2024-01-01T00:00:00.000000Z,m1,,captured,1.50,,,,,2024-01-01T00:00:00.000000Z,,1\n')
    r = read_csv(spark, p, FACT_CSV14).first()
    assert r.event_type == "" and r.order_id is None and r.label_bad_outcome is None
    assert r.amount_usd == Decimal("1.50") and r.drift_regime_id == 1


def test_replay_skips_blank_lines(spark, tmp_dir):
    p = tmp_dir + "/r.jsonl"
    with open(p, "w") as fh:
        fh.write('{"event_id": "a"}\n\n   \n{"event_id": "b"}\n')
    rows = replay_lines(spark.read.text(p)).collect()
    assert [r.payload for r in rows] == ['{"event_id": "a"}', '{"event_id": "b"}']
    assert {r.source for r in rows} == {"SYNTH_STREAM"}
    assert [r.payload for r in replay_file(spark, p, limit=1).collect()] == ['{"event_id": "a"}']
    assert len(replay_file(spark, p).collect()) == 2


def test_replay_refuses_a_line_that_is_not_json(spark, tmp_dir):
    import pytest

    p = tmp_dir + "/b.jsonl"
    with open(p, "w") as fh:
        fh.write('{"event_id": "a"}\n{"event_id": \n')
    with pytest.raises(Exception, match="not JSON"):
        replay_file(spark, p).collect()


def test_fact_and_dim_csv_loads_are_all_or_nothing(spark, tmp_dir):
    import pytest

    from merchant_signals.sources.files import load_dim_csv, load_fact_csv

    ok = tmp_dir + "/ok.csv"
    with open(ok, "w") as fh:
        fh.write("h\n")
        fh.write("e1,payment,2024-01-01T00:00:00.000000Z,m1,o1,captured,1.00,,,,,2024-01-01T00:00:00.000000Z,0,0\n")
        fh.write("e2,payment,2024-01-01T00:00:00.000000Z,m1,o2,captured,2.00,,,,,2024-01-01T00:00:00.000000Z,1,0\n")
    existing = spark.createDataFrame([("e1",)], "event_id string")
    new, n = load_fact_csv(spark, ok, existing)
    assert n == {"staged_rows": 2, "fact_total_rows": 2} and [r.event_id for r in new.collect()] == ["e2"]
    bad = tmp_dir + "/bad.csv"
    with open(bad, "w") as fh:
        fh.write("h\n")
        fh.write("e3,,2024-01-01T00:00:00.000000Z,m1,o3,captured,1.00,,,,,2024-01-01T00:00:00.000000Z,0,0\n")
    with pytest.raises(ValueError):
        load_fact_csv(spark, bad, existing)
    empty = tmp_dir + "/empty.csv"
    with open(empty, "w") as fh:
        fh.write("h\n")
    with pytest.raises(ValueError):
        load_fact_csv(spark, empty, existing)
    target = spark.createDataFrame([], "merchant_id string")
    with pytest.raises(ValueError):
        load_dim_csv(spark, empty, target)


def test_raw_landing_ids_are_dense_and_continue(spark, tmp_dir):
    import datetime as dt

    from merchant_signals.sources.store import TableStore

    store = TableStore(spark, tmp_dir + "/store")
    t = dt.datetime(2024, 1, 1)
    first = spark.createDataFrame([("S", f'{{"n": {i}}}', t + dt.timedelta(seconds=i)) for i in range(5)],
                                  "source string, payload string, received_at timestamp")
    assert store.append_raw(first) == 5
    second = spark.createDataFrame([("S", f'{{"n": {i}}}', t + dt.timedelta(seconds=i)) for i in range(5, 8)],
                                   "source string, payload string, received_at timestamp")
    assert store.append_raw(second) == 8
    got = sorted((r.raw_id, r.payload) for r in store.read("raw").collect())
    assert got == [(i + 1, f'{{"n": {i}}}') for i in range(8)]
    assert store.read("raw_sequence").first().last_raw_id == 8


def test_fact_csv_keeps_one_row_per_id_and_all_columns(spark, tmp_dir):
    import pytest

    from merchant_signals.sources.files import load_fact_csv
    from merchant_signals.sources.store import TableStore

    p = tmp_dir + "/dup.csv"
    line = "{e},payment,2024-01-0{d}T00:00:00.000000Z,m1,o{d},captured,1.00,hash,US,5411,S,2024-01-09T00:00:00.000000Z,1,7\n"
    with open(p, "w") as fh:
        fh.write("h\n" + line.format(e="e1", d=3) + line.format(e="e1", d=2) + line.format(e="e2", d=1))
    store = TableStore(spark, tmp_dir + "/store")
    new, n = load_fact_csv(spark, p, store.read("facts"))
    assert n == {"staged_rows": 3, "fact_total_rows": 2}
    store.append("facts", new)
    got = {r.event_id: r for r in store.read("facts").collect()}
    assert got["e1"].order_id == "o3" and set(got) == {"e1", "e2"}
    assert (got["e1"].payer_id_hash, got["e1"].merchant_country, got["e1"].merchant_mcc, got["e1"].drift_regime_id) == ("hash", "US", "5411", 7)
    with open(p, "w") as fh:
        fh.write("h\n" + line.format(e="", d=3))
    with pytest.raises(ValueError):
        load_fact_csv(spark, p, store.read("facts"))


def test_dimension_keeps_all_file_columns(spark, tmp_dir):
    from merchant_signals.schemas import DIM_COLUMNS
    from merchant_signals.sources.files import load_dim_csv
    from merchant_signals.sources.store import TableStore

    p = tmp_dir + "/dim.csv"
    with open(p, "w") as fh:
        fh.write(",".join("c" * 22) + "\n" + "m1,Shop,2024-01-01,SMB,5411,Grocery,LOW,OK,ACTIVE,US,NY,UTC,f1,0.0290,0.30,T+2,DAILY,ACH,0.0000,10.00,5,"
                 "2024-01-01T00:00:00.000000Z\n")
    store = TableStore(spark, tmp_dir + "/store")
    store.append("dim_merchant", spark.createDataFrame([("m1", "old"), ("m2", "kept")], "merchant_id string, merchant_name string"))
    state, n = load_dim_csv(spark, p, store.read("dim_merchant"))
    store.replace("dim_merchant", state)
    got = {r.merchant_id: r for r in store.read("dim_merchant").collect()}
    assert n == 1 and got["m1"].merchant_name == "Shop" and got["m1"].state == "NY" and got["m2"].merchant_name == "kept"
    assert set(DIM_COLUMNS) < set(store.read("dim_merchant").columns)


def test_fact_csv_keeps_the_first_in_file_order_over_files_and_splits(spark, tmp_dir):
    import os

    import pytest

    from merchant_signals.sources.files import load_fact_csv

    os.makedirs(tmp_dir + "/in")
    line = "e{e},payment,2024-01-0{d}T00:00:00.000000Z,m1,{o},captured,1.00,,,,,2024-01-09T00:00:00.000000Z,1,7\n"
    first = {}
    for f in ("b", "a", "c"):
        with open(f"{tmp_dir}/in/{f}.csv", "w") as fh:
            fh.write("h\n" + "".join(line.format(e=i * 7 % 50, d=1 + (i + ord(f)) % 9, o=f"{f}{i}") for i in range(400)))
    for f in ("a", "b", "c"):
        for i in range(400):
            first.setdefault(f"e{i * 7 % 50}", f"{f}{i}")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2000")
    try:
        new, n = load_fact_csv(spark, tmp_dir + "/in", spark.createDataFrame([], "event_id string"))
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert n == {"staged_rows": 1200, "fact_total_rows": 50}
    assert {r.event_id: r.order_id for r in new.collect()} == first
    with open(tmp_dir + "/lines.csv", "w") as fh:
        fh.write("h\n" + line.format(e=1, d=1, o='"two\nlines"'))
    with pytest.raises(Exception):
        load_fact_csv(spark, tmp_dir + "/lines.csv", spark.createDataFrame([], "event_id string"))
