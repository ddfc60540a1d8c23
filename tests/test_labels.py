import datetime as dt
import random

from merchant_signals.operators.labels import next_24h_labels

FDDL = ("event_id string, merchant_id string, event_time_utc timestamp, label_bad_outcome int, "
        "label_anomaly int, label_dispute_lost int")


def test_labels_match_brute_force(spark):
    random.seed(11)
    t0 = dt.datetime(2024, 1, 1)
    facts = []
    for i in range(400):
        e = t0 + dt.timedelta(seconds=random.randint(0, 4 * 86400))
        facts.append((f"e{i}", f"m{random.randint(1, 3)}", e, random.choice([0, 1, None]),
                      random.choice([0, 0, 1]), random.choice([0, 0, 0, 1])))
    snaps = [(f"m{m}", t0 + dt.timedelta(minutes=15 * k)) for m in range(1, 5) for k in range(0, 4 * 96, 7)]
    sdf = spark.createDataFrame(snaps, "merchant_id string, snapshot_time_utc timestamp")
    got = {(r.merchant_id, r.snapshot_time_utc): (r.label_bad_outcome_24h, r.label_anomaly_24h,
                                                  r.label_dispute_lost_24h)
           for r in next_24h_labels(sdf, spark.createDataFrame(facts, FDDL)).collect()}
    exp = {}
    for m, T in snaps:
        hit = [f for f in facts if f[1] == m and T <= f[2] < T + dt.timedelta(hours=24)]
        exp[(m, T)] = tuple(max([f[k] or 0 for f in hit], default=0) for k in (3, 4, 5))
    assert got == exp


def test_a_tasks_share_of_the_history_is_not_merged(spark):
    """Adaptive execution merges partitions by compressed bytes; those of the backfill and the labels are kept."""
    import re

    from merchant_signals.operators.features import snapshot_backfill
    from merchant_signals.operators.labels import next_24h_labels
    from merchant_signals.plans import views as V

    def dealt(df):
        return re.findall(r"hashpartitioning\((.*), (\d+)\), REPARTITION_BY_NUM", df._jdf.queryExecution().executedPlan().toString())

    n = spark.conf.get("spark.sql.shuffle.partitions")
    facts = V.hist_facts(spark, "/root/testdata/sf0.001")
    snaps = snapshot_backfill(facts)
    assert [(k.startswith("merchant_id"), p) for k, p in dealt(snaps)] == [(True, n)]
    keys = [k for k, p in dealt(next_24h_labels(snaps, facts)) if p == n]
    assert any("_day" in k for k in keys) and any("snapshot_time_utc" in k for k in keys)
