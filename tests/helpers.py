import datetime as dt

from pyspark.sql import functions as F

FACT_DDL = ("event_id string, merchant_id string, event_time_utc timestamp, ingested_at_utc timestamp, "
            "amount_usd decimal(18,2)")


def ts(s: str) -> dt.datetime:
    return dt.datetime.fromisoformat(s)


def facts(spark, rows):
    """rows: (event_id, merchant, event_time, ingested_at, amount)"""
    data = [(e, m, ts(t), ts(i), a) for e, m, t, i, a in rows]
    return spark.createDataFrame(data, FACT_DDL)


def one(df, **filters):
    for k, v in filters.items():
        df = df.filter(F.col(k) == v)
    rows = df.collect()
    assert len(rows) == 1, rows
    return rows[0]
