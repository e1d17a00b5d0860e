"""Hand-written rows for rule boundary tests."""

from __future__ import annotations

import datetime as dt

from chargeline.schemas import CUSTOMERS, NORMALIZED


def records(spark, rows):
    """rows: dicts with any of the normalised columns; the rest default."""
    base = {"record_id": None, "record_type": "voice", "timestamp": dt.datetime(2024, 1, 10, 3, 0, 0),
            "msisdn": "+212000000001", "secondary_msisdn": None, "duration_sec": 60.0,
            "data_volume_mb": None, "cell_id": "RABAT", "technology": "4G", "status": "valid"}
    data = []
    for i, r in enumerate(rows):
        d = dict(base, record_id=f"t-{i}")
        d.update(r)
        data.append(tuple(d[f.name] for f in NORMALIZED.fields))
    return spark.createDataFrame(data, NORMALIZED)


def customers(spark, rows):
    base = {"msisdn": "+212000000001", "customer_name": "Test Customer", "subscription_type": "postpaid",
            "rate_plan_id": 1, "activation_date": dt.date(2023, 6, 1), "status": "active",
            "region": "rural", "student": False}
    data = []
    for r in rows:
        d = dict(base)
        d.update(r)
        data.append(tuple(d[f.name] for f in CUSTOMERS.fields))
    return spark.createDataFrame(data, CUSTOMERS)
