"""Wall-clock event times survive any session time zone, including a time
inside a daylight-saving gap (Sao Paulo skipped 00:00-01:00 on 1998-10-11)."""

import datetime as dt

from pyspark.sql import functions as F

from chargeline.operators import mediation, rating
from chargeline.sources.fixtures import usage_raw


def test_gap_time_round_trips_through_text(spark):
    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/Sao_Paulo")
    try:
        typed = spark.sql(
            "SELECT 'r-1' AS record_id, timestamp_ntz'1998-10-11 00:21:00.5' AS ts, 'voice' AS record_type, "
            "'+212000000001' AS party, CAST(NULL AS STRING) AS counterpart, 60L AS secs, "
            "CAST(NULL AS DOUBLE) AS mb, 'RABAT' AS cell_id, '4G' AS technology")
        raw = usage_raw(typed)
        assert raw.collect()[0].timestamp == "1998-10-11 00:21:00"
        norm = mediation.normalize(mediation.parse_messages(mediation.to_messages(raw)))
        row = rating.with_event_time(norm).select("timestamp", "billing_month",
                                                  F.hour("timestamp").alias("h")).collect()[0]
        assert row.timestamp == dt.datetime(1998, 10, 11, 0, 21)
        assert row.billing_month == dt.date(1998, 10, 1)
        assert row.h == 0
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
