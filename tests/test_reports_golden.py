"""Golden output: the rate-plan report reproduced value for value, in order."""

import os

from chargeline.operators import reports
from chargeline.session import scratch_path
from chargeline.sinks import writers
from chargeline.sources.fixtures import rate_plans

# FIXED VALUES: the committed rate-plan report of the source system.
GOLDEN_RATE_PLANS_CSV = """rate_plan_id,plan_name,service_type,unit_price,free_units,tiered_threshold_mb,tiered_price_mb
6,Premium Plan,data,0.040000000000000000,0,20.0,0.08
3,Standard Plan,data,0.050000000000000000,0,10.0,0.1
5,Premium Plan,sms,0.050000000000000000,6,,
2,Standard Plan,sms,0.050000000000000000,5,,
4,Premium Plan,voice,0.080000000000000000,4,,
1,Standard Plan,voice,0.010000000000000000,2,,
"""


def test_rate_plan_report_csv_is_golden(spark):
    path = scratch_path(spark, "golden-rate-plans")
    writers.write_report_csv(reports.rate_plans_report(rate_plans(spark)), path)
    (part,) = [f for f in os.listdir(path) if f.startswith("part-") and f.endswith(".csv")]
    with open(os.path.join(path, part)) as fh:
        assert fh.read() == GOLDEN_RATE_PLANS_CSV
