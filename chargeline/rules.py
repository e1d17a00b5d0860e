"""Business rules as one immutable parameter object.

FIXED VALUES: the defaults below are the rule constants of the billing system
being reproduced (validation, rating multipliers, billing thresholds, discounts,
taxes, document texts). They must keep these values for results to match.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass, replace


@dataclass(frozen=True)
class Rules:
    # ---- FIXED VALUES: mediation --------------------------------------------
    record_types: tuple[str, ...] = ("voice", "sms", "data")
    invalid_msisdn_prefixes: tuple[str, ...] = ("999",)
    timestamp_format: str = "yyyy-MM-dd HH:mm:ss"

    # ---- FIXED VALUES: rating -----------------------------------------------
    roaming_cells: tuple[str, ...] = ("PARIS", "TOULOUSE", "NEW YORK")
    premium_services: tuple[str, ...] = ("voice", "sms")
    premium_marker: str = "Premium"
    evening_hours: tuple[int, int] = (18, 23)
    evening_factor: float = 1.02
    morning_hours: tuple[int, int] = (8, 12)
    morning_factor: float = 0.98
    friday_factor: float = 0.97
    roaming_factor: float = 1.5

    # ---- FIXED VALUES: billing ----------------------------------------------
    vat_rate: float = 0.20
    regulatory_fee: float = 1.5
    seasonal_month: int = 3
    seasonal_rate: float = 0.10
    voice_threshold_minutes: float = 300.0
    voice_discount_rate: float = 0.10
    data_threshold_mb: float = 2000.0
    data_discount_rate: float = 0.08
    spend_threshold: float = 100.0
    spend_discount_rate: float = 0.05
    student_discount_rate: float = 0.15
    urban_discount_rate: float = 0.05
    loyalty_rate_per_year: float = 0.02
    loyalty_max_rate: float = 0.10
    loyalty_min_months: float = 12.0
    days_per_month: float = 30.0
    invoice_status: str = "pending"
    money_scale: int = 4

    # ---- FIXED VALUES: documents --------------------------------------------
    unknown_plan_name: str = "Unknown Plan"
    dead_record_source: str = "rating_engine"
    mediation_source: str = "mediation"
    mail_subject_prefix: str = "Your Monthly Telecom Invoice - "
    mail_body_intro: str = (
        "Please find your monthly invoice attached. Thank you for using our services."
    )
    report_row_limit: int = 1000

    # ---- run parameters (not fixed; chosen per run) -------------------------
    period_start: dt.datetime = dt.datetime(2024, 1, 1)
    period_end: dt.datetime = dt.datetime(2024, 2, 1)
    as_of: dt.datetime = dt.datetime(2024, 1, 31)
    # half-open [start, end) by default; True reproduces an inclusive end bound
    inclusive_period_end: bool = False
    # streaming de-duplication horizon on event time
    # None: exact streaming de-duplication; a duration bounds its state and drops later rows
    dedup_watermark: str | None = None
    # dimensions below this many rows are broadcast; larger ones shuffle

    def __post_init__(self):
        if self.period_end <= self.period_start:
            raise ValueError(f"period_end {self.period_end} must be after period_start {self.period_start}")
        rates = ("vat_rate", "seasonal_rate", "voice_discount_rate", "data_discount_rate",
                 "spend_discount_rate", "student_discount_rate", "urban_discount_rate",
                 "loyalty_rate_per_year", "loyalty_max_rate")
        for name in rates:
            if not 0.0 <= getattr(self, name) <= 1.0:
                raise ValueError(f"{name} must be within [0, 1], got {getattr(self, name)}")
        if not 1 <= self.seasonal_month <= 12:
            raise ValueError(f"seasonal_month must be 1..12, got {self.seasonal_month}")
        if self.report_row_limit < 0:
            raise ValueError("row limits must not be negative")

    @property
    def voice_discount_factor(self) -> float:
        return 1.0 - self.voice_discount_rate

    @property
    def data_discount_factor(self) -> float:
        return 1.0 - self.data_discount_rate

    def with_period(self, start: dt.datetime, end: dt.datetime, as_of: dt.datetime) -> "Rules":
        return replace(self, period_start=start, period_end=end, as_of=as_of)


DEFAULT_RULES = Rules()


# Where each rule lives in the per-stage YAML configuration files of the
# source system (section path -> Rules field).
CONFIG_KEYS = {
    ("billing", "taxes", "vat_rate"): "vat_rate",
    ("billing", "taxes", "regulatory_fee"): "regulatory_fee",
    ("billing", "seasonal_discounts", "ramadan_month"): "seasonal_month",
    ("billing", "seasonal_discounts", "ramadan_discount"): "seasonal_rate",
    ("billing", "usage_thresholds", "voice", "threshold_minutes"): "voice_threshold_minutes",
    ("billing", "usage_thresholds", "voice", "discount_rate"): "voice_discount_rate",
    ("billing", "usage_thresholds", "data", "threshold_mb"): "data_threshold_mb",
    ("billing", "usage_thresholds", "data", "discount_rate"): "data_discount_rate",
    ("billing", "usage_thresholds", "total_spending", "threshold_amount"): "spend_threshold",
    ("billing", "usage_thresholds", "total_spending", "discount_rate"): "spend_discount_rate",
    ("billing", "discounts", "student_discount_rate"): "student_discount_rate",
    ("billing", "discounts", "loyalty_discount_per_year"): "loyalty_rate_per_year",
    ("billing", "discounts", "max_loyalty_discount"): "loyalty_max_rate",
}


def rules_from_config(config: dict, base: Rules = DEFAULT_RULES) -> Rules:
    """Rules from a parsed YAML configuration; absent keys keep ``base``.

    The urban discount key is deliberately not mapped: the source system
    ignores it and applies its fixed rate (kept as ``urban_discount_rate``).
    """
    updates = {}
    for path, field_name in CONFIG_KEYS.items():
        node = config
        for k in path:
            if not isinstance(node, dict) or k not in node:
                node = None
                break
            node = node[k]
        if node is not None:
            updates[field_name] = type(getattr(base, field_name))(node)
    return replace(base, **updates)


def rules_from_yaml(path: str, base: Rules = DEFAULT_RULES) -> Rules:
    import yaml

    with open(path) as fh:
        return rules_from_config(yaml.safe_load(fh) or {}, base)
