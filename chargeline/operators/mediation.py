"""Mediation: parse raw usage messages, normalise, validate, route, de-duplicate.

All steps are narrow (no shuffle) except de-duplication of valid records.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chargeline.operators.dedup import dedupe
from chargeline.rules import DEFAULT_RULES, Rules
from chargeline.schemas import NORMALIZED, USAGE_RAW

NORMALIZED_COLUMNS = NORMALIZED.fieldNames()


def parse_messages(messages: DataFrame, value_col: str = "value") -> DataFrame:
    """JSON text -> raw usage columns. Malformed text yields an all-NULL row and
    a field of the wrong type yields NULL (PERMISSIVE parsing); unknown fields
    are dropped."""
    text = F.col(value_col).cast("string")
    return messages.select(F.from_json(text, USAGE_RAW).alias("m")).select("m.*")


# Text shape of the default event-time format, yyyy-MM-dd HH:mm:ss.
_DEFAULT_TS_SHAPE = r"^\d{4}-\d{2}-\d{2} \d{2}:\d{2}:\d{2}$"


def parse_event_time(col: Column, rules: Rules = DEFAULT_RULES) -> Column:
    """Text -> TIMESTAMP_NTZ; unparsable text becomes NULL instead of failing.

    For the default format the text is checked for its exact shape and then
    cast straight to TIMESTAMP_NTZ, which never consults a time zone (a
    wall-clock time inside a daylight-saving gap of the session zone keeps
    its value). Other formats go through ``try_to_timestamp``.
    """
    if rules.timestamp_format == "yyyy-MM-dd HH:mm:ss":
        return F.when(col.rlike(_DEFAULT_TS_SHAPE), col.try_cast("timestamp_ntz"))
    return F.try_to_timestamp(col, F.lit(rules.timestamp_format)).cast("timestamp_ntz")


def normalize(raw: DataFrame, rules: Rules = DEFAULT_RULES) -> DataFrame:
    rt = F.col("record_type")
    duration = (F.when(rt == "data", F.col("session_duration_sec"))
                 .when(rt == "voice", F.col("duration_sec")))
    return raw.select(
        "record_id",
        "record_type",
        parse_event_time(F.col("timestamp"), rules).alias("timestamp"),
        F.coalesce("caller_id", "sender_id", "user_id").alias("msisdn"),
        F.coalesce("callee_id", "receiver_id").alias("secondary_msisdn"),
        duration.cast("double").alias("duration_sec"),
        F.col("data_volume_mb").cast("double").alias("data_volume_mb"),
        "cell_id",
        "technology",
        F.lit("valid").alias("status"),
    )


def error_condition(rules: Rules = DEFAULT_RULES) -> Column:
    """Three-valued on purpose: a NULL record_type alone leaves the condition
    NULL, so the record stays valid (and is later unmatched)."""
    msisdn = F.col("msisdn")
    bad_prefix = reduce(lambda a, b: a | b,
                        [msisdn.startswith(p) for p in rules.invalid_msisdn_prefixes])
    return (F.col("record_id").isNull()
            | msisdn.isNull()
            | bad_prefix
            | (F.col("duration_sec").isNotNull() & (F.col("duration_sec") < 0))
            | (F.col("data_volume_mb").isNotNull() & (F.col("data_volume_mb") < 0))
            | ~F.col("record_type").isin(*rules.record_types))


def _computed_once(df: DataFrame) -> DataFrame:
    """The same rows; a filter above is not pushed below.

    Spark moves a filter under the projections it refers to and puts their
    expressions in place of each mention, so a filter on the status would
    parse the JSON text of a row (or compute its fields) a dozen times. It
    does not move one under a generator.
    """
    return df.select(F.inline(F.array(F.struct(*df.columns))))


def validate(normalized: DataFrame, rules: Rules = DEFAULT_RULES) -> DataFrame:
    return _computed_once(normalized).withColumn(
        "status", F.when(error_condition(rules), F.lit("error")).otherwise(F.col("status")))


def mediate(raw: DataFrame, rules: Rules = DEFAULT_RULES) -> DataFrame:
    return validate(normalize(raw, rules), rules)


def valid_records(mediated: DataFrame) -> DataFrame:
    return mediated.filter(F.col("status") == "valid")


def dead_letters(mediated: DataFrame) -> DataFrame:
    return mediated.filter(F.col("status") == "error")


def dedupe_records(records: DataFrame) -> DataFrame:
    """Batch de-duplication by record_id; survivor = earliest event time, then
    the remaining columns (deterministic across runs and engines)."""
    return dedupe(records, ["record_id"], ["timestamp"])


def serialize(records: DataFrame, key: str | None = None) -> DataFrame:
    """Records -> one JSON text column ``value`` (NULL fields omitted), plus a
    message ``key`` column when ``key`` names a column (e.g. record_id, so all
    copies of a record go to the same topic partition)."""
    value = F.to_json(F.struct(*[F.col(c) for c in records.columns])).alias("value")
    out = records.withColumn("timestamp", F.col("timestamp").cast("string"))
    return out.select(F.col(key).alias("key"), value) if key else out.select(value)


def status_counts(mediated: DataFrame) -> DataFrame:
    return mediated.groupBy("status").agg(F.count(F.lit(1)).alias("records"))


def parse_normalized_messages(messages: DataFrame, value_col: str = "value",
                              rules: Rules = DEFAULT_RULES) -> DataFrame:
    """JSON text of normalised records (as written by ``serialize``) -> the
    normalised layout; event time text is parsed as in mediation."""
    wire = T.StructType([T.StructField(f.name, T.StringType() if f.name == "timestamp" else f.dataType)
                         for f in NORMALIZED.fields])
    parsed = messages.select(F.from_json(F.col(value_col).cast("string"), wire).alias("m")).select("m.*")
    return parsed.withColumn("timestamp", parse_event_time(F.col("timestamp"), rules))


def to_messages(raw: DataFrame) -> DataFrame:
    """Raw usage columns -> JSON text ``value`` (the wire form)."""
    return raw.select(F.to_json(F.struct(*[F.col(c) for c in raw.columns])).alias("value"))
