"""Exchange rates from landed payloads."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from casona.functions.labels import FALLBACK_RATE

PAYLOAD = "result string, rates map<string, double>, time_last_update_utc string"


def valid_rates(payloads: DataFrame) -> DataFrame:
    """``(event_id, ts, rate, updated_utc)`` of answers that came, succeeded and have a rate that isn't zero."""
    x = payloads.withColumn("p", F.from_json("body", PAYLOAD))
    rate = F.try_element_at("p.rates", F.lit("MXN"))
    return x.where(F.col("http_ok") & (F.col("p.result") == "success") & (rate != 0)).select("event_id", "ts", rate.alias("rate"), F.col("p.time_last_update_utc").alias("updated_utc"))


def current_rate(payloads: DataFrame) -> DataFrame:
    """One row ``(rate, updated_utc, is_live)``: the latest valid rate, or the fallback."""
    latest = valid_rates(payloads).agg(F.max_by(F.struct("rate", "updated_utc"), F.struct("ts", "event_id")).alias("x"))
    return latest.select(F.coalesce("x.rate", F.lit(FALLBACK_RATE)).alias("rate"), F.col("x.updated_utc").alias("updated_utc"), F.col("x.rate").isNotNull().alias("is_live"))
