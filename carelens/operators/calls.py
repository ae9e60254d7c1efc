"""Service-call features (#17-#47, #82).

Two aggregation levels: per (customer, machine) -- which carries every
count, max and partial sum -- then per customer.  Means over machines
(#23, #41-#45) use the per-machine means, skipping calls without a machine
serial; everything else folds the per-machine partials.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from carelens.config import FeatureConfig
from carelens.functions.expr import (
    age_days,
    exact_mean,
    exact_sum,
    first_row_struct,
    floor_days,
    key_text,
    latest_first_order,
    strict_int_key,
)
from carelens.sources.inputs import Sources

# Fixed values: (output column, service type, machine status), in output order.
SERVICE_COUNTS = [
    ("closed_minor_og_count", "Minor", "OG"),
    ("closed_minor_amc_count", "Minor", "AMC"),
    ("closed_minor_sw_count", "Minor", "SW"),
    ("closed_minor_ew_count", "Minor", "EW"),
    ("closed_major_sw_count", "Major", "SW"),
    ("closed_major_amc_count", "Major", "AMC"),
    ("closed_major_ew_count", "Major", "EW"),
    ("closed_major_og_count", "Major", "OG"),
]
# Fixed values: (output column, medium) for customer-raised closed calls.
MEDIUM_COUNTS = [
    ("customer_closed_email_count", "Email"),
    ("customer_closed_phone_count", "Phone"),
    ("customer_closed_wp_count", "WhatsApp"),
]
# Turnaround columns by machine status, in output order.
TAT_COLUMNS = [("AVG_TAT_SW", "SW"), ("AVG_TAT_AMC", "AMC"), ("AVG_TAT_EW", "EW"), ("AVG_TAT_OG", "OG")]


def prepare(src: Sources, cfg: FeatureConfig) -> DataFrame:
    c = src.calls.where(F.col("CustomerCode").isNotNull())
    t = {f.name: f.dataType for f in c.schema.fields}
    return c.select(
        strict_int_key("CustomerCode").alias("customer"),
        key_text("ProductSerial", t["ProductSerial"]).alias("serial"),
        "Status",
        "Origin",
        "Medium",
        "ServiceType",
        "MachineStatus",
        F.coalesce(F.nanvl("Esclationlevel", F.lit(None)), F.lit(0.0)).alias("esc"),
        F.coalesce(F.nanvl("npSrating", F.lit(None)), F.lit(0.0)).alias("nps"),
        "PostingDate",
        "SoftClosureDate",
        "ClosedOn",
        F.col("NegativeResponseRemarks").isNotNull().alias("has_remark"),
        "NegativeReponseRemarksDate",
        *src.tiebreak("calls"),
    )


# The columns that ``per_machine`` reads, beside those that give the file order.
FOLD_INPUT = ("customer", "serial", "Status", "Origin", "Medium", "ServiceType", "MachineStatus", "esc", "nps", "PostingDate",
              "SoftClosureDate", "ClosedOn", "has_remark", "NegativeReponseRemarksDate")


def _mean_parts(name: str, days: Column) -> list[Column]:
    return [F.sum(days).alias(f"{name}_s"), F.count(days).alias(f"{name}_c")]


def per_machine(calls: DataFrame, tiebreak: list[str]) -> DataFrame:
    """Per (customer, machine): every count, max and partial sum the
    customer-level call features fold, and the latest call (#40: first in
    file order among calls closed at the same time, undated calls only when
    nothing else is there), in one aggregation."""
    closed = F.col("Status") == "Closed"
    cancelled = F.col("Status") == "Cancelled"
    by_cust = F.col("Origin") == "Customer"
    esc = F.col("esc")
    aggs = [
        F.count(F.lit(1)).alias("n_calls"),
        F.count_if(closed).alias("closed_status_count"),
        F.count_if(cancelled).alias("cancelled_status_count"),
        F.count_if(by_cust & closed).alias("customer_closed_status_count"),
        F.count_if(by_cust & cancelled).alias("customer_cancelled_status_count"),
        F.max(F.when(closed, F.col("ClosedOn"))).alias("last_closed_on"),
        F.count_if(F.col("has_remark") & closed).alias("negative_remarks_count"),
        F.max(F.when(F.col("has_remark"), F.col("NegativeReponseRemarksDate"))).alias("last_remark_date"),
        F.max(F.when(~esc.isin(98.0, 99.0), esc)).alias("max_escalation"),
        F.count_if(esc == 99.0).alias("count_of_99"),
        F.count_if(esc == 98.0).alias("count_of_98"),
        exact_sum("nps").alias("nps_sum"),
        F.max("nps").alias("max_nps"),
        first_row_struct("nps", latest_first_order("ClosedOn", tiebreak)).alias("latest"),
        *_mean_parts("soft", floor_days("SoftClosureDate", "PostingDate")),
        *_mean_parts("cnr", floor_days("ClosedOn", "NegativeReponseRemarksDate")),
    ]
    for name, medium in MEDIUM_COUNTS:
        aggs.append(F.count_if(by_cust & closed & (F.col("Medium") == medium)).alias(name))
    for name, service, status in SERVICE_COUNTS:
        aggs.append(
            F.count_if((F.col("ServiceType") == service) & closed & (F.col("MachineStatus") == status)).alias(name)
        )
    for name, status in TAT_COLUMNS:
        aggs += _mean_parts(name, F.when(F.col("MachineStatus") == status, floor_days("ClosedOn", "PostingDate")))
    return calls.groupBy("customer", "serial").agg(*aggs)


# How two folds of one machine become one; all other columns are summed.
MERGE = {"last_closed_on": F.max, "last_remark_date": F.max, "max_escalation": F.max, "max_nps": F.max, "latest": F.min, "nps_sum": exact_sum}


def media(calls: DataFrame) -> DataFrame:
    """The different (customer, medium) pairs."""
    return calls.where(F.col("Medium").isNotNull()).select("customer", "Medium").distinct()


def summary(calls: DataFrame, tiebreak: list[str], cfg: FeatureConfig) -> DataFrame:
    """One row per customer with calls; ``calls`` is the output of ``prepare``."""
    return from_folds(per_machine(calls, tiebreak), media(calls), cfg)


def from_folds(m: DataFrame, media: DataFrame, cfg: FeatureConfig) -> DataFrame:
    """``summary`` from the outputs of ``per_machine`` and ``media``; #39 counts
    the latter."""
    has_serial = F.col("serial").isNotNull()

    def machine_mean(name: str) -> Column:
        level1 = F.when(has_serial & (F.col(f"{name}_c") > 0), F.col(f"{name}_s") / F.col(f"{name}_c"))
        return exact_mean(level1)

    count_cols = (
        ["closed_status_count", "cancelled_status_count", "customer_closed_status_count",
         "customer_cancelled_status_count", "negative_remarks_count", "count_of_99", "count_of_98"]
        + [n for n, _ in MEDIUM_COUNTS]
        + [n for n, _, _ in SERVICE_COUNTS]
    )
    agg = m.groupBy("customer").agg(
        *[F.sum(c).alias(c) for c in count_cols],
        F.max("last_closed_on").alias("last_closed_on"),
        F.max("last_remark_date").alias("last_remark_date"),
        machine_mean("soft").alias("soft_post_days_diff"),
        F.max("max_escalation").alias("max_escalation"),
        (exact_sum("nps_sum") / F.sum("n_calls")).alias("avg_nps"),
        F.max("max_nps").alias("max_nps"),
        F.min("latest")["v"].alias("latest_nps_rating"),
        machine_mean("cnr").alias("close_nr_days_diff"),
        *[machine_mean(n).alias(n) for n, _ in TAT_COLUMNS],
    )
    agg = agg.join(media.groupBy("customer").agg(F.count(F.lit(1)).alias("unique_medium_count")), "customer", "left")
    return agg.withColumns(
        {
            "unique_medium_count": F.coalesce("unique_medium_count", F.lit(0)),
            "days_since_last_closed_status": age_days("last_closed_on", cfg.as_of),
            "days_since_latest_neg_remark": age_days("last_remark_date", cfg.as_of),
            "latest_max_nps_diff": F.col("latest_nps_rating") - F.col("max_nps"),
        }
    ).drop("last_closed_on", "last_remark_date")
