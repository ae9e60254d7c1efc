"""Maintenance-contract features (#48-#56, #77) and the per-machine contract
facts reused by the spare-part features (#63-#65, #78-#79)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from carelens.config import FeatureConfig
from carelens.functions.expr import (
    CONVERSION_PRIORITY,
    NULL_KEY,
    age_days,
    code_map,
    exact_sum,
    ieee_div,
    norm_key,
)
from carelens.sources.inputs import Sources

# Fixed values: (output column, contract type), in output order.
TYPE_COUNTS = [
    ("unique_prod_ser_superwarranty", "Super Warranty"),
    ("unique_prod_ser_exwarranty", "Extended Warranty"),
    ("unique_prod_ser_labamc", "Labour AMC"),
    ("unique_prod_ser_mot", "Motor Warranty"),
    ("unique_prod_ser_amc", "AMC"),
]


def prepare(src: Sources, cfg: FeatureConfig) -> DataFrame:
    df = src.contracts
    t = {f.name: f.dataType for f in df.schema.fields}
    out = df.select(
        norm_key("CustomerCode", t["CustomerCode"]).alias("customer"),
        norm_key("SrNo", t["SrNo"]).alias("serial"),
        norm_key("IcrNo", t["IcrNo"]).alias("icr"),
        F.col("AmcType").alias("amc_type"),
        F.col("ContStrtDat").alias("start"),
        F.col("ContEndDat").alias("end"),
        F.nanvl("Price", F.lit(None)).alias("price"),
        code_map("WarConv", CONVERSION_PRIORITY).alias("priority"),
    )
    if cfg.drop_null_keys:
        out = out.where((F.col("customer") != NULL_KEY) & (F.col("serial") != NULL_KEY))
    return out.distinct() if cfg.dedupe_contracts else out


def per_machine(con: DataFrame) -> DataFrame:
    """Per (customer, machine): which contract types it had, best conversion,
    contract span, number of contract rows and top price."""
    flags = [
        F.max(F.col("amc_type") == t).cast("int").alias(f"has_{i}") for i, (_, t) in enumerate(TYPE_COUNTS)
    ]
    return con.groupBy("customer", "serial").agg(
        *flags,
        F.max("priority").alias("priority"),
        F.min("start").alias("min_start"),
        F.max("end").alias("max_end"),
        F.count(F.lit(1)).alias("n_contracts"),
        F.max("price").alias("max_price"),
        exact_sum("price").alias("price_total"),
    )


# How two folds of one machine become one; all other columns take the larger.
MERGE = {"min_start": F.min, "n_contracts": F.sum, "price_total": exact_sum}


def numbers(con: DataFrame) -> DataFrame:
    """The different (customer, contract number) pairs."""
    return con.select("customer", "icr").distinct()


def number_counts(numbers: DataFrame) -> DataFrame:
    """#53 alone, from the output of ``numbers``: no fold by machine."""
    return numbers.groupBy("customer").agg(F.count(F.lit(1)).alias("unique_icrno_count"))


def summary(con: DataFrame, machine: DataFrame, cfg: FeatureConfig) -> DataFrame:
    """One row per customer with a contract: #48-#56, #77 and
    ``con_end_date_max`` (for #57)."""
    return from_folds(numbers(con), machine, cfg)


def from_folds(numbers: DataFrame | None, machine: DataFrame, cfg: FeatureConfig) -> DataFrame:
    """``summary`` from the outputs of ``numbers`` and ``per_machine``; without
    the former, it lacks #53 and #56."""
    by_machine = machine.groupBy("customer").agg(
        *[
            F.coalesce(F.sum(f"has_{i}"), F.lit(0)).cast("bigint").alias(name)
            for i, (name, _) in enumerate(TYPE_COUNTS)
        ],
        F.avg("priority").alias("loyalty_score"),
        F.max("max_end").alias("con_end_date_max"),
        exact_sum("price_total").alias("sum_amc_price"),
    )
    out, counted = by_machine, []
    if numbers is not None:  # of the same rows, so it has the same customers
        out = by_machine.join(number_counts(numbers), "customer", "left")
        counted = ["unique_icrno_count", ieee_div("sum_amc_price", "unique_icrno_count").alias("avg_price_amc")]
    return out.select(
        "customer",
        *[name for name, _ in TYPE_COUNTS],
        *counted,
        age_days("con_end_date_max", cfg.as_of).alias("days_left_for_current_amc_to_be_ended"),
        "sum_amc_price",
        "loyalty_score",
        "con_end_date_max",
    )
