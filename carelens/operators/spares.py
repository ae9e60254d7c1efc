"""Spare-part features: repeat parts (#58), repeat parts inside a contract
(#63/#64), contract start vs. first consumption (#65) and contract
profitability (#78/#79)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from carelens.config import FeatureConfig
from carelens.functions.expr import (
    NULL_KEY,
    exact_mean,
    exact_sum,
    floor_days,
    ieee_div,
    int_mean,
    key_text,
    norm_key,
)
from carelens.sources.inputs import Sources


def prepare(src: Sources, cfg: FeatureConfig) -> DataFrame:
    df = src.spares
    t = {f.name: f.dataType for f in df.schema.fields}
    out = df.select(
        norm_key("CustomerC", t["CustomerC"]).alias("customer"),
        norm_key("Serial", t["Serial"]).alias("serial"),
        key_text("ItemNo", t["ItemNo"]).alias("item"),
        F.nanvl("NetValue", F.lit(None)).alias("net"),
        F.col("ItemCategory").alias("category"),
        F.col("CallBookDate").alias("booked"),
    )
    if cfg.drop_null_keys:
        out = out.where((F.col("customer") != NULL_KEY) & (F.col("serial") != NULL_KEY))
    return out


def machine_fold(sp: DataFrame) -> DataFrame:
    """Per (customer, machine): first booking, and the number and summed
    cost of contract-covered (ZAMC) part rows."""
    zamc = F.col("category") == "ZAMC"
    return sp.groupBy("customer", "serial").agg(
        F.min("booked").alias("first_booked"),
        F.count_if(zamc).alias("n_zamc"),
        exact_sum(F.when(zamc, F.col("net"))).alias("net_total"),
    )


# How two folds of one machine become one; all other columns are summed.
MERGE = {"first_booked": F.min, "net_total": exact_sum}


def booking_days(sp: DataFrame) -> DataFrame:
    """The different (customer, machine, item, booking time)s."""
    return sp.where(F.col("item").isNotNull() & F.col("booked").isNotNull()).select("customer", "serial", "item", "booked").distinct()


def repeat_parts(sp: DataFrame, machine: DataFrame, dealt: bool = False) -> DataFrame:
    """``repeats`` of the output of ``prepare``."""
    return repeats(booking_days(sp), machine, dealt)


def repeats(booked: DataFrame, machine: DataFrame, dealt: bool = False) -> DataFrame:
    """#58 and #63/#64.  Per (customer, machine, item): distinct booking
    days, overall and strictly inside the span from the machine's first
    contract start to its last contract end.  An item repeats when it has
    more than one such day; customers count distinct repeating items.
    #58 ignores machines with an unknown serial; #63 is NULL for customers
    without any repeat inside a contract (it is not imputed).

    ``booked`` has every booking once (``booking_days``), and the contract side is one row
    per machine, so the join never multiplies rows.  The join's output is
    dealt out anew by item: with an aggregation on its own partitioning
    behind it, AQE could not split a hot machine.  Inputs that are dealt out by
    customer already and hold no hot one (``dealt``) need none of that."""
    span = machine.select("customer", "serial", "min_start", "max_end")
    inside = (F.col("booked") > F.col("min_start")) & (F.col("booked") < F.col("max_end"))
    days = booked.join(span, ["customer", "serial"], "left").select(
        "customer", "serial", "item", F.coalesce(inside, F.lit(False)).alias("inside"))
    if not dealt:
        days = days.repartition("customer", "serial", "item")
    per_item = days.groupBy("customer", "serial", "item").agg(
        F.count(F.lit(1)).alias("n_days"),
        F.count_if("inside").alias("n_inside"),
    )
    flags = per_item.groupBy("customer", "item").agg(
        F.max((F.col("serial") != NULL_KEY) & (F.col("n_days") > 1)).cast("int").alias("rep"),
        F.max(F.col("n_inside") > 1).cast("int").alias("rep_in"),
    )
    out = flags.groupBy("customer").agg(
        F.sum("rep").alias("repeat_parts_for_customer"),
        F.sum("rep_in").alias("repeat_parts_in_contract"),
    )
    return out.select(
        "customer",
        F.when(F.col("repeat_parts_for_customer") > 0, F.col("repeat_parts_for_customer"))
        .alias("repeat_parts_for_customer"),
        F.when(F.col("repeat_parts_in_contract") > 0, F.col("repeat_parts_in_contract"))
        .alias("repeat_parts_in_contract"),
    )


def contract_lags_and_profitability(sp_machine: DataFrame, machine: DataFrame) -> DataFrame:
    """One outer join of the per-machine spare and contract facts, one
    aggregation per customer:

    #65 -- per contracted machine: first contract start minus first booking
    (days), averaged per customer.

    #78/#79 -- per machine with contract-covered (ZAMC) parts: their cost over
    the top contract price; a machine is profitable when that ratio is at
    most 1.  Each part row meets every contract row of its machine, so its
    cost counts once per contract row (at least once) -- the row-by-row join,
    computed from one summary row per machine instead of the multiplied rows.
    """
    j = sp_machine.join(
        machine.select("customer", "serial", "min_start", "n_contracts", "max_price"),
        ["customer", "serial"],
        "full",
    )
    contracted = F.col("n_contracts").isNotNull()
    covered = F.coalesce(F.col("n_zamc"), F.lit(0)) > 0
    times = F.greatest(F.coalesce(F.col("n_contracts"), F.lit(1)), F.lit(1)).cast("double")
    net_total = F.col("net_total") * times
    profitability = F.when(covered, ieee_div(net_total, F.col("max_price")))
    profitable = F.when(profitability <= 1, 1).otherwise(0)
    agg = j.groupBy("customer").agg(
        int_mean(F.when(contracted, floor_days("min_start", "first_booked"))).alias(
            "Days_between_AMC_start_data_and_1st_consumption_date"
        ),
        F.sum(F.when(covered, profitable)).alias("p_sum"),
        F.count_if(covered).alias("p_count"),
        exact_mean(profitability).alias("avg_profitability"),
    )
    return agg.select(
        "customer",
        "Days_between_AMC_start_data_and_1st_consumption_date",
        F.when(F.col("p_count") > 0, F.col("p_sum") / F.col("p_count")).alias("AMC_perc"),
        F.when(F.col("p_count") > 0, F.col("avg_profitability")).alias("avg_profitability"),
    )
