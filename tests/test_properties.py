"""Properties of the full table on the driver's smallest tables."""

import math

import pytest
from pyspark.sql import functions as F

from carelens.config import FeatureConfig
from carelens.plans.features import CATALOGUE, FEATURE_NAMES, build_features
from carelens.sources.inputs import Sources


def test_one_row_per_installed_customer(small_features, small_sources):
    n = small_sources.installs.select("zzsoldto").distinct().count()
    assert len(small_features) == n
    assert small_features["customer"].is_unique


def test_columns_in_catalogue_order(small_features):
    assert list(small_features.columns) == ["customer"] + FEATURE_NAMES
    assert len(FEATURE_NAMES) == 82
    assert sum(f.fill == 0 for f in CATALOGUE) == 54          # 51 zero fills + #2, #3, #6
    assert sum(f.fill == 99999 for f in CATALOGUE) == 26      # 28 sentinel fills minus #2, #3


def test_no_missing_outside_unimputed(small_features):
    for c in FEATURE_NAMES:
        if c in ("ItemNo_x", "ItemNo_y"):
            continue
        col = small_features[c]
        assert not col.isna().any(), c


def test_duplicated_column_is_identical(small_features):
    a, b = small_features["ItemNo_x"], small_features["ItemNo_y"]
    assert ((a == b) | (a.isna() & b.isna())).all()


def test_same_category_min_avg_max_ordered(small_features):
    for kind in ("same", "cross"):
        lo = small_features[f"no_days_btw_{kind}_cat_purchase_min"]
        mid = small_features[f"no_days_btw_{kind}_cat_purchase_avg"]
        hi = small_features[f"no_days_btw_{kind}_cat_purchase_max"]
        known = lo != 99999
        assert ((lo[known] <= mid[known]) & (mid[known] <= hi[known])).all()
        assert ((lo == 99999) == (hi == 99999)).all()


def test_unchanged_when_inputs_are_shuffled(spark, small_sources, small_features):
    shuffled = Sources(
        **{n: df.orderBy(F.rand(7)).repartition(5) for n, df in small_sources.frames().items()},
        order=small_sources.order,
    )
    again = build_features(shuffled, FeatureConfig()).toPandas()
    a = small_features.sort_values("customer").reset_index(drop=True)
    b = again.sort_values("customer").reset_index(drop=True)
    for c in a.columns:
        for x, y in zip(a[c], b[c]):
            assert (x == y) or (x != x and y != y), c


def test_profitability_shortcut_equals_fanout_join(spark, small_sources):
    """The per-machine shortcut (cost x number of contract rows) against the
    literal part-row x contract-row join."""
    from carelens.functions.expr import exact_mean, ieee_div
    from carelens.operators import contracts, spares

    cfg = FeatureConfig()
    sp = spares.prepare(small_sources, cfg)
    con = contracts.prepare(small_sources, cfg)
    got = spares.contract_lags_and_profitability(spares.machine_fold(sp), contracts.per_machine(con))
    fan = sp.where(F.col("category") == "ZAMC").join(
        con.select("customer", "serial", "price"), ["customer", "serial"], "left")
    per = fan.groupBy("customer", "serial").agg(
        F.sum("net").alias("net"), F.max("price").alias("price"))
    per = per.withColumn("p", ieee_div("net", "price"))
    ref = per.groupBy("customer").agg(
        (F.sum(F.when(F.col("p") <= 1, 1).otherwise(0)) / F.count(F.lit(1))).alias("AMC_perc"),
        exact_mean("p").alias("avg_profitability"))
    g = {r["customer"]: r for r in got.where(F.col("AMC_perc").isNotNull()).collect()}
    r = {r["customer"]: r for r in ref.collect()}
    assert g.keys() == r.keys() and len(g) > 10
    for k in g:
        assert g[k]["AMC_perc"] == r[k]["AMC_perc"]
        x, y = g[k]["avg_profitability"], r[k]["avg_profitability"]
        assert (x is None and y is None) or math.isclose(x, y, rel_tol=1e-9)


def test_plan_has_no_cross_join_or_python(spark, small_sources):
    df = build_features(small_sources, FeatureConfig())
    plan = df._jdf.queryExecution().executedPlan().toString()
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython",
                "FlatMapGroupsInPandas"):
        assert bad not in plan


def test_staged_tables_go_on_release(spark, small_sources):
    import os

    from carelens.plans.features import feature_table
    from carelens.sources import sinks

    mark = sinks.scratch_mark()
    # Calls and machine contracts have two readers each, so they are staged.
    df = feature_table(small_sources, FeatureConfig(), ["avg_nps", "unique_medium_count", "loyalty_score", "avg_profitability"])
    n = df.count()
    paths = list(sinks._scratch[mark:])
    assert n > 0 and paths and all(os.path.isdir(p) for p in paths)
    assert sinks.release(spark, mark) == len(paths)
    assert not any(os.path.exists(p) for p in paths) and sinks.scratch_mark() == mark


def test_dedupe_contracts_drops_repeated_rows_only(spark, small_sources):
    from carelens.plans.features import feature_table

    cols = ["sum_amc_price", "unique_icrno_count", "avg_profitability"]
    twice = small_sources.with_frames(contracts=small_sources.contracts.unionByName(small_sources.contracts))
    key = lambda df: sorted(map(str, df.collect()))
    once = key(feature_table(small_sources, FeatureConfig(), cols))
    assert key(feature_table(twice, FeatureConfig(dedupe_contracts=True), cols)) == once
    assert key(feature_table(twice, FeatureConfig(), cols)) != once


def test_a_hot_machine_is_split(spark):
    """repeat_parts with a third of all rows on one machine: AQE splits the
    join's skewed side."""
    from carelens.operators import spares
    from carelens.sources.sinks import materialize

    conf = {"spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "16k", "spark.sql.adaptive.advisoryPartitionSizeInBytes": "8k",
            "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2", "spark.sql.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    old = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        i = F.col("id")
        hot = i % 3 == 0
        sp = spark.range(60_000).select(
            F.when(hot, F.lit("nan")).otherwise((i % 500).cast("string")).alias("customer"),
            F.when(hot, F.lit("m")).otherwise((i % 700).cast("string")).alias("serial"),
            (i % 900).cast("string").alias("item"),
            (F.lit("2020-01-01").cast("timestamp_ntz") + F.make_dt_interval(F.lit(0), i.cast("int"))).alias("booked"))
        machine = sp.select("customer", "serial").distinct().select(
            "*", F.lit("2020-03-01").cast("timestamp_ntz").alias("min_start"), F.lit("2021-03-01").cast("timestamp_ntz").alias("max_end"))
        # Staged, as the plan has it: nothing stands between its exchange and the join.
        out = spares.repeat_parts(sp, materialize(spark, machine, "machine"))
        rows = {r["customer"]: r for r in out.collect()}
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert "skewed" in plan or "skew=true" in plan
        assert rows["nan"]["repeat_parts_for_customer"] == 300
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_a_hot_machines_profitability_is_not_cut(spark):
    from carelens.operators import contracts, spares

    con = spark.createDataFrame([("nan", "nan", 0.01)] * 1000, "customer string, serial string, price double").select(
        "*", F.lit("AMC").alias("amc_type"), F.lit(1).alias("priority"), *[F.lit(None).cast("timestamp_ntz").alias(c) for c in ("start", "end")])
    sp = spark.range(1000).select(
        F.lit("nan").alias("customer"), F.lit("nan").alias("serial"), F.lit("i").alias("item"), F.lit(1e9).alias("net"),
        F.lit("ZAMC").alias("category"), F.lit(None).cast("timestamp_ntz").alias("booked"))
    got = spares.contract_lags_and_profitability(spares.machine_fold(sp), contracts.per_machine(con)).first()
    assert got["avg_profitability"] == pytest.approx(1000 * 1e9 * 1000 / 0.01, rel=1e-12)
