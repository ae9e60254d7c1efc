"""What a run writes besides its result, and how often it exchanges rows."""

import re

import pytest
from pyspark.sql import functions as F

from carelens.config import FeatureConfig
from carelens.plans import features as FT
from carelens.sources import fixtures as FX
from carelens.sources import sinks


def plan_of(src, names):
    plan = FT._Plan(src, FeatureConfig(), names)
    return plan, FT._table(plan, list(names))


def executed(df):
    return df._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]


def exchanges(df):
    return len(re.findall(r"(?<![A-Za-z])Exchange hashpartitioning", executed(df)))


@pytest.fixture
def no_broadcast(spark):
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1"}
    old = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    yield
    for k, v in old.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


SLICES = {
    # Features -> what is written for them, and its columns.
    ("latest_nps_rating",): {},
    ("loyalty_score",): {},
    ("price_sensitivity",): {"inst": {"customer", "material", *FT.installs.FOLD_INPUT}},
    ("avg_date_diff_essentials",): {},
    ("unique_medium_count",): {},
    ("unique_medium_count", "avg_nps"): {"calls": {"Medium", *FT.calls.FOLD_INPUT}},
    ("AMC_perc", "ItemNo_x"): {
        "sp": {"customer", "serial", "item", "booked", "category", "net"},
        "con_machine": {"customer", "serial", "min_start", "max_end", "n_contracts", "max_price"}},
    ("number_of_unique_essentials", "number_of_productcats_for_which_essentials_purchased"): {
        "items": {"customer", "serial", "itemtype", "posted", "qty", "item_code"},
        "inst_fold": {"customer", "serial", "category", "cat_num", "n", "n_undated", "first_purchase", "last_purchase", "end_not_og"}},
}


@pytest.mark.parametrize("names", SLICES, ids=lambda n: n[0])
def test_a_slice_writes_only_what_several_readers_share(spark, small_sources, small_features, names):
    mark = sinks.scratch_mark()
    plan, df = plan_of(small_sources, names)
    order = {c for cols in small_sources.order.values() for c in cols}
    assert {k: set(v.columns) - order for k, v in plan.staged.items()} == SLICES[names]
    want = small_features.set_index("customer")[list(names)]
    got = df.toPandas().set_index("customer").loc[want.index]
    assert got.equals(want) or (got.fillna(-1) == want.fillna(-1)).all().all()
    sinks.release(spark, mark)


def test_columns_go_through_to_the_source(spark, small_sources):
    """One reader: the scan itself reads what the slice needs."""
    _, df = plan_of(small_sources, ["latest_nps_rating"])
    scans = re.findall(r"FileScan parquet \[([^\]]*)\]", executed(df))
    events = [s for s in scans if "event" in s or "ts#" in s]
    assert events and all(len(s.split(",")) < 9 for s in scans)


def test_exchanges_of_the_whole_table(spark, small_sources, no_broadcast):
    """All jobs of a full run together; 50 before folds were bucketed."""
    mark = sinks.scratch_mark()
    plan, df = plan_of(small_sources, FT.FEATURE_NAMES)
    assert set(plan.staged) == {"inst", "calls", "con", "sp", "items", "inst_fold", "con_machine", "items_mt"}
    assert exchanges(df) + sum(map(exchanges, plan.staged.values())) <= 46
    sinks.release(spark, mark)


def test_buckets_are_joined_and_grouped_in_place(spark, no_broadcast):
    """Two bucketed tables by machine: no exchange; and a customer that holds a
    third of all machines is spread over the buckets."""
    mark = sinks.scratch_mark()
    i = F.col("id")
    rows = spark.range(9000).select(F.when(i % 3 == 0, F.lit("hot")).otherwise((i % 400).cast("string")).alias("customer"),
                                    (i % 3000).cast("string").alias("serial"), i.alias("v"))
    make = lambda name: sinks.materialize_buckets(spark, rows.repartition(8, "customer", "serial"), name, 8, ("customer", "serial"))
    a, b = make("left"), make("right")
    joined = a.join(b.withColumnRenamed("v", "w"), ["customer", "serial"]).groupBy("customer", "serial").agg(F.count("*").alias("n"))
    assert joined.count() == rows.select("customer", "serial").distinct().count()
    joined.collect()
    assert exchanges(joined) == 0
    per_file = a.where("customer = 'hot'").groupBy(F.input_file_name()).count().toPandas()["count"]
    assert len(per_file) == 8 and per_file.max() < 2 * per_file.mean()
    tables = [t.name for t in spark.catalog.listTables() if t.name.startswith("carelens_")]
    assert len(tables) >= 2
    sinks.release(spark, mark)
    assert not [t for t in spark.catalog.listTables() if t.name in tables[-2:] and t.name in sinks._named.values()]


def test_the_whole_table_deals_each_input_once(spark, small_sources, small_features, no_broadcast):
    """Behind the written inputs nothing but the price join exchanges rows: 18
    exchanges, 46 when every fold and window dealt its rows out anew."""
    mark = sinks.scratch_mark()
    plan, df = plan_of(small_sources, FT.FEATURE_NAMES)
    assert plan.dealt and plan.hot is None
    assert all(exchanges(plan.staged[n]) == 0 for n in FT.WAVES[1])
    assert exchanges(df) + sum(map(exchanges, plan.staged.values())) <= 20
    same_features(df, small_features)
    sinks.release(spark, mark)


def same_features(df, want):
    want = want.set_index("customer").sort_index()
    got = df.toPandas().set_index("customer").sort_index()
    assert list(got.index) == list(want.index)
    assert got.equals(want) or (got.fillna(-1) == want.fillna(-1)).all().all()


def test_hot_customers_are_exchanged_apart(spark, small_sources, small_features, monkeypatch):
    """Customers with many rows go by the plan that spreads them; no row is
    lost or taken twice, and none of theirs is read by bucket."""
    mark = sinks.scratch_mark()
    monkeypatch.setattr(FT, "HOT_ROWS", 50)
    monkeypatch.setattr(FT, "HOT_SHARE", 10**9)
    plan, df = plan_of(small_sources, FT.FEATURE_NAMES)
    assert plan.hot is not None and not plan.hot.dealt
    hot = {r["customer"] for r in plan.hot.inst().select("customer").distinct().collect()}
    cold = {r["customer"] for r in plan.inst().select("customer").distinct().collect()}
    assert hot and cold and not hot & cold
    assert "Bucketed: true" not in executed(plan.hot.inst().groupBy("customer").count())
    same_features(df, small_features)
    assert df.sparkSession.conf.get("spark.sql.requireAllClusterKeysForCoPartition") == "true"
    sinks.release(spark, mark)


def test_contract_numbers_alone_take_no_fold(spark, small_sources, small_features):
    """Distinct contract numbers are counted without writing contracts or
    folding them by machine."""
    mark = sinks.scratch_mark()
    names = ["unique_icrno_count", "no_of_unique_categories_purchased", "No_of_unique_products_purchased"]
    plan, df = plan_of(small_sources, names)
    assert plan.staged == {} and "o_totalprice" not in executed(df)
    same_features(df, small_features[["customer", *names]])
    sinks.release(spark, mark)


@pytest.fixture(scope="module")
def own_tables(spark, tmp_path_factory):
    """Small tables with lines of no order, orders of no customer, rows that
    come twice, and ties in every date."""
    at = str(tmp_path_factory.mktemp("tables"))
    i = F.col("id")
    day = lambda n: F.lit("2020-01-01").cast("timestamp_ntz") + F.make_dt_interval((n % 40).cast("int"))
    of = lambda n, *values: F.element_at(F.array(*[F.lit(v) for v in values]), (n % len(values) + 1).cast("int"))
    twice = lambda df: df.unionByName(df.where(i % 5 == 0))
    made = {
        "orders": twice(spark.range(90)).select(
            i.alias("o_orderkey"), F.when(i % 11 != 0, i % 17).alias("o_custkey"), (i * 1.25).alias("o_totalprice"), day(i * 7).alias("o_orderdate"),
            of(i, "1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW", None).alias("o_orderpriority")),
        "lineitem": twice(spark.range(400)).select(
            F.when(i % 13 != 0, i * 7 % 95).alias("l_orderkey"), (i * 3 % 30).alias("l_partkey"), (i % 7).alias("l_suppkey"),
            (i % 6).cast("int").alias("l_linenumber"), (i % 9 + 0.5).alias("l_quantity"), (i * 2.5).alias("l_extendedprice"),
            of(i, "R", "A", "N", None).alias("l_returnflag"), of(i / 2, "F", "O").alias("l_linestatus"), day(i * 5).alias("l_shipdate")),
        "part": spark.range(28).select(i.alias("p_partkey"), of(i, "ECONOMY TIN", "SMALL", "MEDIUM", "LARGE", "PROMO").alias("p_type"),
                                       (i + 900.0).alias("p_retailprice"), (i % 50).cast("int").alias("p_size")),
        "events": twice(spark.range(200)).select(
            i.alias("event_id"), (F.lit("2024-01-01").cast("timestamp_ntz") + F.make_dt_interval((i % 9).cast("int"))).alias("ts"),
            F.when(i % 19 != 0, i % 17).alias("user_id"), of(i, "purchase", "click", "error", "view").alias("event_type"),
            (i % 13 * 1.0).alias("value"), F.concat(F.lit('{"k": '), (i % 100).cast("string"), F.lit("}")).alias("props")),
    }
    for name, df in made.items():
        df.write.parquet(f"{at}/{name}.parquet")
    return at


def test_inputs_of_joined_lines_are_the_same_rows(spark, own_tables):
    mark = sinks.scratch_mark()
    apart, once = FX.fixture_sources(spark, own_tables), FX.fixture_sources(spark, own_tables, FX.joined_lines(spark, own_tables))
    for name in ("installs", "spares", "call_items"):
        a, b = getattr(apart, name), getattr(once, name)
        assert a.schema.simpleString() == b.schema.simpleString() and a.count() == b.count() > 0
        assert a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()
    sinks.release(spark, mark)


def test_inputs_are_dealt_out_without_moving_rows(spark, own_tables, no_broadcast):
    """Buckets are written by the tasks that prepare an input (one more exchange
    each before), and prices are read in place like the rest (three exchanges)."""
    mark = sinks.scratch_mark()
    names = FT.FEATURE_NAMES
    plan, df = plan_of(FX.fixture_sources(spark, own_tables, FX.joined_lines(spark, own_tables)), names)
    assert {n: exchanges(plan.staged[n]) for n in FT.WAVES[0]} == {"inst": 2, "calls": 0, "con": 0, "sp": 0, "items": 0}
    assert "rebalance" not in "".join(plan.staged[n]._jdf.queryExecution().toString().lower() for n in FT.WAVES[0])
    assert exchanges(df) == 0
    apart = FT._Plan(FX.fixture_sources(spark, own_tables), FeatureConfig(), names)
    apart.given = True  # as hot customers are
    same_features(df, FT._table(apart, names).toPandas())
    sinks.release(spark, mark)


def test_a_run_that_reads_every_input_deals_all_of_them_out(spark, own_tables, no_broadcast):
    """Also those of a single reader: the sentinel columns have one of calls,
    which kept their run from it."""
    mark = sinks.scratch_mark()
    names = [f.name for f in FT.CATALOGUE if f.fill == FT.SENTINEL]
    src = FX.fixture_sources(spark, own_tables, FX.joined_lines(spark, own_tables))
    plan, df = plan_of(src, names)
    assert plan.dealt and set(FT.WAVES[0]) <= set(plan.staged) and exchanges(df) == 0
    apart = FT._Plan(src, FeatureConfig(), names)
    apart.given = True
    same_features(df, FT._table(apart, names).toPandas())
    sinks.release(spark, mark)
