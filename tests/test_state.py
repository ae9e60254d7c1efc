"""Daily batches merged into feature state against one full build."""

import math
import os

import pytest
from pyspark.sql import functions as F

from carelens.config import FeatureConfig
from carelens.functions import expr as X
from carelens.plans import features as FT
from carelens.sources.readers import DAILY_COLUMNS
from carelens.streaming import state as S

COLUMNS = [f.name for f in FT.CATALOGUE if f.group in (*S.GROUPS, "warranty")]


def day_batch(src, i, n):
    return {t: getattr(src, t).where(F.coalesce(F.pmod(X.day_index(F.col(c)), F.lit(n)), F.lit(0)) == i) for t, c in DAILY_COLUMNS.items()}


def same(got, want):
    got, want = (x.set_index("customer").sort_index() for x in (got, want))
    assert list(got.index) == list(want.index)
    for c in got.columns:
        for x, y in zip(got[c], want[c], strict=True):
            assert x == y or (x != x and y != y) or math.isclose(x, y, rel_tol=1e-9), c


@pytest.fixture
def state(spark, tmp_path):
    return S.FeatureState(spark, f"file://{tmp_path}/state", FeatureConfig())


def test_batches_equal_one_full_build(spark, small_sources, small_features, state):
    want = small_features[["customer", *COLUMNS]]
    for i in range(4):
        assert state.apply(f"day-{i}", day_batch(small_sources, i, 4), small_sources.order)
        if i == 2:
            assert state.compact() and not state.compact()
    assert state.batches() == [f"day-{i}" for i in range(4)]
    same(state.features(small_sources, COLUMNS).toPandas(), want)
    # Delivered again, also under a reader that holds on: nothing changes.
    commits = os.listdir(state.root.removeprefix("file://") + "/commits")
    assert not state.apply("day-1", day_batch(small_sources, 1, 4), small_sources.order)
    assert os.listdir(state.root.removeprefix("file://") + "/commits") == commits


def test_the_whole_table_from_state(spark, small_sources, small_features, state):
    state.apply("all", day_batch(small_sources, 0, 1), small_sources.order)
    same(state.features(small_sources).toPandas(), small_features)


def test_only_touched_customers_are_written(spark, small_sources, state):
    state.apply("first", day_batch(small_sources, 0, 2), small_sources.order)
    few = [r[0] for r in small_sources.contracts.select("CustomerCode").distinct().orderBy("CustomerCode").limit(3).collect()]
    second = {t: df.where(F.col("CustomerC" if t == "spares" else "CustomerCode").isin(few)) for t, df in day_batch(small_sources, 1, 2).items()}
    state.apply("second", second, small_sources.order)
    layers = state._commit()[1]["layers"]
    for name in S.FOLDS:
        written = {r[0] for r in spark.read.parquet(f"{state.root}/layers/{layers[1]}/{name}").select("customer").distinct().collect()}
        assert written <= set(few), name
    everyone = state.fold("contracts").select("customer").distinct().count()
    assert everyone == spark.read.parquet(f"{state.root}/layers/{layers[0]}/contracts").select("customer").distinct().count()


def test_a_dead_writer_and_a_race(spark, small_sources, state, monkeypatch):
    state.apply("a", day_batch(small_sources, 0, 3), small_sources.order)
    before = state.fold("calls").count()
    # Died in its commit: the file is cut, its layer is in no list.
    with open(state.root.removeprefix("file://") + f"/commits/{2:010d}", "w") as f:
        f.write('{"batches": ["b"], "lay')
    assert state.batches() == ["a"] and state.fold("calls").count() == before
    # Another writer commits while this one works: it starts over on top of that.
    real, raced = state._publish, []

    def publish(number, commit):
        if not raced:
            raced.append(True)
            assert S.FeatureState(spark, state.root).apply("c", day_batch(small_sources, 2, 3), small_sources.order)
        return real(number, commit)

    monkeypatch.setattr(state, "_publish", publish)
    assert state.apply("b", day_batch(small_sources, 1, 3), small_sources.order)
    assert state.batches() == ["a", "c", "b"]
    full = S.calls.per_machine(S.calls.prepare(small_sources, FeatureConfig()), list(small_sources.order["calls"]))
    key = lambda df: sorted(df.select("customer", "serial", "n_calls", "max_nps", F.col("latest")["v"]).collect(), key=str)
    assert key(state.fold("calls")) == key(full)


def test_tables_may_be_missing_from_later_batches(spark, small_sources, state):
    whole = day_batch(small_sources, 0, 1)
    with pytest.raises(ValueError):
        state.apply("x", {"calls": whole["calls"]}, small_sources.order)
    none = {t: df.where("false") for t, df in whole.items()}
    state.apply("empty", none, small_sources.order)
    for t in whole:
        state.apply(t, {t: whole[t]}, small_sources.order)
    assert state.fold("numbers").count() == S.contracts.numbers(S.contracts.prepare(small_sources, FeatureConfig())).count()
    assert state.fold("bookings").count() == S.spares.booking_days(S.spares.prepare(small_sources, FeatureConfig())).count()


def test_layers_are_merged_and_joined_where_they_are(spark, small_sources, state):
    for i in range(2):
        state.apply(f"day-{i}", day_batch(small_sources, i, 2), small_sources.order)
    plan = lambda df: df._jdf.queryExecution().executedPlan().toString()
    for name, fold in S.FOLDS.items():
        rows = state.fold(name)
        assert "Exchange" not in plan(rows), name
        assert rows.count() == rows.select(*fold.keys).distinct().count(), name
    key, old = "spark.sql.autoBroadcastJoinThreshold", spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set(key, "-1")
    try:
        joined = state.fold("bookings").join(state.fold("contracts"), ["customer", "serial"], "left")
        assert "Exchange" not in plan(joined)
    finally:
        spark.conf.set(key, old)


def test_layers_are_read_by_a_session_that_did_not_write_them(spark, small_sources, state):
    for i in range(2):
        state.apply(f"day-{i}", day_batch(small_sources, i, 2), small_sources.order)
    want = {n: sorted(map(str, state.fold(n).collect())) for n in S.FOLDS}
    for table in spark.catalog.listTables():
        if table.name.startswith("carelens_"):
            spark.sql(f"DROP TABLE {table.name}")
    again = S.FeatureState(spark, state.root)
    assert {n: sorted(map(str, again.fold(n).collect())) for n in S.FOLDS} == want
