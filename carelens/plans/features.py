"""The customer feature table: spine, summaries, imputation, final order.

Each summary is one row per customer, already hash-partitioned by
``customer`` by its last aggregation, so the left joins onto the spine are
co-partitioned (or broadcast when AQE finds a side small).
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from carelens.config import FeatureConfig
from carelens.functions.expr import age_days, fill_missing
from carelens.operators import calls, contracts, installs, items, price, spares
from carelens.sources.inputs import Sources
from carelens.sources.sinks import materialize, materialize_buckets, scratch_path, write_buckets

SENTINEL = 99999

L, D = "bigint", "double"


@dataclass(frozen=True)
class Feature:
    name: str
    group: str
    dtype: str
    fill: int | None  # 0, SENTINEL, or None (left missing)


# Output columns in the reference's order, with their fill.
# group = the summary that produces the column.
CATALOGUE: list[Feature] = [
    Feature("No_of_unique_products_purchased", "installs", L, 0),
    Feature("no_of_days_since_first_purchase", "installs", L, 0),
    Feature("frequency_of_purchase", "installs", D, 0),
    Feature("no_of_unique_categories_purchased", "installs", L, 0),
    Feature("no_of_ac_purchased", "installs", L, 0),
    Feature("no_of_wm_purchased", "installs", L, 0),
    Feature("no_of_mw_purchased", "installs", L, 0),
    Feature("no_days_btw_same_cat_purchase_avg", "gaps", D, SENTINEL),
    Feature("no_days_btw_same_cat_purchase_max", "gaps", L, SENTINEL),
    Feature("no_days_btw_same_cat_purchase_min", "gaps", L, SENTINEL),
    Feature("no_days_btw_cross_cat_purchase_avg", "gaps", D, SENTINEL),
    Feature("no_days_btw_cross_cat_purchase_max", "gaps", L, SENTINEL),
    Feature("no_days_btw_cross_cat_purchase_min", "gaps", L, SENTINEL),
    Feature("age_of_last_wm_bought", "installs", L, SENTINEL),
    Feature("age_of_last_dw_bought", "installs", L, SENTINEL),
    Feature("age_of_last_ac_bought", "installs", L, SENTINEL),
    Feature("closed_status_count", "calls", L, 0),
    Feature("cancelled_status_count", "calls", L, 0),
    Feature("customer_closed_status_count", "calls", L, 0),
    Feature("customer_cancelled_status_count", "calls", L, 0),
    Feature("days_since_last_closed_status", "calls", L, SENTINEL),
    Feature("negative_remarks_count", "calls", L, 0),
    Feature("soft_post_days_diff", "calls", D, SENTINEL),
    Feature("max_escalation", "calls", D, 0),
    Feature("count_of_99", "calls", L, 0),
    Feature("count_of_98", "calls", L, 0),
    Feature("avg_nps", "calls", D, 0),
    Feature("customer_closed_email_count", "calls", L, 0),
    Feature("customer_closed_phone_count", "calls", L, 0),
    Feature("customer_closed_wp_count", "calls", L, 0),
    Feature("closed_minor_og_count", "calls", L, 0),
    Feature("closed_minor_amc_count", "calls", L, 0),
    Feature("closed_minor_sw_count", "calls", L, 0),
    Feature("closed_minor_ew_count", "calls", L, 0),
    Feature("closed_major_sw_count", "calls", L, 0),
    Feature("closed_major_amc_count", "calls", L, 0),
    Feature("closed_major_ew_count", "calls", L, 0),
    Feature("closed_major_og_count", "calls", L, 0),
    Feature("unique_medium_count", "calls", L, 0),
    Feature("latest_nps_rating", "calls", D, 0),
    Feature("close_nr_days_diff", "calls", D, SENTINEL),
    Feature("AVG_TAT_SW", "calls", D, SENTINEL),
    Feature("AVG_TAT_AMC", "calls", D, SENTINEL),
    Feature("AVG_TAT_EW", "calls", D, SENTINEL),
    Feature("AVG_TAT_OG", "calls", D, SENTINEL),
    Feature("max_nps", "calls", D, 0),
    Feature("latest_max_nps_diff", "calls", D, 0),
    Feature("unique_prod_ser_superwarranty", "contracts", L, 0),
    Feature("unique_prod_ser_exwarranty", "contracts", L, 0),
    Feature("unique_prod_ser_labamc", "contracts", L, 0),
    Feature("unique_prod_ser_mot", "contracts", L, 0),
    Feature("unique_prod_ser_amc", "contracts", L, 0),
    Feature("unique_icrno_count", "contracts", L, 0),
    Feature("days_left_for_current_amc_to_be_ended", "contracts", L, SENTINEL),
    Feature("sum_amc_price", "contracts", D, 0),
    Feature("avg_price_amc", "contracts", D, 0),
    Feature("days_out_of_warranty", "warranty", L, SENTINEL),
    Feature("repeat_parts_for_customer", "repeat_parts", L, 0),
    Feature("days_since_last_purchase_zacc", "items", L, SENTINEL),
    Feature("days_since_last_purchase_zadd", "items", L, SENTINEL),
    Feature("zacc_qty", "items", D, 0),
    Feature("zadd_qty", "items", D, 0),
    Feature("ItemNo_x", "repeat_parts", L, None),
    Feature("ItemNo_y", "repeat_parts", L, None),
    Feature("Days_between_AMC_start_data_and_1st_consumption_date", "spare_contracts", D, SENTINEL),
    Feature("number_of_productcats_for_which_essentials_purchased", "items", L, 0),
    Feature("number_of_productcats_for_which_accessories_purchased", "items", L, 0),
    Feature("number_of_productser_for_which_essentials_purchased", "items", L, 0),
    Feature("number_of_productser_for_which_accessories_purchased", "items", L, 0),
    Feature("number_of_products_for_which_repurchase_done", "items", L, 0),
    Feature("number_of_products_for_which_repurchase_done_accessories", "items", L, 0),
    Feature("avg_date_diff_essentials", "items", D, SENTINEL),
    Feature("avg_date_diff_accessory", "items", D, SENTINEL),
    Feature("number_of_unique_essentials", "items", L, 0),
    Feature("number_of_unique_accessories", "items", L, 0),
    Feature("price_sensitivity", "price", D, 0),
    Feature("loyalty_score", "contracts", D, 0),
    Feature("AMC_perc", "spare_contracts", D, 0),
    Feature("avg_profitability", "spare_contracts", D, 0),
    Feature("difference_btw_first_ess_purchase_and_first_ifb_interaction", "items", D, SENTINEL),
    Feature("difference_btw_first_acc_purchase_and_first_ifb_interaction", "items", D, SENTINEL),
    Feature("days_since_latest_neg_remark", "calls", L, SENTINEL),
]
BY_NAME = {f.name: f for f in CATALOGUE}
FEATURE_NAMES = [f.name for f in CATALOGUE]


@dataclass(frozen=True)
class Reader:
    """Something that reads a shared result, and the columns it reads.  It
    takes part in a run if one of its ``features`` is asked for, or the shared
    result ``node`` that it makes is read."""

    columns: tuple[str, ...]
    features: frozenset[str] = frozenset()
    node: str | None = None


def _of(*groups: str, only: Iterable[str] = (), but: Iterable[str] = ()) -> frozenset[str]:
    return (frozenset(f.name for f in CATALOGUE if f.group in groups) | frozenset(only)) - frozenset(but)


MACHINE = ("customer", "serial")
_ITEM = items.COLUMNS
_named = lambda *measures: frozenset(n for m in measures for n in _ITEM[m].values())
BY_TYPE = _named("days_since_last_purchase", "latest_qty", "n_items", "mean_gap")
BY_MACHINE = _named("machines_covered", "repurchased", "first_contact_lag")
BY_CATEGORY = _named("cats_covered")
# Features that count a customer's different machines, and its different categories.
DISTINCTS = ({"No_of_unique_products_purchased", "frequency_of_purchase"}, {"no_of_unique_categories_purchased"})

# Who reads each prepared input and each fold.  Tie-break columns go with the
# readers that have to pick a row (``ORDERED``).
READERS: dict[str, dict[str, Reader]] = {
    "inst": {
        "fold": Reader(installs.FOLD_INPUT, node="inst_fold"),
        "gaps": Reader(("customer", "purchase_date", "cat_num"), _of("gaps")),
        "price": Reader(("customer", "material"), _of("price")),
    },
    "calls": {
        "machines": Reader(calls.FOLD_INPUT, _of("calls", but=["unique_medium_count"])),
        "media": Reader(("customer", "Medium"), frozenset(["unique_medium_count"])),
    },
    "con": {
        "machines": Reader((*MACHINE, "amc_type", "start", "end", "price", "priority"), node="con_machine"),
        "icr": Reader(("customer", "icr"), frozenset(["unique_icrno_count", "avg_price_amc"])),
    },
    "sp": {
        "repeats": Reader((*MACHINE, "item", "booked"), _of("repeat_parts")),
        "machines": Reader((*MACHINE, "booked", "category", "net"), _of("spare_contracts")),
    },
    "items": {
        "types": Reader(("customer", "itemtype", "posted", "qty", "item_code"), BY_TYPE),
        "machines": Reader((*MACHINE, "itemtype", "posted"), node="items_mt"),
    },
    "inst_fold": {
        "customers": Reader((*MACHINE, "category", "n", "first_purchase", "last_purchase", "end_not_og"), frozenset(FEATURE_NAMES)),
        "machines": Reader((*MACHINE, "n", "n_undated", "first_purchase", "last_purchase", "first_interaction"), BY_MACHINE),
        "categories": Reader((*MACHINE, "cat_num", "n_undated", "first_purchase", "last_purchase"), BY_CATEGORY),
    },
    "con_machine": {
        "customers": Reader((*MACHINE, *(f"has_{i}" for i in range(len(contracts.TYPE_COUNTS))), "priority", "max_end", "price_total"),
                            _of("contracts", "warranty", but=["unique_icrno_count"])),
        "repeats": Reader((*MACHINE, "min_start", "max_end"), _of("repeat_parts")),
        "spares": Reader((*MACHINE, "min_start", "n_contracts", "max_price"), _of("spare_contracts")),
    },
    "items_mt": {
        "machines": Reader((*MACHINE, "itemtype", "n_dates", "n_undated", "first_posted", "last_posted"), BY_MACHINE),
        "categories": Reader((*MACHINE, "itemtype", "n_undated", "first_posted", "last_posted"), BY_CATEGORY),
    },
}
ORDERED = {("inst", "gaps"): "installs", ("calls", "machines"): "calls", ("items", "types"): "call_items"}
# A wave only reads results of earlier waves.
WAVES = [("inst", "calls", "con", "sp", "items"), ("inst_fold", "con_machine", "items_mt")]
# Summaries that join folds by machine.
BY_MACHINE_GROUPS = ("repeat_parts", "spare_contracts", "items")

# A customer is hot with more rows than this in one input, and than one in
# ``HOT_SHARE`` of its rows (so that few are).
HOT_ROWS = 1 << 20
HOT_SHARE = 10_000


@contextmanager
def _joined_in_place(spark: SparkSession) -> Iterator[None]:
    """Joins by machine of tables that are both partitioned by customer are
    planned without an exchange."""
    key = "spark.sql.requireAllClusterKeysForCoPartition"
    old = spark.conf.get(key)
    spark.conf.set(key, "false")
    try:
        yield
    finally:
        spark.conf.set(key, old)


class _Plan:
    """Lazily built summaries of one run.

    A prepared input or fold that one reader of the run needs is part of that
    reader's plan, so columns and filters go through to the source.  One that
    several read is written once, with the columns they read and no others;
    folds are bucketed and sorted by machine, so that the joins and groupings
    by machine behind them need no exchange.

    A run that reads every input (the whole table) deals each of them out once,
    by customer: the written inputs, their folds, the prices of installs and the
    summaries that join folds are bucketed by customer, and no grouping, window
    or join behind them exchanges rows.  The tasks that prepare an input write
    its buckets themselves, as an exchange would move some three times the bytes
    of the files: a bucket has a file from each.  Hot customers, whose rows
    would make one task of them, are found in the written inputs and left to a
    second plan (``parts``), which reads the same files without their buckets
    and exchanges rows as above."""

    def __init__(self, src: Sources, cfg: FeatureConfig, names: Iterable[str]):
        self.src, self.cfg, self.wanted = src, cfg, frozenset(names)
        self._memo: dict[str, DataFrame] = {}
        self.staged: dict[str, DataFrame] = {}  # what was written, as planned
        self.paths: dict[str, str] = {}  # inputs dealt out by customer
        self.hot: _Plan | None = None
        self.given = False
        self.readers: dict[str, dict[str, Reader]] = {}
        for wave in reversed(WAVES):
            for node in wave:
                self.readers[node] = {k: r for k, r in READERS[node].items()
                                      if r.features & self.wanted or (r.node and self.readers.get(r.node))}

    @property
    def dealt(self) -> bool:
        """Whether inputs are dealt out by customer."""
        return not self.given and all(self.readers[node] for node in WAVES[0])

    def _written(self, node: str) -> bool:
        """Whether ``node`` is written before its readers read it."""
        return len(self.readers[node]) > 1 or (self.dealt and node in WAVES[0])

    def columns(self, node: str) -> list[str]:
        """The columns that this run's readers of ``node`` read."""
        out: list[str] = []
        for name, reader in self.readers[node].items():
            tie = self.src.tiebreak(ORDERED[node, name]) if (node, name) in ORDERED else []
            out += [c for c in (*reader.columns, *tie) if c not in out]
        return out

    def _get(self, key: str, fn: Callable[[], DataFrame]) -> DataFrame:
        if key not in self._memo:
            self._memo[key] = fn()
        return self._memo[key]

    def _shared(self, node: str, fn: Callable[[], DataFrame]) -> DataFrame:
        def build() -> DataFrame:
            df = fn()
            if not self._written(node):
                return df
            spark = df.sparkSession
            df = df.select(*self.columns(node))
            buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
            if node not in WAVES[1]:
                self.staged[node] = df
                if not self.dealt:
                    return materialize(spark, df, f"prepared-{node}")
                self.paths[node] = scratch_path(spark, f"dealt-{node}")
                return spark.table(write_buckets(df, self.paths[node], buckets, ("customer",), sort=()))
            if self.dealt:
                self.staged[node] = df
                return materialize_buckets(spark, df, f"fold-{node}", buckets, ("customer",))
            if node != "con_machine":  # grouped by more than the machine
                df = df.repartition(buckets, *MACHINE)
            self.staged[node] = df
            return materialize_buckets(spark, df, f"fold-{node}", buckets, MACHINE)

        return self._get(node, build)

    def prestage(self) -> None:
        """Write the shared results of the run, independent ones as concurrent
        Spark jobs (one driver thread each), wave by wave."""
        with ThreadPoolExecutor(max_workers=len(WAVES[0])) as pool:
            for wave in WAVES:
                list(pool.map(lambda key: getattr(self, key)(), [k for k in wave if self._written(k)]))
                if self.dealt and wave is WAVES[0]:
                    self._part_hot(pool)
            if self.dealt:
                groups = _groups_for(sorted(self.wanted))
                with _joined_in_place(self.inst().sparkSession):
                    jobs = [pool.submit(self._written_group, g) for g in groups if g in BY_MACHINE_GROUPS]
                    jobs += [pool.submit(self.group, g) for g in groups if g == "price"]
                    for job in jobs:
                        job.result()
        if self.hot:
            self.hot.prestage()

    def parts(self) -> list[_Plan]:
        """The plans of the run, over different customers."""
        return [self, self.hot] if self.hot else [self]

    def _part_hot(self, pool: ThreadPoolExecutor) -> None:
        dealt = {node: rows for node, rows in self._memo.items() if node in self.paths}

        def find(node: str) -> list[str]:
            counts = dealt[node].groupBy("customer").count()
            if counts.where(F.col("count") > HOT_ROWS).isEmpty():
                return []
            least = max(HOT_ROWS, dealt[node].count() // HOT_SHARE)
            return [r["customer"] for r in counts.where(F.col("count") > least).collect()]  # at most HOT_SHARE of them

        names = sorted({c for found in pool.map(find, WAVES[0]) for c in found if c is not None})
        if not names:
            return
        is_hot = F.coalesce(F.col("customer").isin(names), F.lit(False))
        self.hot = _Plan(self.src, self.cfg, self.wanted)
        self.hot.given = True
        for node, rows in dealt.items():
            files = rows.sparkSession.read.schema(rows.schema).parquet(self.paths[node])
            self.hot._memo[node], self._memo[node] = files.where(is_hot), rows.where(~is_hot)

    def _written_group(self, name: str) -> None:
        df = self.group(name)
        spark = df.sparkSession
        buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
        self._memo[f"group:{name}"] = materialize_buckets(spark, df, f"grouped-{name}", buckets, ("customer",))

    # shared inputs
    def inst(self) -> DataFrame:
        return self._shared("inst", lambda: installs.prepare(self.src, self.cfg))

    def inst_fold(self) -> DataFrame:
        return self._shared("inst_fold", lambda: installs.fold(self.inst()))

    def calls(self) -> DataFrame:
        return self._shared("calls", lambda: calls.prepare(self.src, self.cfg))

    def con(self) -> DataFrame:
        return self._shared("con", lambda: contracts.prepare(self.src, self.cfg))

    def con_machine(self) -> DataFrame:
        return self._shared("con_machine", lambda: contracts.per_machine(self.con()))

    def sp(self) -> DataFrame:
        return self._shared("sp", lambda: spares.prepare(self.src, self.cfg))

    def items(self) -> DataFrame:
        return self._shared("items", lambda: items.prepare(self.src, self.cfg))

    def items_mt(self) -> DataFrame:
        return self._shared("items_mt", lambda: items.per_machine_type(self.items()))

    # summaries, one row per customer
    def group(self, name: str) -> DataFrame:
        builders: dict[str, Callable[[], DataFrame]] = {
            "installs": lambda: installs.summary(self.inst_fold(), self.cfg, self._two_distincts()),
            "gaps": lambda: installs.purchase_gaps(self.inst(), self.src.tiebreak("installs"), self.dealt),
            "calls": lambda: calls.summary(self.calls(), self.src.tiebreak("calls"), self.cfg),
            "contracts": self._contracts,
            "repeat_parts": lambda: spares.repeat_parts(self.sp(), self.con_machine(), self.dealt),
            "spare_contracts": lambda: spares.contract_lags_and_profitability(spares.machine_fold(self.sp()), self.con_machine()),
            "items": self._items,
            "price": lambda: price.weighted(self._priced()),
        }
        return self._get(f"group:{name}", builders[name])

    def _priced(self) -> DataFrame:
        """The installs' customers and prices.  The join with the price file
        leaves them dealt out by material: a run whose inputs are dealt out by
        customer writes them so as well."""
        df = price.priced(self.src, self.inst())
        if not self.dealt:
            return df
        buckets = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        return materialize_buckets(df.sparkSession, df, "dealt-prices", buckets, ("customer",), sort=())

    def _two_distincts(self) -> bool:
        """Both distincts of the installs are wanted, of a fold that is written:
        counted apart they read it twice."""
        return len(self.readers["inst_fold"]) > 1 and all(names & self.wanted for names in DISTINCTS)

    def _contracts(self) -> DataFrame:
        if "customers" not in self.readers["con_machine"]:
            return contracts.number_counts(contracts.numbers(self.con()))
        if "icr" not in self.readers["con"]:
            return contracts.from_folds(None, self.con_machine(), self.cfg)
        return contracts.summary(self.con(), self.con_machine(), self.cfg)

    def _items(self) -> DataFrame:
        parts = []
        if BY_TYPE & self.wanted:
            parts.append(items.per_type(self.items(), self.src.tiebreak("call_items"), self.cfg, self.dealt))
        if BY_MACHINE & self.wanted:
            parts.append(items.machine_stats(self.items_mt(), installs.per_machine(self.inst_fold())))
        if BY_CATEGORY & self.wanted:
            parts.append(items.category_coverage(self.items_mt(), installs.per_machine_category(self.inst_fold())))
        return items.summary(parts)


def _groups_for(names: Iterable[str]) -> list[str]:
    needed: list[str] = []
    for n in names:
        g = BY_NAME[n].group
        deps = ["installs", "contracts"] if g == "warranty" else [g]
        for d in deps:
            if d not in needed and d != "installs":
                needed.append(d)
    return needed


def feature_table(
    src: Sources, cfg: FeatureConfig | None = None, columns: Iterable[str] | None = None
) -> DataFrame:
    """``customer`` + the requested features (default: all 82, in order),
    one row per customer of the installed base, missing values imputed."""
    cfg = cfg or FeatureConfig()
    names = list(columns) if columns is not None else FEATURE_NAMES
    return _table(_Plan(src, cfg, names), names)


def _table(plan: _Plan, names: list[str]) -> DataFrame:
    plan.prestage()
    out = None
    for part in plan.parts():
        df = _assembled(part, names)
        out = df if out is None else out.unionByName(df)
    return out


def _assembled(plan: _Plan, names: list[str]) -> DataFrame:
    df = plan.group("installs")
    for g in _groups_for(names):
        df = df.join(plan.group(g), "customer", "left")
    out = [F.col("customer")]
    for n in names:
        f = BY_NAME[n]
        if n == "days_out_of_warranty":
            c = age_days(F.greatest("zzenddate_max", "con_end_date_max"), plan.cfg.as_of)
        elif n in ("ItemNo_x", "ItemNo_y"):
            c = F.col("repeat_parts_in_contract")
        else:
            c = F.col(n)
        c = c.cast(f.dtype)
        if f.fill is not None:
            c = fill_missing(c, f.fill, f.dtype == D)
        out.append(c.alias(n))
    return df.select(*out)


def build_features(src: Sources, cfg: FeatureConfig | None = None) -> DataFrame:
    """The full 83-column table (``customer`` + 82 features)."""
    return feature_table(src, cfg)
